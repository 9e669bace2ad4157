from __future__ import annotations

import io
import random
import zlib

import pytest

from tidemark.llm import warc
from tidemark.llm.tables import new_folder, open_store

SCHEMA = "page_id long, url string, html string, payload string, size string, digest string"


def member(data):
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(data) + pack.flush()


def records(n, seed=1, packed=True):
    rng = random.Random(seed)
    made = [warc.record(i, f"http://x/{i}", bytes(rng.choices(range(256), k=rng.randint(0, 900))), None, "d") for i in range(n)]
    return [member(r) if packed else r for r in made]


def read(data, begin=0, end=None):
    file = warc._Bytes(io.BytesIO(data), len(data))
    return list(warc.salvage(file, begin, len(data) if end is None else end))


def pages_of(found):
    return [int(f[2]["warc-page-id"]) for f in found if f[0] == "record"]


def gaps_of(found):
    return [(f[1], f[2]) for f in found if f[0] == "gap"]


@pytest.mark.parametrize("packed", [True, False])
def test_damage_costs_only_the_damaged_record(packed):
    parts = records(12, packed=packed)
    begins = [sum(map(len, parts[:k])) for k in range(12)]
    whole = bytearray(b"".join(parts))
    assert pages_of(read(bytes(whole))) == list(range(12)) and not gaps_of(read(bytes(whole)))
    rng = random.Random(5)
    for _ in range(40):
        hurt, k = bytearray(whole), rng.randrange(12)
        at = begins[k] + (rng.randrange(len(parts[k])) if packed else len(parts[k]) - 4 - rng.randint(1, 60))
        hurt[at] ^= 1 << rng.randrange(8)
        found = read(bytes(hurt))
        lost = set(range(12)) - set(pages_of(found))
        assert lost <= {k}  # nothing checks some bits of a gzip header
        assert gaps_of(found) == ([(begins[k], len(parts[k]))] if lost else [])


def test_junk_truncation_and_joined_formats():
    parts = records(3) + records(2, packed=False)
    data = b"junk" + parts[0] + b"\x1f\x8b\x08 WARC/1.0 \r\n" * 5 + b"".join(parts[1:])
    found = read(data)
    assert pages_of(found) == [0, 1, 2, 0, 1]
    assert gaps_of(found) == [(0, 4), (4 + len(parts[0]), 75)]
    found = read(data[:-7])
    assert pages_of(found) == [0, 1, 2, 0] and sum(n for _, n in gaps_of(found)) == 79 + len(parts[-1]) - 7
    assert read(b"") == [] and gaps_of(read(b"nothing here")) == [(0, 12)]
    assert pages_of(read(member(records(1, packed=False)[0] + records(1, 2, False)[0]))) == [0, 0]


def test_ranges_together_give_every_record_and_gap_once():
    parts = records(30)
    data = b"".join(parts[:7]) + b"#" * 700 + b"".join(parts[7:20]) + b"WARC/1." + b"".join(parts[20:])
    whole = read(data)
    for size in (100, 999, 5000):
        pieces = [f for a in range(0, len(data), size) for f in read(data, a, a + size)]
        assert pages_of(pieces) == list(range(30)) and gaps_of(pieces) == gaps_of(whole)


def test_round_trip(spark, monkeypatch):
    monkeypatch.setattr(warc, "RANGE_BYTES", 500)
    big = "é<p>" * 300_000
    rows = [(1, "http://a\r\nb c", "same"), (2, None, "same"), (5, "u", "same"), (5, "u", "same"), (6, "v", None), (7, "v", ""),
            (8, "w", "alone"), (9, "x", big), (10, "x", big), (None, "n", "same"), (None, "n", "lonely"), (11, "q", "WARC/1.1\r\n\r\n")]
    pages = spark.createDataFrame([(*r, "", "", "") for r in rows], SCHEMA).repartition(3)
    folder = new_folder(spark, "w")
    warc.write_archives(pages, folder)
    found = warc.read_archives(spark, folder, with_payload=True)
    assert warc.quarantine(found).count() == 0
    got = sorted((r.page_id or 0, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest) for r in found.collect())
    keep = {"same": 5, "": 7, big: 10}
    expected = []
    for i, _, html in rows:
        data = (html or "").encode()
        k = keep.get(html or "")
        other = k is not None and i != k
        expected.append((i or 0, "revisit" if other else "response", k if other else None, len(data), warc.sha1_text(data)))
    key = lambda r: tuple(map(str, r))
    assert sorted(got, key=key) == sorted(expected, key=key)
    for r in found.filter("record_type = 'response'").collect():
        assert warc.sha1_text(r.payload) == r.payload_digest
    plain = warc.write_archives(pages, new_folder(spark, "w"), revisit_from=5)
    assert plain.count() >= 1


def test_damaged_archive_is_quarantined(spark):
    pages = spark.createDataFrame([(i, "u", f"page {i} " * 50, "", "", "") for i in range(20)], SCHEMA).coalesce(1)
    folder = new_folder(spark, "w")
    name = warc.write_archives(pages, folder).first().name
    store, root = open_store(folder)
    with store.open_input_file(f"{root}/{name}") as f:
        data = bytearray(f.read())
    data[len(data) // 2 + 100] ^= 0xFF
    with store.open_output_stream(f"{root}/{name}", compression=None) as f:
        f.write(bytes(data))
    found = warc.read_archives(spark, folder)
    gaps = warc.quarantine(found).collect()
    assert len(gaps) == 1 and gaps[0].gap_bytes > 0 and gaps[0].reason
    assert found.filter("record_type IS NOT NULL").count() == 19


def test_no_pages(spark):
    folder = new_folder(spark, "w")
    warc.write_archives(spark.createDataFrame([], SCHEMA), folder)
    assert warc.read_archives(spark, folder).collect() == []
