from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from public_tokenizers import path
from tokenizers import Tokenizer

import corpus_pipeline

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """A small corpus in which each stage has something to do."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choices("abcdefghijklm", k=rng.randint(2, 8)))
    text = lambda n: " ".join(word() for _ in range(n))
    docs = {i: text(rng.randint(150, 400)) for i in range(160)}
    for i in range(0, 160, 4):
        docs[i] += " idiot moron" * rng.randint(1, 4)
    docs[200], docs[201] = docs[1], docs[3]
    docs[202] = docs[5] + " end"
    passage = text(120)
    docs[301], docs[302] = text(80) + " " + passage, passage + " " + text(90)
    items = [(k, text(40)) for k in range(5)]
    docs[401] = text(100) + " " + items[2][1].upper() + ". " + text(100)
    docs[402], docs[403] = None, ""
    docs[404] = text(9000)
    out = tmp_path_factory.mktemp("corpus")
    rows = [(i, t, "en", "s", len(t or "")) for i, t in docs.items()]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{out}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{out}/benchmark.parquet")
    labels = [(i, 1, int(i % 4 == 0)) for i in range(120)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{out}/labels.parquet")
    return str(out), docs, passage


def test_stages_by_hand(spark, folder):
    out, texts, passage = folder
    docs = spark.read.parquet(f"{out}/documents.parquet")
    seen = [set(texts)]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        before = docs.columns
        docs = stage(spark, docs, out)
        assert docs.columns == before
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        seen.append({r.doc_id for r in docs.collect()})
    toxic, copies, cut, leaks = (a - b for a, b in zip(seen, seen[1:]))
    assert toxic == set(range(0, 160, 4))
    assert copies == {200, 201, 202, 403}
    assert cut == set()
    assert leaks == {401}
    kept = {r.doc_id: r.text for r in docs.collect()}
    assert kept[301] == texts[301]
    assert passage[20:-20] not in kept[302] and kept[302].endswith(texts[302][-300:])
    assert all(kept[i] == texts[i] for i in kept if i != 302)
    assert all(r.n_chars == len(r.text or "") for r in docs.collect())


def test_run_packs_what_is_left(spark, folder):
    out, texts, _ = folder
    rows = corpus_pipeline.run(spark, out).collect()
    tokenizer = Tokenizer.from_file(path("word_bpe_49k.json"))
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
    assert set(by_doc) == set(texts) - set(range(0, 160, 4)) - {200, 201, 202, 403, 401}
    for i, parts in by_doc.items():
        if i == 302:
            continue
        ids = np.array(tokenizer.encode(texts[i] or "", add_special_tokens=False).ids + [0], dtype="<u4")
        for r in parts:
            piece = ids[r.start : r.start + r.length]
            assert len(piece) == r.length and zlib.crc32(piece.tobytes()) == r.ids_crc32
        assert sum(r.length for r in parts) == len(ids)
    places = {}
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for found in places.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= 2048


def test_stages_on_empty_tables(spark, folder):
    out = folder[0]
    docs = spark.read.parquet(f"{out}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, out).collect() == []


def test_queries_are_registered():
    import __spark_entry__ as contract

    names = contract.queries()
    assert "pipeline" in names and sorted(int(n[2:].split("_")[0]) for n in names if n.startswith("op")) == list(range(1, 14))
    assert set(contract.oracle_sql()) <= set(names)
