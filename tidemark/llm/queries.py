"""The queries opN_<name> and ``pipeline``: thin derivations from the operators of this package."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from public_tokenizers import path as tokenizer_path
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    decontaminate,
    language,
    line_rules,
    packing,
    pseudo_likelihood,
    repeats,
    resample,
    runs,
    severity,
    simhash,
    templates,
    token_files,
    warc,
)
from tidemark.llm.line_rules import let, words_of
from tidemark.llm.tables import new_folder, small_batches, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
TOKENIZER = "word_bpe_49k.json"
CAPACITY = 2048


SQL["op2_line_rules"] = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t, coalesce(source, '') AS host
           FROM documents),
m AS (SELECT rid, doc_id, host, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls,
        list_filter(list_transform(string_split(regexp_replace(lower(t), '[0-9]', '0', 'g'), chr(10)),
          lambda x: trim(regexp_replace(x, '[\x20\x09-\x0D]+', ' ', 'g'), ' ')), lambda x: x <> '') AS ns
      FROM d),
windows AS (SELECT rid, i, list_slice(ws, i, i + 4) AS g FROM (
              SELECT rid, ws, unnest(range(1, greatest(len(ws) - 3, 1))) AS i FROM m)),
twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM windows) WHERE c > 1),
repeated AS (SELECT rid, sum(least(5, coalesce(next - i, 5))) AS words FROM (
               SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS next FROM twice) GROUP BY rid),
ln AS (SELECT rid, host, t, unnest(ns) AS line FROM m),
counted AS (SELECT host, line, count(DISTINCT t) AS holding FROM ln GROUP BY ALL),
texts AS (SELECT host, count(DISTINCT t) AS texts FROM d GROUP BY host),
frequent AS (SELECT c.host, c.line FROM counted c JOIN texts USING (host)
             WHERE holding > 20 AND holding > texts * 0.05),
removed AS (SELECT rid, sum(len(string_split(line, ' '))) AS words FROM ln JOIN frequent USING (host, line)
            GROUP BY rid),
judged AS (SELECT m.*, len(ws) AS n, coalesce(repeated.words, 0) AS again, coalesce(removed.words, 0) AS gone
           FROM m LEFT JOIN repeated USING (rid) LEFT JOIN removed USING (rid)),
flagged AS (SELECT *, n < 10 OR 100 * again > 20 * n AS base_failed, n - gone < n * 0.5 AS depleted FROM judged)
SELECT doc_id, n::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
       length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
       (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, again::BIGINT AS n_repeat_words, base_failed,
       NOT base_failed AND NOT depleted AS kept, gone::BIGINT AS words_removed, depleted
FROM flagged
"""


SQL["op5_warc"] = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload, sha1(coalesce(html, '')) AS hex FROM pages),
k AS (SELECT *, max(page_id) OVER (PARTITION BY hex) AS keeper FROM p)
SELECT page_id, octet_length(payload) AS payload_bytes,
       list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + ((('0x' || substr(hex, 1 + 5 * (i // 4), 5))::BIGINT >> (15 - 5 * (i % 4))) & 31), 1)), 'string_agg', '')
         AS payload_digest,
       CASE WHEN page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> keeper THEN keeper END AS refers_to
FROM k
"""


def query(fn):
    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return run


@query
def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 ids."""
    pieces = packing.cut_pieces(table(spark, sf_dir, "documents"), tokenizer_path(TOKENIZER), CAPACITY)
    return packing.pack(pieces, CAPACITY)


@query
def op2_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdicts of the quality rules for all documents."""
    return line_rules.apply_rules(table(spark, sf_dir, "documents"))


@query
def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written as token-id files and read back from them."""
    folder = new_folder(spark, "tokens")
    token_files.write_tokens(table(spark, sf_dir, "documents"), folder, tokenizer_path(TOKENIZER))
    return token_files.read_tokens(spark, folder)


@query
def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of all documents."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.as_hex().alias("fingerprint"), "component_id")


@query
def op7_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of all documents that belong to a repeated string of 400 bytes. ``left`` is what is left without
    them; ``text`` keeps each such string where it first starts, so that its first holder stays as it is."""
    found = repeats.digests(table(spark, sf_dir, "documents"), 400, keep_first=False)
    digest = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    return found.select(*digest, F.col("deduplicated").alias("text"), F.col("text").alias("left"), "n_later")


@query
def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC records, equal payloads once, and read back from the archives."""
    folder = new_folder(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), folder)
    records = warc.read_archives(spark, folder).filter("record_type IS NOT NULL")
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op8_site_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    return templates.extract(table(spark, sf_dir, "pages"))


@query
def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents that hold a passage of a benchmark item, with the item and the place."""
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op10_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected severity of all documents and whether they count as toxic."""
    docs = table(spark, sf_dir, "documents")
    graded = severity.grade(docs.select("doc_id", "text"), severity.fit(docs, table(spark, sf_dir, "labels")))
    return graded.select("doc_id", "p_toxic", "expected_severity", (F.col("p_toxic") >= 0.5).alias("toxic"))


@query
def op9_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language-model scores of all documents."""
    return pseudo_likelihood.score_documents(table(spark, sf_dir, "documents"))


@query
def op11_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents, from models that a third of them, the held-out ones, has no part in."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(language.fold_of(F.col("doc_id")) == 1, F.lit(False))
    model = language.fit(docs.filter(~held_out))
    found = language.identify(docs.select("doc_id", held_out.alias("held_out"), "text"), model)
    return found.select("doc_id", "held_out", "lang_pred", "score", "rejected")


def _with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id and text, of which each tenth document repeats a stretch of its own words up to its end."""
    hashed = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(hashed / 10).cast("long")

    def repeat(words):
        n = F.size(words).cast("long")
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        place = lambda i: F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")
        return F.when(n > 0, F.array_join(F.transform(words, lambda _, i: F.get(words, place(i))), " "))

    planted = F.coalesce(let(words_of(F.col("text")), repeat), F.col("text"))
    return docs.select("doc_id", F.when(hashed % 10 == 0, planted).otherwise(F.col("text")).alias("text"))


@query
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of periodic words in all documents, of which some have been planted, and what is left."""
    found = runs.periodic_runs(_with_planted_runs(table(spark, sf_dir, "documents"))).drop("text")
    order = F.transform("runs", lambda r: F.struct(-r["length"], r["start"], r["period"]))
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    longest = F.get(F.sort_array(order), F.lit(0))
    return found.withColumn("longest", longest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("longest.start").alias("start"),
        (-F.col("longest.col1")).alias("length"),
        F.col("longest.period").alias("period"),
        F.floor(-1000 * F.col("longest.col1") / F.col("longest.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query
def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights, scores and ranks of all documents, drawn towards the benchmark's texts."""
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
