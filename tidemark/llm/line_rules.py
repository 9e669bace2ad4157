"""Quality rules over whole texts, with DataFrame functions only.

The rule across documents: every line is normalised and hashed, the distinct documents that hold it are
counted per host, lines held by too many are removed, and a document that loses too much of its text
that way is depleted and rejected. Exact copies count as one document: that a text was copied is a
matter for deduplication and says nothing about its lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.scratch import Scratch

SPACE = r"[\x20\x09-\x0D]+"
NOT_SYMBOLS = r"[^#*$%&|<>]+"
WINDOW = 5


def zero() -> Column:
    return F.lit(0).cast("long")


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once per row."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    """Runs of characters other than ASCII white space."""
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def _sum(values: Column) -> Column:
    return F.aggregate(values, zero(), lambda total, x: total + x)


def _repeated_words(words: Column) -> Column:
    """Number of words inside windows of five words that occur twice or more in the text."""
    last = F.size(words) - WINDOW
    hashes = F.transform(
        F.sequence(F.lit(0), last),
        lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)]),
    )

    def repeated_places(hashes: Column) -> Column:
        ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        repeated = let(
            ordered,
            lambda o: F.filter(
                o, lambda x, k: (x["h"] == F.get(o, k - 1)["h"]) | (x["h"] == F.get(o, k + 1)["h"])
            ),
        )
        return F.sort_array(F.transform(repeated, lambda x: x["i"]))

    def covered(places: Column) -> Column:
        def to_next(place, k):
            return F.least(F.coalesce(F.get(places, k + 1) - place, F.lit(WINDOW)), F.lit(WINDOW))

        return _sum(F.transform(places, lambda p, k: to_next(p, k).cast("long")))

    def count(hashes: Column) -> Column:
        all_differ = F.size(F.array_distinct(hashes)) == F.size(hashes)
        return F.when(all_differ, zero()).otherwise(let(repeated_places(hashes), covered))

    return F.when(last < 0, zero()).otherwise(let(hashes, count))


def measures() -> list[Column]:
    """Per-text columns n_words, n_repeat_words (in ``words``), word_chars, n_symbols, n_dup_lines."""
    text = F.coalesce("text", F.lit(""))
    with_words = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    keys = F.transform(with_words, lambda x: F.xxhash64(x))
    return [
        let(
            words_of(text),
            lambda w: F.struct(F.size(w).cast("long").alias("n"), _repeated_words(w).alias("repeated")),
        ).alias("words"),
        F.length(F.regexp_replace(text, SPACE, "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace(text, NOT_SYMBOLS, "")).cast("long").alias("n_symbols"),
        let(keys, lambda k: F.size(k) - F.size(F.array_distinct(k))).cast("long").alias("n_dup_lines"),
    ]


def line_keys() -> Column:
    """Hash and number of words of each line that is not blank, after lower-casing, making digits 0
    and white space runs one space."""
    text = F.regexp_replace(F.lower(F.coalesce("text", F.lit(""))), "[0-9]", "0")
    lines = F.transform(F.split(text, "\n"), lambda x: F.trim(F.regexp_replace(x, SPACE, " ")))
    return F.transform(
        F.filter(lines, lambda x: x != ""),
        lambda x: F.struct(F.xxhash64(x).alias("line"), F.size(F.split(x, " ")).alias("words")),
    )


def apply_rules(
    docs: DataFrame,
    more_than_docs: int = 20,
    more_than_share: float = 0.05,
    least_left: float = 0.5,
    host: str = "source",
    scratch: Scratch | None = None,
) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, host column): measures, words removed, verdicts.

    A line goes when more than ``more_than_docs`` different texts of its host hold it and these are
    more than the share ``more_than_share`` of the host's texts. ``base_failed``: under 10 words, or
    over 20 % of the words in repeated windows. ``depleted``: less than ``least_left`` of the words
    are left. ``kept``: neither. Null text is empty (base_failed), a null host counts as the empty one;
    repeated rows each give their own row; other columns are dropped.
    """
    scratch = scratch or Scratch(docs.sparkSession)
    read = scratch.table(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            "doc_id",
            F.coalesce(F.col(host).cast("string"), F.lit("")).alias("host"),
            F.xxhash64(F.coalesce("text", F.lit(""))).alias("copy"),
            *measures(),
            line_keys().alias("lines"),
        )
    )
    texts = read.groupBy("host", "copy").agg(F.first("lines").alias("lines"))
    sizes = texts.groupBy("host").agg(F.count(F.lit(1)).alias("texts"))
    held = texts.select("host", F.explode(F.array_distinct("lines.line")).alias("line"))
    counted = held.groupBy("host", "line").agg(F.count(F.lit(1)).alias("holding"))
    frequent = scratch.table(
        counted.filter(F.col("holding") > more_than_docs)
        .join(sizes, "host")
        .filter(F.col("holding") > F.col("texts") * more_than_share)
        .select("host", "line")
    )
    removed = (
        read.select("row", "host", F.explode("lines").alias("l"))
        .select("row", "host", "l.line", "l.words")
        .join(frequent, ["host", "line"])
        .groupBy("row")
        .agg(F.sum("words").alias("removed"))
    )
    judged = read.drop("lines").join(removed, "row", "left")
    n = F.col("words.n")
    return (
        judged.withColumn("words_removed", F.coalesce("removed", zero()))
        .withColumn("base_failed", (n < 10) | (F.col("words.repeated") * 100 > n * 20))
        .withColumn("depleted", n - F.col("words_removed") < n * least_left)
        .select(
            "doc_id", n.alias("n_words"), "word_chars", "n_symbols", "n_dup_lines",
            F.col("words.repeated").alias("n_repeat_words"), "base_failed",
            (~F.col("base_failed") & ~F.col("depleted")).alias("kept"), "words_removed", "depleted",
        )
    )
