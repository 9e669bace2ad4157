"""Joins against a keyed lookup that stay balanced when a key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.scratch import measure

MAX_HOT_KEYS = 1000
SKETCHES_PER_TASK = 64
HOT_BYTES = 256 << 20  # measured size up to which the lookup rows of hot keys are broadcast
SALTS = 64
_HASH = "__key_hash"
_SALT = "__salt"


def hot_rows(spark: SparkSession) -> int:
    """Rows from which a key is kept out of the shuffle."""
    return int(spark.conf.get("spark.tidemark.hotRows", "1000000"))


def broadcast_bytes(spark: SparkSession) -> int:
    """Measured size up to which a lookup is broadcast."""
    return int(spark.conf.get("spark.tidemark.broadcastBytes", str(64 << 20)))


def fits_broadcast(spark: SparkSession, size: tuple[int, int] | None) -> bool:
    return size is not None and size[1] <= broadcast_bytes(spark)


def hot_key_hashes(df: DataFrame, keys: list[str]) -> list[int]:
    """Hashes of the most frequent keys, from bounded sketches over the key columns only, combined in
    two levels so that no task merges those of all input splits.

    A key missed by the sketches is merely not split off; results do not depend on it.
    """
    tracked = 10 * MAX_HOT_KEYS
    hashed = df.select(
        F.xxhash64(*keys).alias(_HASH), F.floor(F.spark_partition_id() / SKETCHES_PER_TASK).alias("g")
    )
    some = hashed.groupBy("g").agg(F.expr(f"approx_top_k_accumulate({_HASH}, {tracked})").alias("s"))
    top = some.agg(F.expr(f"approx_top_k_combine(s, {tracked})").alias("s")).select(
        F.expr(f"approx_top_k_estimate(s, {MAX_HOT_KEYS})").alias("top")
    )
    floor = hot_rows(df.sparkSession)
    return [t["item"] for t in top.first()["top"] or [] if t["count"] >= floor]


def _join(big: DataFrame, lookup: DataFrame, keys: list[str], how: str, null_safe: bool):
    if not null_safe:
        return big.join(lookup, keys, how)
    renamed = lookup.withColumnsRenamed({k: f"__lookup_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"__lookup_{k}")) for k in keys]
    return big.join(renamed, same, how).drop(*(f"__lookup_{k}" for k in keys))


def lookup_join(
    big: DataFrame,
    lookup: DataFrame,
    keys: list[str],
    how: str = "left",
    *,
    size: tuple[int, int] | None = None,
    hot: list[int] | None = None,
    null_safe: bool = False,
) -> DataFrame:
    """Join ``big`` with ``lookup``, which has at most one row per key (left, inner, left_semi or
    left_anti).

    ``size`` is the measured (rows, bytes) of the lookup: a small one is broadcast and ``big`` does
    not move. Otherwise both sides are shuffled, except for the hot keys of ``big``: those rows stay
    in place and meet the at most ``MAX_HOT_KEYS`` lookup rows of the same key hashes by broadcast, or,
    where these rows are too wide for that, are dealt out by a salt.
    ``hot`` passes the hot hashes when the caller knows them already.
    """
    for k in keys:
        if big.schema[k].dataType != lookup.schema[k].dataType:
            raise TypeError(f"join key '{k}' has different types on the two sides")
    if fits_broadcast(big.sparkSession, size):
        return _join(big, F.broadcast(lookup), keys, how, null_safe)
    if hot is None:
        hot = hot_key_hashes(big, keys)
    if not hot:
        return _join(big, lookup, keys, how, null_safe)
    is_hot = F.xxhash64(*keys).isin(hot)
    hot_lookup = lookup.filter(is_hot)
    if measure(hot_lookup)[1] <= HOT_BYTES:
        in_place = _join(big.filter(is_hot), F.broadcast(hot_lookup), keys, how, null_safe)
    else:  # at most MAX_HOT_KEYS wide rows: repeat them and deal the rows of a key over many tasks
        dealt = big.filter(is_hot).withColumn(_SALT, F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)))
        salts = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long")))
        repeated = hot_lookup.withColumn(_SALT, salts)
        in_place = _join(dealt, repeated, [*keys, _SALT], how, null_safe).drop(_SALT)
    shuffled = _join(big.filter(~is_hot), lookup.filter(~is_hot), keys, how, null_safe)
    return in_place.unionByName(shuffled)
