"""Heavy keys: finding them in a bounded list and spreading their rows over shards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of one key that one task should see at most.
SHARD_ROWS = 200_000
#: Length of the list of heavy keys. Any key beyond it holds less than 1/MAX_HEAVY_KEYS of all rows.
MAX_HEAVY_KEYS = 4096


def heavy_keys(df: DataFrame, keys: list[str], shard_rows: int = SHARD_ROWS, max_keys: int = MAX_HEAVY_KEYS) -> DataFrame:
    """``keys`` with more than ``shard_rows`` rows and the number of shards each needs.

    The list has at most ``max_keys`` rows, whatever the input's size, so it may be broadcast. A key
    that misses the list has fewer rows than each one on it, hence under 1/``max_keys`` of the input;
    it stays in one shard, which changes the balance and not the result.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    return (
        counts.where(F.col("__n") > shard_rows)
        .orderBy(F.col("__n").desc(), *keys)
        .limit(max_keys)
        .select(*keys, F.ceil(F.col("__n") / F.lit(shard_rows)).cast("int").alias("__shards"))
    )


def spread(df: DataFrame, heavy: DataFrame, keys: list[str], by: Column) -> DataFrame:
    """Rows of ``df`` with a ``__shard`` from the hash of ``by``; always 0 for keys that are not heavy."""
    joined = df.join(F.broadcast(heavy), keys, "left")
    shard = F.pmod(F.xxhash64(by), F.coalesce("__shards", F.lit(1))).cast("int")
    return joined.withColumn("__shard", shard).drop("__shards")


def replicate(df: DataFrame, heavy: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``df`` once per shard of their key, to meet the rows that ``spread`` sent there."""
    joined = df.join(F.broadcast(heavy), keys, "left")
    last = F.coalesce("__shards", F.lit(1)) - 1
    return joined.withColumn("__shard", F.explode(F.sequence(F.lit(0), last))).drop("__shards")
