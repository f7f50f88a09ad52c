"""Mutable tables on immutable files: an append-only log of changes and the views folded from it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _payload(log: DataFrame, keys: list[str], seq: list[str]) -> list[str]:
    return [c for c in log.columns if c not in {*keys, *seq, "op"}]


def latest(log: DataFrame, keys: list[str], seq: list[str]) -> DataFrame:
    """INSERT OR REPLACE: the last row of each key. One partial aggregation, whatever a key's share."""
    rest = _payload(log, keys, seq)
    return log.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*seq)).alias("p")).select(*keys, "p.*")


def earliest(log: DataFrame, keys: list[str], seq: list[str]) -> DataFrame:
    """INSERT OR IGNORE: the first row of each key."""
    rest = _payload(log, keys, seq)
    return log.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*seq)).alias("p")).select(*keys, "p.*")


def with_tombstones(log: DataFrame, keys: list[str], seq: list[str]) -> DataFrame:
    """The last row of each key unless that is a deletion (``op`` = ``D``)."""
    rest = _payload(log, keys, seq)
    last = log.groupBy(*keys).agg(F.max_by(F.struct("op", *rest), F.struct(*seq)).alias("p"))
    return last.where(F.col("p.op") != "D").select(*keys, *[F.col(f"p.{c}").alias(c) for c in rest])


def last_batch(log: DataFrame, keys: list[str], batch: str) -> DataFrame:
    """Delete-then-insert: all rows of each key's last batch."""
    newest = log.groupBy(*keys).agg(F.max(batch).alias(batch))
    return log.join(newest, [*keys, batch], "left_semi")


def upsert_runs(log: DataFrame, keys: list[str], seq: list[str], kept: list[str]) -> DataFrame:
    """A run delivered again: all columns of the last delivery, but ``kept`` (its state) of the first."""
    rest = [c for c in _payload(log, keys, seq) if c not in kept]
    order = F.struct(*seq)
    folded = log.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("p"), F.min_by(F.struct(*kept), order).alias("q"))
    return folded.select(*keys, "p.*", "q.*")


def apply_state_changes(runs: DataFrame, changes: DataFrame, key: str, seq: str = "seq") -> DataFrame:
    """``runs`` with the state of the last change of each; a run without changes keeps its own."""
    last = changes.groupBy(key).agg(F.max_by("state", seq).alias("__state"))
    return runs.join(last, key, "left").withColumn("state", F.coalesce("__state", "state")).drop("__state")


def backfill(runs: DataFrame, metadata: DataFrame, key: str) -> DataFrame:
    """Runs that have no attribute rows yet."""
    return runs.join(metadata.select(key), key, "left_anti")


def first_of_kind(artifacts: DataFrame, run: str, kinds: list[str], order: list[str], kind: str = "kind", value: str = "path") -> DataFrame:
    """One column per kind with each run's first artifact of it."""
    pick = [F.min_by(value, F.when(F.col(kind) == k, F.struct(*order))).alias(k) for k in kinds]
    return artifacts.where(F.col(kind).isin(*kinds)).groupBy(run).agg(*pick)


def split_valid(runs: DataFrame, artifacts: DataFrame, run: str, needed: list[str], size: str = "bytes", kind: str = "kind") -> DataFrame:
    """Runs with ``valid``: whether all needed kinds have an artifact that is not empty."""
    have = artifacts.where(F.col(kind).isin(*needed) & (F.col(size) > 0)).groupBy(run).agg(F.count_distinct(kind).alias("__n"))
    return runs.join(have, run, "left").withColumn("valid", F.coalesce("__n", F.lit(0)) == len(set(needed))).drop("__n")


def key_union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.union, parts).distinct()


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key."""
    return df.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("__n") == 1).drop("__n")
