"""References to records that do not exist, told apart as missing, late or withdrawn."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.functions.text import accession
from cohortloom.operators.skew import SHARD_ROWS, heavy_keys, replicate, spread

_KEY = ["key_kind", "key"]


def merge_intervals(spans: DataFrame, by: list[str]) -> DataFrame:
    """The union of the half-open intervals ``begin, end`` of each ``by`` as disjoint ones; touching ones become one."""
    ordered = Window.partitionBy(*by).orderBy("begin", "end")
    before = F.max("end").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(before.isNull() | (F.col("begin") > before), 1).otherwise(0)
    marked = spans.select(*by, "begin", "end", opens.alias("__opens"))
    numbered = marked.withColumn("__island", F.sum("__opens").over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(*by, "__island").agg(F.min("begin").alias("begin"), F.max("end").alias("end")).drop("__island")


def parent_intervals(parents: DataFrame, removals: DataFrame) -> DataFrame:
    """Validity of every parent key as a stream of events ``key_kind, key, at, known, arrived, live``.

    ``parents`` has ``key_kind, key, record, arrived_at``: the records that carry each key.
    ``removals`` has ``record, removed_at``. A record is valid from its earliest arrival up to, not
    including, its earliest removal. A key is valid while any of its records is: records never removed
    make one open interval, from the earliest of them on; the others' intervals are merged, first those
    that begin on the same day, then all of the key. So however many records carry a key, and whether
    they were removed or not, its events are as few as its disjoint intervals, and one task merges no
    more than a day's records or one row for each of a key's days and gaps.
    """
    carried = parents.groupBy(*_KEY, "record").agg(F.min("arrived_at").alias("arrived_at"))
    removed = removals.where(F.col("record").isNotNull()).groupBy("record").agg(F.min("removed_at").alias("removed_at"))
    none = F.lit(None)
    both = carried.withColumn("removed_at", none.cast("timestamp_ntz")).unionByName(
        removed.select(none.cast("string").alias("key_kind"), none.cast("string").alias("key"), "record", none.cast("timestamp_ntz").alias("arrived_at"), "removed_at")
    )
    of_record = Window.partitionBy("record")
    lives = both.select(*_KEY, F.min("arrived_at").over(of_record).alias("begin"), F.min("removed_at").over(of_record).alias("end"))
    held = lives.where(F.col("key").isNotNull())
    firsts = held.groupBy(*_KEY).agg(F.min("begin").alias("first_at"), F.min(F.when(F.col("end").isNull(), F.col("begin"))).alias("open_at"))
    event = lambda at, known, arrived, live: F.struct(
        at.alias("at"), F.lit(known).alias("known"), F.lit(arrived).alias("arrived"), F.lit(live).alias("live")
    )
    per_key = F.array(
        event(none.cast("timestamp_ntz"), 1, 0, 0),
        F.when(F.col("first_at").isNotNull(), event(F.col("first_at"), 1, 1, 0)),
        F.when(F.col("open_at").isNotNull(), event(F.col("open_at"), 1, 0, 1)),
    )
    once = firsts.withColumn("e", F.explode(per_key)).where(F.col("e").isNotNull())
    closed = held.where(F.col("end") > F.col("begin")).withColumn("__day", F.to_date("begin"))
    merged = merge_intervals(merge_intervals(closed, [*_KEY, "__day"]), _KEY)
    finite = merged.withColumn("e", F.explode(F.array(event(F.col("begin"), 1, 0, 1), event(F.col("end"), 1, 0, -1))))
    return reduce(DataFrame.unionByName, [d.select(*_KEY, "e.*") for d in (once, finite)])


def orphan_references(references: DataFrame, parents: DataFrame, removals: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``references`` without a valid parent at their time, with a ``status``.

    ``references`` has ``key_kind, key, src_table, row_id, ref_field, at``. Both streams go to the same
    partitions by key, are sorted by time, parents first, and merged in one pass that keeps three
    running counters (parent known, any arrived, how many valid):

    * ``missing``: no record carries the key;
    * ``late``: none had arrived at or before the reference's time;
    * ``withdrawn``: each that had arrived was removed at or before that time.

    Keys with very many references are spread over shards, each with a copy of the key's parent events,
    which are as few as its disjoint validity intervals. A reference with a null key is no reference. One with a null time is ``missing`` if the key
    is unknown and otherwise no case, since nothing can be said of that time. Repeated rows each count.
    Empty inputs give an empty result, or only ``missing`` where there are no parents.
    """
    held = references.where(F.col("key").isNotNull())
    heavy = heavy_keys(held, _KEY, shard_rows)
    events = parent_intervals(parents.where(F.col("key").isNotNull() & F.col("record").isNotNull()), removals)
    none = F.lit(None)
    left = replicate(events, heavy, _KEY).select(
        *_KEY, "__shard", "at", F.lit(0).alias("__side"), "known", "arrived", "live",
        none.cast("string").alias("src_table"), none.cast("long").alias("row_id"), none.cast("string").alias("ref_field"),
    )
    right = spread(held, heavy, _KEY, F.struct("src_table", "row_id", "ref_field")).select(
        *_KEY, "__shard", "at", F.lit(1).alias("__side"), F.lit(0).alias("known"), F.lit(0).alias("arrived"), F.lit(0).alias("live"),
        "src_table", "row_id", "ref_field",
    )
    merged = Window.partitionBy(*_KEY, "__shard").orderBy("at", "__side").rowsBetween(Window.unboundedPreceding, 0)
    so_far = left.unionByName(right).select(
        "__side", "src_table", "row_id", "ref_field", "at",
        F.max("known").over(merged).alias("known"), F.sum("arrived").over(merged).alias("arrived"), F.sum("live").over(merged).alias("live"),
    )
    status = (
        F.when(F.col("known") == 0, "missing")
        .when(F.col("at").isNull(), None)
        .when(F.col("arrived") == 0, "late")
        .when(F.col("live") == 0, "withdrawn")
    )
    return (
        so_far.where(F.col("__side") == 1)
        .select("src_table", "row_id", "ref_field", F.date_format("at", "yyyy-MM").alias("ref_month"), status.alias("status"))
        .where(F.col("status").isNotNull())
    )


def run_references(override_rows: DataFrame, run_metadata: DataFrame) -> DataFrame:
    """The accessions that override and metadata rows name, one row per non-blank reference."""
    part = lambda df, name, row, field, kind, at: df.select(
        F.lit(kind).alias("key_kind"), accession(field).alias("key"), F.lit(name).alias("src_table"),
        F.col(row).cast("long").alias("row_id"), F.lit(field).alias("ref_field"), F.col(at).cast("timestamp_ntz").alias("at"),
    )
    return reduce(
        DataFrame.unionByName,
        [
            part(override_rows, "override_rows", "override_row_id", "run_accession", "run", "added_at"),
            part(override_rows, "override_rows", "override_row_id", "sample_accession", "sample", "added_at"),
            part(run_metadata, "run_metadata", "meta_id", "run_accession", "run", "updated_at"),
        ],
    )


def run_parents(runs: DataFrame) -> DataFrame:
    """Runs under their own accession and under the samples they carry."""
    base = runs.select(accession("run_accession").alias("record"), accession("sample_accession").alias("sample"), F.col("ingested_at").cast("timestamp_ntz").alias("arrived_at"))
    keys = F.array(F.struct(F.lit("run").alias("key_kind"), F.col("record").alias("key")), F.struct(F.lit("sample").alias("key_kind"), F.col("sample").alias("key")))
    return base.withColumn("k", F.explode(keys)).select("k.*", "record", "arrived_at")


def run_removals(withdrawals: DataFrame) -> DataFrame:
    return withdrawals.select(accession("run_accession").alias("record"), F.col("withdrawn_at").cast("timestamp_ntz").alias("removed_at")).where(F.col("removed_at").isNotNull())


def orphan_report(orphans: DataFrame) -> DataFrame:
    """Orphan references counted per table, field, month and status."""
    return orphans.groupBy("src_table", "ref_field", "ref_month", "status").agg(F.count(F.lit(1)).alias("n_refs"))
