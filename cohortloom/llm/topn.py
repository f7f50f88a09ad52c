"""The N highest values of every group, also of groups that hold most rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.session import cut_lineage

#: Rows that a task gathers before it drops those under their group's bound.
GATHER_ROWS = 1 << 18
#: Bounds that are broadcast: those of the groups with the most kept rows. The other groups, each with
#: fewer rows than any of these, meet their bound behind the shuffle.
LISTED_GROUPS = 1 << 16


class LocalBest:
    """Per group the ``n`` best distinct items of one partition, and the ``n``-th best value as a bound."""

    def __init__(self, n: int) -> None:
        self.n = n
        self.rows: list[pa.Table] = []
        self.gathered = self.kept_rows = 0
        self.groups: pa.Array | None = None
        self.bounds = np.empty(0)

    def add(self, table: pa.Table) -> None:
        """Take ``group, item, value`` rows with finite values; rows under a known bound are dropped at once."""
        if self.groups is not None and table.num_rows:
            at = pc.index_in(table["group"].combine_chunks(), value_set=self.groups).to_numpy(zero_copy_only=False)
            at = np.where(np.isnan(at), -1, at).astype(np.int64)
            bound = np.append(self.bounds, -np.inf)[at]
            table = table.filter(pa.array(table["value"].to_numpy() >= bound))
        self.rows.append(table)
        self.gathered += table.num_rows
        if self.gathered > max(GATHER_ROWS, self.kept_rows):  # so that many groups are not sorted anew for few rows
            self.shrink()

    def shrink(self) -> pa.Table | None:
        """Reduce what was gathered to the local best, and set the bounds by it."""
        if not self.rows:
            return None
        table = pa.concat_tables(self.rows).combine_chunks()
        if not table.num_rows:
            return table
        as_codes = lambda name: pc.dictionary_encode(table[name].combine_chunks())
        group, item = as_codes("group"), as_codes("item")
        g = group.indices.to_numpy()
        place = np.empty(len(item.dictionary), np.int64)
        place[pc.array_sort_indices(item.dictionary).to_numpy()] = np.arange(len(place))
        i, v = place[item.indices.to_numpy()], table["value"].to_numpy()
        order = np.lexsort((-v, i, g))
        first = np.ones(len(order), bool)
        first[1:] = (g[order][1:] != g[order][:-1]) | (i[order][1:] != i[order][:-1])
        order = order[first]
        order = order[np.lexsort((i[order], -v[order], g[order]))]
        starts = np.ones(len(order), bool)
        starts[1:] = g[order][1:] != g[order][:-1]
        here = np.arange(len(order))
        rank = here - np.maximum.accumulate(np.where(starts, here, 0))
        order = order[rank < self.n]
        nth = rank[rank < self.n] == self.n - 1
        self.bounds = np.full(len(group.dictionary), -np.inf)
        self.bounds[g[order][nth]] = v[order][nth]
        self.groups = group.dictionary
        bound = self.bounds[g[order]]
        kept = table.take(pa.array(order))
        self.rows, self.gathered, self.kept_rows = [kept], 0, kept.num_rows
        return kept.append_column("bound", pa.array(bound, mask=np.isinf(bound)))


def top_n(df: DataFrame, group: str, item: str, value: str, n: int = 5) -> DataFrame:
    """``group, item, rank_no``: the ``n`` items of each group with the highest values.

    Each task keeps the ``n`` best of every group in its partition; its ``n``-th best value is a lower
    bound of the group's. The kept rows go to the checkpoint folder, so that the input is read once.
    The highest bound of each group over all partitions, an aggregation of one row per group and
    partition, is joined back to the kept rows where they lie and drops those under it before they are
    shuffled; the survivors are ranked: by value from high to low, then by item. This join is a
    broadcast of at most ``LISTED_GROUPS`` bounds, those of the groups in most partitions; the rows of
    the other groups meet their bound behind the shuffle by group.

    An item counts once per group, with its highest finite value. Null, NaN and infinite values, and
    rows with a null group or item, don't count; a group without any finite value has no rows; one with
    fewer than ``n`` items has them all. -0.0 equals 0.0. Names of other columns don't matter.
    """
    v = F.col(value)
    finite = v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))
    rows = df.where(finite & F.col(group).isNotNull() & F.col(item).isNotNull())
    rows = rows.select(F.col(group).alias("group"), F.col(item).alias("item"), (v.cast("double") + F.lit(0.0)).alias("value"))
    kinds = {c: rows.schema[c].dataType.simpleString() for c in ("group", "item")}

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = LocalBest(n)
        for batch in batches:
            best.add(pa.Table.from_batches([batch]))
        kept = best.shrink()
        if kept is not None and kept.num_rows:
            yield from kept.to_batches(max_chunksize=65_536)

    kept = cut_lineage(rows.mapInArrow(local, f"`group` {kinds['group']}, item {kinds['item']}, value double, bound double"))
    met = kept.join(F.broadcast(listed_bounds(kept, n)), "group", "left")
    met = met.where(F.col("listed").isNull() | (F.col("value") >= F.col("listed"))).drop("listed")
    bounded = met.withColumn("highest", F.max("bound").over(Window.partitionBy("group")))
    survivors = bounded.where(F.col("highest").isNull() | (F.col("value") >= F.col("highest")))
    once = survivors.groupBy("group", "item").agg(F.max("value").alias("value"))
    ranked = once.withColumn("rank_no", F.row_number().over(Window.partitionBy("group").orderBy(F.col("value").desc(), "item")).cast("long"))
    return ranked.where(F.col("rank_no") <= n).select(F.col("group").alias(group), F.col("item").alias(item), "rank_no")


def listed_bounds(kept: DataFrame, n: int, most: int = LISTED_GROUPS) -> DataFrame:
    """``group, listed``: the highest local bound of the ``most`` groups with the most kept rows beyond ``n``."""
    bounds = kept.groupBy("group").agg(F.max("bound").alias("listed"), F.count(F.lit(1)).alias("kept"))
    bounds = bounds.where(F.col("listed").isNotNull() & (F.col("kept") > n))
    return bounds.orderBy(F.col("kept").desc(), "group").limit(most).select("group", "listed")
