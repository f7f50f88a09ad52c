"""Filling containers of fixed capacity with items of varying length."""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Tokens of one container, and items that one packer places. More packers mean more containers that
#: stay open at their ends: at most one for each level, in practice some tens.
CAPACITY = 2048
SHARD_ITEMS = 16_384


class SumOfSquares:
    """Online packing that keeps the levels of the open containers as evenly used as it can.

    ``counts[h]`` is how many containers are filled up to level ``h``, ``open[h]`` which ones. An item
    of size s moves a container from h to h + s, or opens one; taken is the h for which the sum of the
    squared counts of partly filled containers grows least, the fullest of them if several are equal.
    """

    def __init__(self, capacity: int) -> None:
        self.capacity = capacity
        self.counts = np.zeros(capacity + 1, np.int64)
        self.open: list[list[int]] = [[] for _ in range(capacity)]
        self.used = 0

    def place(self, size: int) -> tuple[int, int]:
        """Container and starting level of an item of 1 to ``capacity`` units."""
        c = self.capacity
        if size == c:
            self.used += 1
            return self.used - 1, 0
        counts = self.counts
        # Growth of the sum for each level h = 0 .. c - size; level 0 (a new container) and c count nothing.
        growth = 2 * (counts[size : c + 1] - counts[: c - size + 1]) + 2
        growth[0] = 2 * counts[size] + 1
        growth[-1] = 1 - 2 * counts[c - size]
        closed = counts[: c - size + 1] == 0
        closed[0] = False
        growth[closed] = np.iinfo(np.int64).max
        level = c - size - int(growth[::-1].argmin())
        if level:
            container = self.open[level].pop()
            counts[level] -= 1
        else:
            container = self.used
            self.used += 1
        if level + size < c:
            self.open[level + size].append(container)
            counts[level + size] += 1
        return container, level


def pack(items: DataFrame, key: str, size: str, capacity: int = CAPACITY, shard_items: int = SHARD_ITEMS, total: int | None = None) -> DataFrame:
    """Assign every item to a container: ``key, piece_no, container_id, start_at, n_tokens``.

    Items go to shards by the hash of their key, about ``shard_items`` to each, so the number of shards
    grows with the input (``total``, the number of items, is counted unless the caller knows it); each shard is packed by itself, in order of the key, by the sum-of-squares
    rule with a level array. Memory per task is the level array and the open containers' numbers.

    An item larger than ``capacity`` is cut: its full pieces fill a container each and the rest is an
    item like any other; no other item is cut. Items of size 0 or null have one row without container.
    Repeated keys are items of their own. Equal sizes and repeated runs give the same result. Other
    columns are ignored; an empty input gives no rows.
    """
    shards = max(1, -(-(items.count() if total is None else total) // shard_items))
    plain = items.select(F.col(key), F.coalesce(F.col(size), F.lit(0)).cast("long").alias("n"))
    sharded = plain.withColumn("shard", F.pmod(F.xxhash64(key), F.lit(shards)).cast("int"))
    ordered = sharded.repartition(min(shards, 100_000), "shard").sortWithinPartitions("shard", key, "n")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, current = SumOfSquares(capacity), None
        for batch in batches:
            at, piece, container, start, length = array("q"), array("q"), array("q"), array("q"), array("q")
            sizes, shard_of = batch.column(1).to_numpy(zero_copy_only=False), batch.column(2).to_numpy(zero_copy_only=False)

            def put(i: int, no: int, shard: int, units: int) -> None:
                where, level = packer.place(units) if units else (-1, -1)
                at.append(i)
                piece.append(no)
                container.append((shard << 32) + where if units else -1)
                start.append(level)
                length.append(units)

            for i in range(len(sizes)):
                shard, rest, no = int(shard_of[i]), int(sizes[i]), 1
                if shard != current:
                    packer, current = SumOfSquares(capacity), shard
                while rest > capacity:
                    put(i, no, shard, capacity)
                    rest, no = rest - capacity, no + 1
                put(i, no, shard, rest)
            column = lambda a: pa.array(np.frombuffer(a, np.int64) if len(a) else np.empty(0, np.int64))
            none_at = np.frombuffer(length, np.int64) == 0 if len(length) else np.empty(0, bool)
            ids = batch.column(0).take(column(at))
            masked = lambda a: pa.array(np.frombuffer(a, np.int64) if len(a) else np.empty(0, np.int64), mask=none_at)
            yield pa.RecordBatch.from_arrays([ids, column(piece), masked(container), masked(start), column(length)], names=[key, "piece_no", "container_id", "start_at", "n_tokens"])

    kind = items.schema[key].dataType.simpleString()
    return ordered.mapInArrow(run, f"`{key}` {kind}, piece_no long, container_id long, start_at long, n_tokens long")


def fill_report(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Containers by how full they are, in tenths of the capacity."""
    full = packed.where(F.col("container_id").isNotNull()).groupBy("container_id").agg(F.sum("n_tokens").alias("filled"), F.count(F.lit(1)).alias("n_pieces"))
    tenth = F.floor(F.col("filled") * 10 / F.lit(capacity)).cast("int")
    return full.groupBy(tenth.alias("tenths_full")).agg(F.count(F.lit(1)).alias("n_containers"), F.sum("n_pieces").alias("n_pieces"), F.sum("filled").alias("n_tokens"))


def placement_report(packed: DataFrame, key: str, capacity: int = CAPACITY) -> DataFrame:
    """``key, placed, whole, fits`` of every item: whether it is in a container, cut only if it is larger than one, and in containers that are not too full.

    A container is not too full if its pieces end where their sizes add up to, within the capacity. Items
    without a container fit. Keys are to be unique; repeated ones count as one item cut in pieces.
    """
    inside = F.col("container_id").isNotNull()
    filled = packed.where(inside).groupBy("container_id").agg(F.sum("n_tokens").alias("__sum"), F.max(F.col("start_at") + F.col("n_tokens")).alias("__end"))
    good = filled.select("container_id", ((F.col("__sum") == F.col("__end")) & (F.col("__sum") <= capacity)).alias("__good"))
    whole = (F.count(F.lit(1)) == F.max("piece_no")) & ((F.max("piece_no") == 1) | (F.sum("n_tokens") > capacity))
    return packed.join(good, "container_id", "left").groupBy(key).agg(F.bool_or(inside).alias("placed"), whole.alias("whole"), F.bool_and(F.coalesce("__good", ~inside)).alias("fits"))
