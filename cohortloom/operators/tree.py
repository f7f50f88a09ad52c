"""Per-key aggregation through a tree of merges, for inputs in which a few keys hold most rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of one input chunk, whose state is built inside one task.
CHUNK_ROWS = 65_536
FAN_IN = 8


def tree_aggregate(
    df: DataFrame,
    keys: list[str],
    leaf: dict[str, Column],
    merge: dict[str, Callable[[str], Column]],
    chunk_rows: int = CHUNK_ROWS,
    fan_in: int = FAN_IN,
    rounds: int | None = None,
    rows: int | None = None,
) -> DataFrame:
    """Aggregate ``df`` by ``keys`` in rounds, so that no reducer gets all partial states of a key.

    The rows of each input partition are cut into chunks of ``chunk_rows``; the first aggregation has
    (key, chunk's leaf) as its group, so each task combines its chunks before anything is sent, and a
    leaf node gets the states of about one chunk, as there are at least as many leaves as chunks. Each
    further round merges ``fan_in`` nodes into one, until one node per key is left: ``rounds`` =
    log(leaves) / log(fan_in), so no task gets more than about ``fan_in`` states of a key, however
    large the input is. ``rows`` is the number of input rows, counted if it is not given. ``leaf``
    names the states and how they are built from rows, ``merge`` how two or more of them become one.

    The result equals ``groupBy(keys).agg(...)`` for merges that are associative and commutative. A
    null key is a key of its own; an empty input gives no row. Chunk borders never change the result,
    so a task that is run again after a lost executor may cut its rows in another way.
    """
    if rounds is None:
        rounds = tree_rounds(df.count() if rows is None else rows, chunk_rows, fan_in)
    leaves = fan_in**rounds
    row = F.monotonically_increasing_id()
    chunk = F.struct(F.shiftright(row, 33), F.floor(F.pmod(row, F.lit(1 << 33)) / F.lit(chunk_rows)))
    states = df.withColumn("__node", F.pmod(F.xxhash64(chunk), F.lit(leaves)).cast("long"))
    states = states.groupBy(*keys, "__node").agg(*[c.alias(n) for n, c in leaf.items()])
    for _ in range(rounds):
        parent = F.floor(F.col("__node") / F.lit(fan_in)).cast("long")
        states = states.withColumn("__node", parent).groupBy(*keys, "__node").agg(*[merge[n](n).alias(n) for n in leaf])
    return states.drop("__node")


def tree_rounds(rows: int, chunk_rows: int = CHUNK_ROWS, fan_in: int = FAN_IN) -> int:
    """Fan-in rounds for a leaf per chunk; at least one."""
    chunks, rounds, leaves = -(-rows // chunk_rows), 1, fan_in
    while leaves < chunks:
        rounds, leaves = rounds + 1, leaves * fan_in
    return rounds


def dominant_keys(per_key: DataFrame, key: str, count: str, total: int, share: float) -> DataFrame:
    """Keys whose ``count`` is at least ``share`` of ``total``; the null key is none."""
    return per_key.where(F.col(key).isNotNull() & (F.col(count) >= F.lit(float(share) * total))).select(key)
