"""The most similar vectors of every vector, by several shifted Hilbert orderings."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.operators.skew import SHARD_ROWS, heavy_keys, replicate, spread
from cohortloom.session import cut_lineage

#: Orderings up to ``CURVES_FOR`` vectors, and two more for each doubling beyond, since neighbours lie closer then
#: and each ordering misses more; projected dimensions and bits of each; rows of a window, which is compared with
#: itself and the ones next to it.
CURVES, CURVES_FOR, DIMS, BITS, WINDOW = 12, 1 << 17, 15, 4, 256
#: Rows of a task's part of an ordering, parts of an ordering at most, and rows of the sample, for each part, by
#: which an ordering is cut into parts.
PART_ROWS, MOST_PARTS, SAMPLED = 1 << 16, 1 << 13, 64
#: Rows that are placed on the curves at a time.
PLACED_ROWS = 1 << 15
#: How far a similarity may be off by the four-byte floats in which the vectors travel (twice half a unit of
#: the last place), and how much more by a product in them. What a window passes on is reranked exactly.
ERROR, SLACK = 1.3e-7, 1e-5
#: Standard deviations of a projected coordinate that the grid covers on each side.
REACH = 3.0


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position on the Hilbert curve of each row of non-negative grid coordinates.

    Works from the highest bit down, undoing the curve's reflections and rotations in all dimensions,
    then takes the Gray code and interleaves the bits; at most 63 in all.
    """
    x = np.ascontiguousarray(cells.T, np.int8 if bits < 8 else np.int64)
    dims, one = len(x), x.dtype.type(1)
    for level in range(bits - 1, 0, -1):
        q = one << level
        low = q - 1
        for d in range(dims):
            set_ = (x[d] & q) != 0
            swap = np.where(set_, 0, (x[0] ^ x[d]) & low)
            x[0] ^= np.where(set_, low, swap)
            x[d] ^= swap
    for d in range(1, dims):
        x[d] ^= x[d - 1]
    flip = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        q = one << level
        flip ^= np.where((x[-1] & q) != 0, q - 1, 0)
    x ^= flip
    key = np.zeros(x.shape[1], np.int64)
    for level in range(bits - 1, -1, -1):
        for d in range(dims):
            key = key << 1 | ((x[d] >> level) & one)
    return key


def orderings(size: int, curves: int, dims: int, seed: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """A random orthonormal projection and a random shift of the grid for each curve, the same on every worker."""
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(curves):
        basis, _ = np.linalg.qr(rng.normal(size=(size, dims)))
        out.append((basis.astype(np.float32), rng.uniform(0.0, 1.0, dims).astype(np.float32)))
    return out


def _as_matrix(column: pa.Array, kind: type) -> np.ndarray:
    """The rows of a column of equally long binaries as a matrix."""
    data = b"".join(column.to_pylist())
    return np.frombuffer(data, kind).reshape(len(column), -1)


def _first(low: np.ndarray, high: np.ndarray, k: int) -> np.ndarray:
    """Which columns of each row, between ``low`` and ``high``, can be among its ``k`` best, by similarity, then by place: all that ``k`` others do not surely precede."""
    limit = np.partition(low, -k, axis=1)[:, -k, None]
    missing = k - (low > limit).sum(1, keepdims=True)
    last = np.argmax(np.cumsum(low == limit, axis=1) == missing, axis=1)[:, None]
    return (high > limit) | ((high == limit) & (np.arange(low.shape[1]) <= last))


def _window_pairs(keys: np.ndarray, z: np.ndarray, own: int, k: int, least: float | None) -> tuple[np.ndarray, np.ndarray]:
    """Positions of pairs of the first ``own`` rows with all that can be among the ``k`` best of all rows for each.

    Ranks are by similarity to six places, then by key. A row with more than ``k`` similar ones is
    compared again in doubles; then only the rounding of the vectors is left, and of those which it
    leaves undecided none is cut.
    """
    sims = z[:own] @ z.T
    sims[np.arange(own), np.arange(own)] = -2.0
    floor = -1.5 if least is None else least - SLACK
    keep = sims >= floor
    crowded = np.flatnonzero(np.count_nonzero(keep, axis=1) > k)
    if len(crowded):
        order = np.argsort(keys, kind="stable")
        exact = z[crowded].astype(np.float64) @ z[order].T.astype(np.float64)
        exact[keys[crowded][:, None] == keys[order]] = -2.0
        keep[crowded[:, None], order] &= _first(np.round(exact - ERROR, 6), np.round(exact + ERROR, 6), k)
    return np.nonzero(keep)


def curve_count(vectors: int) -> int:
    """Orderings for so many vectors."""
    return CURVES + max(0, math.ceil(2 * math.log2(max(1, vectors) / CURVES_FOR)))


_FIRST = np.iinfo(np.int64).min


def cut_points(spots: np.ndarray, keys: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Where parts of an ordering begin, by a sample of it: ``spot, key`` of the first row of all parts but the first.

    A part begins with a cell, so that the rows of a cell stay together; only a cell with more rows than
    a part is cut, by its keys.
    """
    order = np.lexsort((keys, spots))
    spots, keys = spots[order], keys[order]
    share = len(spots) / parts
    out = []
    for i in range(1, parts):
        at = min(len(spots) - 1, int(i * share))
        cell = spots[at]
        size = np.searchsorted(spots, cell, "right") - np.searchsorted(spots, cell, "left")
        out.append((cell, keys[at] if size > share else _FIRST))
    cuts = np.array(sorted(set(out)), np.int64).reshape(-1, 2)
    return cuts[:, 0].copy(), cuts[:, 1].copy()


def _part_of(spots: np.ndarray, keys: np.ndarray, cuts: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The part of each row."""
    at_spot, at_key = cuts
    part = np.searchsorted(at_spot, spots, "left")
    on = np.flatnonzero(at_spot[np.minimum(part, len(at_spot) - 1)] == spots) if len(at_spot) else np.empty(0, np.int64)
    base = part[on]
    for first in np.unique(base):
        last = np.searchsorted(at_spot, at_spot[first], "right")
        rows = on[base == first]
        part[rows] = first + np.searchsorted(at_key[first:last], keys[rows], "right")
    return part


def part_pairs(spots: np.ndarray, keys: np.ndarray, z: np.ndarray, head: tuple[int, np.ndarray, np.ndarray] | None, k: int, least: float | None, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of keys from the windows of one part of an ordering.

    The rows are ordered by cell and key. ``head`` has the first rows of a cell that began in an earlier
    part: its spot, keys and vectors.
    """
    order = np.lexsort((keys, spots))
    spots, keys, z = spots[order], keys[order], z[order]
    low, high = [], []
    for start in range(0, len(keys), window):
        end, before, after = min(start + window, len(keys)), max(0, start - window), min(start + 2 * window, len(keys))
        near = [(keys[start:end], z[start:end]), (keys[before:start], z[before:start]), (keys[end:after], z[end:after])]
        cell = spots[start]
        first = int(np.searchsorted(spots, cell, "left"))
        if first == 0 and head is not None and head[0] == cell:
            near.append(head[1:])
        elif first < before:
            near.append((keys[first : min(first + window, before)], z[first : min(first + window, before)]))
        names, rows = (np.concatenate(x) for x in zip(*near, strict=True))
        a, b = _window_pairs(names, rows, end - start, k, least)
        low.append(np.minimum(names[a], names[b]))
        high.append(np.maximum(names[a], names[b]))
    a, b = np.concatenate(low), np.concatenate(high)
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    once = np.ones(len(a), bool)
    once[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    once &= a != b
    return a[once], b[once]


def curve_candidates(
    reps: DataFrame, size: int, k: int, least: float | None, count: int, curves: int | None = None, dims: int = DIMS, bits: int = BITS, window: int = WINDOW, part_rows: int | None = None, seed: int = 11
) -> DataFrame:
    """Candidate pairs ``a < b`` of ``count`` rows ``key, z`` (``z``: unit vectors as binary doubles).

    For each curve the vectors are projected and ordered by their Hilbert key. The orderings are cut into
    ranges by a sample of ``SAMPLED`` rows a part; rows go to their parts in blocks, one shuffle for all
    curves, so that Spark moves few large rows, and each part is sorted and its windows compared with
    themselves and both neighbours as matrices. Rows of a cell are ordered by key on every curve, so a
    cell of more than a few windows, as many close copies make it, would always show a row the same
    others; its rows are compared with the cell's first window too, whose keys win all ties. A cell with
    more rows than a part is cut by its keys, and its first window goes to all of its parts.

    Windows do not reach over the border of two parts, where an ordering loses the links of at most
    ``window`` rows on either side, which the other orderings have with other borders.
    """
    part_rows = part_rows or max(PART_ROWS, -(-count // MOST_PARTS))
    parts = max(1, -(-count // part_rows))
    maps = orderings(size, curves or curve_count(count), min(dims, size), seed)
    cells_of = lambda z, c: np.clip(
        ((z @ maps[c][0]) * np.float32(np.sqrt(size)) / np.float32(2 * REACH) + np.float32(0.25) + maps[c][1] / 2) * (1 << bits), 0, (1 << bits) - 1
    ).astype(np.int64)

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        held, n = [], 0
        for batch in batches:
            for piece in pa.Table.from_batches([batch]).to_batches(max_chunksize=PLACED_ROWS):
                held.append(piece)
                n += piece.num_rows
                if n >= PLACED_ROWS:
                    yield _keyed(held)
                    held, n = [], 0
        if n:
            yield _keyed(held)

    def spots_of_sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, z in gathered(batches):
            for c in range(len(maps)):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), c, np.int32)), pa.array(hilbert_keys(cells_of(z, c), bits)), pa.array(keys)], names=["curve", "spot", "key"])

    def cut(key: tuple, table: pa.Table) -> pa.Table:
        spots, keys = cut_points(table["spot"].to_numpy(), table["key"].to_numpy(), parts)
        return pa.table({"curve": pa.array([key[0].as_py()], pa.int32()), "spots": [spots.tolist()], "keys": [keys.tolist()]})

    none = np.empty(0, np.int64)
    cuts = {c: (none, none) for c in range(len(maps))}
    if parts > 1:
        share = min(1.0, SAMPLED * parts / max(1, count))  # by the keys' hash, so that the cuts are the same in each run
        some = reps.select("key", "z").where(F.pmod(F.xxhash64("key", F.lit(seed)), F.lit(1 << 30)) < int(share * (1 << 30)))
        rows = some.mapInArrow(spots_of_sample, "curve int, spot long, key long").groupBy("curve").applyInArrow(cut, "curve int, spots array<long>, keys array<long>")
        cuts |= {r["curve"]: (np.array(r["spots"], np.int64), np.array(r["keys"], np.int64)) for r in rows.collect()}
    first_part = np.cumsum([0, *(len(cuts[c][0]) + 1 for c in range(len(maps)))])
    # Parts that begin inside a cell, with its curve and spot.
    inside = [(c, int(s), int(first_part[c]) + i + 1) for c in range(len(maps)) for i, (s, key) in enumerate(zip(*cuts[c], strict=True)) if key != _FIRST]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, z in gathered(batches):
            for c in range(len(maps)):
                spots = hilbert_keys(cells_of(z, c), bits)
                part = _part_of(spots, keys, cuts[c])
                order = np.argsort(part, kind="stable")
                names, starts = np.unique(part[order], return_index=True)
                blocks = np.split(order, starts[1:])
                yield _blocks_of(first_part[c] + names, [spots[b] for b in blocks], [keys[b] for b in blocks], [z[b] for b in blocks], False)

    def first_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The rows with the smallest keys of each cell that is cut, of one task."""
        wanted: dict[int, list[int]] = {}
        for c, s, _ in inside:
            wanted.setdefault(c, []).append(s)
        kept: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        for keys, z in gathered(batches):
            for c, cells in wanted.items():
                spots = hilbert_keys(cells_of(z, c), bits)
                for s in set(cells):
                    at = spots == s
                    old = kept.get((c, s), (none, np.empty((0, size), np.float32)))
                    k_, z_ = np.concatenate([old[0], keys[at]]), np.concatenate([old[1], z[at]])
                    best = np.argsort(k_)[:window]
                    kept[c, s] = k_[best], z_[best]
        for (c, s), (k_, z_) in kept.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k_), c, np.int32)), pa.array(np.full(len(k_), s)), pa.array(k_), pa.array([r.tobytes() for r in z_], pa.binary())], names=["curve", "spot", "key", "z"])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                spots, keys, z = batch.column("spot").to_numpy(), batch.column("key").to_numpy(), _as_matrix(batch.column("z"), np.float32)
                one = range(len(keys))
                yield _blocks_of(batch.column("part").to_numpy(), [spots[i : i + 1] for i in one], [keys[i : i + 1] for i in one], [z[i : i + 1] for i in one], True)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = None, []

        def finish() -> Iterator[pa.RecordBatch]:
            join = lambda own, i: np.concatenate([b[i] for b in own])
            own, firsts = [b for b in held if not b[3]], [b for b in held if b[3]]
            if not own:
                return
            head = None
            if firsts:
                order = np.argsort(join(firsts, 1))
                head = int(firsts[0][0][0]), join(firsts, 1)[order], join(firsts, 2)[order]
            a, b = part_pairs(join(own, 0), join(own, 1), join(own, 2), head, k, least, window)
            for at in range(0, len(a), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(a[at : at + (1 << 16)]), pa.array(b[at : at + (1 << 16)])], names=["a", "b"])

        for batch in batches:
            for i in range(batch.num_rows):
                if batch.column("part")[i].as_py() != part:
                    yield from finish()
                    part, held = batch.column("part")[i].as_py(), []
                ints = [np.frombuffer(batch.column(c)[i].as_buffer(), np.int64) for c in ("spots", "keys")]
                held.append((*ints, np.frombuffer(batch.column("z")[i].as_buffer(), np.float32).reshape(len(ints[0]), -1), batch.column("head")[i].as_py()))
        yield from finish()

    schema = "part long, spots binary, keys binary, z binary, head boolean"
    moved = reps.select("key", "z").mapInArrow(place, schema)
    if inside:
        smallest = Window.partitionBy("curve", "spot").orderBy("key")
        heads = reps.select("key", "z").mapInArrow(first_rows, "curve int, spot long, key long, z binary").withColumn("n", F.row_number().over(smallest)).where(F.col("n") <= window)
        targets = reps.sparkSession.createDataFrame(inside, "curve int, spot long, part long")  # no more than there are parts
        moved = moved.unionByName(heads.join(F.broadcast(targets), ["curve", "spot"]).select("part", "spot", "key", "z").mapInArrow(packed, schema))
    together = moved.repartitionById(int(first_part[-1]), F.col("part").cast("int")).sortWithinPartitions("part")
    return together.mapInArrow(compare, "a long, b long").distinct()


def _keyed(batches: list[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray]:
    """Keys and vectors of ``key, z`` rows, in four-byte floats."""
    table = pa.Table.from_batches(batches).combine_chunks()
    return table["key"].to_numpy(), _as_matrix(table["z"].combine_chunks(), np.float64).astype(np.float32)


def _blocks_of(parts: np.ndarray, spots: list[np.ndarray], keys: list[np.ndarray], z: list[np.ndarray], head: bool) -> pa.RecordBatch:
    pack = lambda values: pa.array([np.ascontiguousarray(v).tobytes() for v in values], pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(parts, pa.int64()), pack(spots), pack(keys), pack(z), pa.array([head] * len(spots))], names=["part", "spots", "keys", "z", "head"])


def _unit(df: DataFrame, key: str, vector: str, size: int) -> DataFrame:
    """``key, print, z`` of the rows with exactly ``size`` finite values that are not all equal.

    ``z`` is the centred vector of length one as binary doubles, ``print`` its digest to twelve places.
    Rows that differ in scale and level alone have one print, but where rounding parts them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            long_enough = pc.fill_null(pc.equal(pc.list_value_length(batch.column("vec")), size), False)
            rows = batch.filter(long_enough)
            x = rows.column("vec").flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, size)  # a null value is NaN
            good = np.isfinite(x).all(1) & (x.max(1, initial=-np.inf) > x.min(1, initial=np.inf))
            x = x[good]
            x = x / np.abs(x).max(1, keepdims=True, initial=0.0)  # so that very large values do not overflow
            z = x - x.mean(1, keepdims=True)
            norm = np.sqrt((z * z).sum(1, keepdims=True))
            z /= np.where(norm > 0, norm, 1.0)
            prints = [hashlib.blake2b(r.tobytes(), digest_size=16).digest() for r in np.round(z, 12) + 0.0]
            yield pa.RecordBatch.from_arrays([rows.column("key").filter(pa.array(good)), pa.array(prints, pa.binary()), pa.array([r.tobytes() for r in z], pa.binary())], names=["key", "print", "z"])

    return df.select(F.col(key).cast("long").alias("key"), F.col(vector).cast("array<double>").alias("vec")).mapInArrow(run, "key long, print binary, z binary")


def _similarity(pairs: DataFrame) -> DataFrame:
    """``a, b, sim`` of rows with the unit vectors ``za, zb``: the exact correlation, to six places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                sim = np.round((_as_matrix(batch.column("za"), np.float64) * _as_matrix(batch.column("zb"), np.float64)).sum(1), 6)
                yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(sim)], names=["a", "b", "sim"])

    return pairs.select("a", "b", "za", "zb").mapInArrow(run, "a long, b long, sim double")


def nearest(df: DataFrame, key: str, vector: str, size: int, k: int = 5, least: float | None = None, curves: int | None = None, shard_rows: int = SHARD_ROWS, part_rows: int | None = None) -> DataFrame:
    """``key, other, sim, rank_no``: for every row the ``k`` rows that correlate best with it.

    ``sim`` is the Pearson correlation to six places; equal ones are ranked by the smaller key. With
    ``least``, pairs below it are left out. Rows without key, or whose vector is null, has another length, a value that
    is null, NaN or infinite, or only equal values, take no part.

    Rows with the same profile, whatever its scale and level, are one vector, with their ``k + 1`` smallest
    keys, which are all that can be among anybody's nearest; so copies never fill the windows, and a
    vector that a third of the rows share costs no more than another. ``curve_candidates`` finds pairs of
    vectors, these are reranked with the exact correlation and then expanded to rows, the copies' rows
    over shards.

    Each curve may miss a near vector; all miss it rarely, and more curves miss less (see README).
    """
    valid = cut_lineage(_unit(df.where(F.col(key).isNotNull()), key, vector, size))
    by_print = Window.partitionBy("print").orderBy("key")
    smallest = valid.withColumn("n", F.row_number().over(by_print)).where(F.col("n") <= k + 1)
    groups = cut_lineage(smallest.groupBy("print").agg(F.min("key").alias("rep"), F.array_sort(F.collect_list("key")).alias("copies"), F.min_by("z", "key").alias("z")))
    reps = groups.select(F.col("rep").alias("key"), "z")
    groups = groups.drop("z")
    pairs = curve_candidates(reps, size, k, least, reps.count(), curves, part_rows=part_rows)
    left = reps.select(F.col("key").alias("a"), F.col("z").alias("za"))
    right = reps.select(F.col("key").alias("b"), F.col("z").alias("zb"))
    sims = _similarity(pairs.join(left, "a").join(right, "b"))
    if least is not None:
        sims = sims.where(F.col("sim") >= F.lit(least))
    ways = F.explode(F.array(F.struct(F.col("a").alias("rep"), F.col("b").alias("other")), F.struct(F.col("b").alias("rep"), F.col("a").alias("other"))))
    near = sims.select(ways.alias("w"), "sim").select("w.*", "sim")
    best = Window.partitionBy("rep").orderBy(F.col("sim").desc(), "other")
    near = near.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k).drop("n")
    shared = groups.where(F.size("copies") > 1)
    found = near.join(groups.select(F.col("rep").alias("other"), "copies"), "other").select("rep", "sim", F.explode("copies").alias("other"))
    found = found.unionByName(shared.select("rep", F.lit(1.0).alias("sim"), F.explode("copies").alias("other")))
    lists = (
        found.withColumn("n", F.row_number().over(best))
        .where(F.col("n") <= k + 1)
        .groupBy("rep")
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("n", "other", "sim"))), lambda e: F.struct(e["other"].alias("other"), e["sim"].alias("sim"))).alias("list"))
    )
    alone = lists.join(shared.select("rep"), "rep", "left_anti").select(F.col("rep").alias("key"), "list")
    copied = lists.join(shared.select("rep", "print"), "rep").select("print", "list")
    members = valid.select("key", "print")
    heavy = heavy_keys(members, ["print"], shard_rows)
    many = spread(members, heavy, ["print"], F.col("key")).join(replicate(copied, heavy, ["print"]), ["print", "__shard"]).select("key", "list")
    others = F.slice(F.filter("list", lambda e: e["other"] != F.col("key")), 1, k)
    return alone.unionByName(many).select("key", F.posexplode(others).alias("at", "e")).select("key", "e.other", "e.sim", (F.col("at") + 1).cast("long").alias("rank_no"))


def neighbour_pairs(near: DataFrame) -> DataFrame:
    """Each pair of ``nearest`` once, as ``key_a < key_b``."""
    return near.select(F.least("key", "other").alias("key_a"), F.greatest("key", "other").alias("key_b")).distinct()
