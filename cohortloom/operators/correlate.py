"""Correlation of all pairs of rows of a matrix, in blocks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.session import cut_lineage

METHODS = ("pearson", "spearman", "kendall", "bicor", "hellcor")
#: Bytes of one block's vectors, the most rows it has, and the rows whose products a task holds at a time. Each
#: block travels once for each other one, so they are large, and are cut into tiles only where they have met.
BLOCK_BYTES, BLOCK_ROWS, TILE_ROWS = 16 << 20, 4096, 512
#: Values of a row up to which Kendall's tau is a matrix product of the signs of all differences; wider rows are sorted.
SIGN_WIDTH = 1024
#: Values of a row up to which the Hellinger correlation takes the distances of all points.
ALL_DISTANCES = 400
#: Decimals to which correlations are rounded before they are ranked, so that ties stay ties.
DECIMALS = 9


def ranks(x: np.ndarray) -> np.ndarray:
    """Ranks along the rows, equal values sharing the mean of their places."""
    order = np.argsort(x, axis=1, kind="stable")
    ordered = np.take_along_axis(x, order, 1)
    n = x.shape[1]
    start = np.ones(x.shape, bool)
    start[:, 1:] = ordered[:, 1:] != ordered[:, :-1]
    at = np.arange(n)
    first = np.maximum.accumulate(np.where(start, at, 0), axis=1)
    end = np.ones(x.shape, bool)
    end[:, :-1] = start[:, 1:]
    last = np.minimum.accumulate(np.where(end, at, n)[:, ::-1], axis=1)[:, ::-1]
    out = np.empty(x.shape)
    np.put_along_axis(out, order, (first + last) / 2.0 + 1.0, 1)
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    norm = np.sqrt((x * x).sum(1, keepdims=True))
    with np.errstate(invalid="ignore", divide="ignore"):
        return np.where(norm > 1e-12 * np.maximum(1.0, np.abs(x).max(1, keepdims=True, initial=0.0)), x / norm, np.nan)


def pearson_vectors(x: np.ndarray) -> np.ndarray:
    """Unit vectors whose products are Pearson's r; NaN for rows without variance."""
    return _unit(x - x.mean(1, keepdims=True))


def spearman_vectors(x: np.ndarray) -> np.ndarray:
    return pearson_vectors(ranks(x))


def dense_ranks(x: np.ndarray) -> np.ndarray:
    """Ranks from 0 along the rows without gaps, equal values sharing one; NaN has -1."""
    order = np.argsort(x, axis=1, kind="stable")
    ordered = np.take_along_axis(x, order, 1)
    place = np.zeros(x.shape, np.int32)
    np.cumsum(ordered[:, 1:] != ordered[:, :-1], axis=1, out=place[:, 1:])
    out = np.empty(x.shape, np.int32)
    np.put_along_axis(out, order, place, 1)
    out[np.isnan(x)] = -1
    return out


def _signs(x: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Signs of the differences of the ranks at ``i`` and ``j``; 0 where either is -1."""
    left, right = x[:, i], x[:, j]
    return np.sign(left - right).astype(np.float32) * ((left >= 0) & (right >= 0))


def sign_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sums of the products of all signs of differences in two rows of ranks, by matrix products; the sums are whole
    numbers, so they are exact. What is held at a time is bounded whatever the width."""
    total = np.zeros((len(a), len(b)))
    n, step = a.shape[1], max(1, min(1 << 16, (1 << 22) // max(1, len(a) + len(b))))
    i, j = np.triu_indices(n, 1)
    for k in range(0, len(i), step):
        at = i[k : k + step], j[k : k + step]
        total += _signs(a, *at) @ _signs(b, *at).T
    return total


def _inversions(order: np.ndarray, bits: int) -> np.ndarray:
    """For each row, a permutation of 2**bits numbers, how many pairs of them stand in the wrong order.

    Numbers that differ first at a bit lie in one group of the numbers with equal higher bits, of which half
    have the bit. How often one with it stands before one without is the sum of the latter's places, less
    what it were if they all came first.
    """
    rows, flat, total = len(order), order.ravel(), np.zeros(len(order), np.int64)
    for bit in range(bits - 1, -1, -1):
        half = 1 << bit
        without = (flat & half) == 0
        total += (np.flatnonzero(without) & (2 * half - 1)).reshape(rows, -1).sum(1) - (order.shape[1] // (2 * half)) * (half * (half - 1) // 2)
        flat = np.stack([flat[without].reshape(-1, half), flat[~without].reshape(-1, half)], axis=1).ravel()
    return total


def _equal_pairs(ordered: np.ndarray) -> np.ndarray:
    """Pairs of equal values in each row of sorted ones."""
    at = np.arange(1, ordered.shape[1] + 1)
    start = np.ones(ordered.shape, bool)
    start[:, 1:] = ordered[:, 1:] != ordered[:, :-1]
    return (at - np.maximum.accumulate(np.where(start, at, 0), axis=1)).sum(1)


def ordered_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sums of ``sign_products`` in n log n for each two rows: all pairs less the tied ones, less twice those
    in opposite order, which are the inversions of one row sorted by the other."""
    total = np.zeros((len(a), len(b)))
    gaps_a, gaps_b = (a < 0).any(1), (b < 0).any(1)
    whole = np.flatnonzero(~gaps_b)
    n = a.shape[1]
    bits = max(1, max(n - 1, int(b.max(initial=0))).bit_length())
    tied_b, step = _equal_pairs(np.sort(b, axis=1)), max(1, (1 << 20) >> bits)
    for i in range(len(a)):
        if gaps_a[i]:
            continue
        tied = _equal_pairs(np.sort(a[i : i + 1], axis=1))[0]
        for k in range(0, len(whole), step):
            rows = whole[k : k + step]
            both = np.sort((a[i].astype(np.int64) << bits) + b[rows], axis=1)
            key = np.full((len(rows), 1 << bits), np.iinfo(np.int64).max)
            key[:, :n] = (both & ((1 << bits) - 1)) << bits
            key[:, n:] -= (1 << bits) - 1  # those beyond the row come last
            opposite = _inversions(np.sort(key + np.arange(1 << bits), axis=1) & ((1 << bits) - 1), bits)
            total[i, rows] = n * (n - 1) // 2 - tied - tied_b[rows] + _equal_pairs(both) - 2 * opposite
    for i, j in zip(*np.nonzero(gaps_a[:, None] | gaps_b[None, :]), strict=True):
        both = (a[i] >= 0) & (b[j] >= 0)
        if both.sum() > 1:
            total[i, j] = ordered_products(a[i : i + 1, both], b[j : j + 1, both])[0, 0]
    return total


def _untied(x: np.ndarray) -> np.ndarray:
    """Pairs of different values in each row of ranks."""
    n = (x >= 0).sum(1)
    tied = _equal_pairs(np.sort(x, axis=1))
    gaps = x.shape[1] - n
    return n * (n - 1) // 2 - (tied - gaps * (gaps - 1) // 2)


def kendall_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Kendall's tau-b of each row of ``a`` with each of ``b``, from their dense ranks: the cosine of the signs of all differences."""
    total = sign_products(a, b) if a.shape[1] <= SIGN_WIDTH else ordered_products(a, b)
    scale = np.outer(_untied(a).astype(float), _untied(b).astype(float))
    with np.errstate(invalid="ignore", divide="ignore"):
        return np.where(scale > 0, total / np.sqrt(scale), np.nan)


def bicor_vectors(x: np.ndarray) -> np.ndarray:
    """Unit vectors of the biweight midcorrelation; Pearson's where the median deviation is 0."""
    median = np.median(x, axis=1, keepdims=True)
    mad = np.median(np.abs(x - median), axis=1, keepdims=True)
    with np.errstate(invalid="ignore", divide="ignore"):
        u = (x - median) / (9.0 * mad)
        w = np.where(np.abs(u) < 1.0, (1.0 - u * u) ** 2, 0.0)
    return np.where(mad > 0, _unit((x - median) * np.where(mad > 0, w, 0.0)), pearson_vectors(x))


_VECTORS: dict[str, Callable[[np.ndarray], np.ndarray]] = {"pearson": pearson_vectors, "spearman": spearman_vectors, "kendall": dense_ranks, "bicor": bicor_vectors}


def _all_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sums of the distances to the nearest other point, from the distances of all points; a bounded number of them is held."""
    n = a.shape[1]
    square = lambda x: (x[..., :, None] - x[..., None, :]) ** 2
    diagonal, step = np.arange(n), max(1, (1 << 22) // (n * n))
    out = np.empty((len(a), len(b)))
    for k in range(0, len(b), step):
        sb = square(b[k : k + step])
        sb[:, diagonal, diagonal] = np.inf
        for i in range(len(a)):
            out[i, k : k + step] = np.sqrt((square(a[i]) + sb).min(2)).sum(1)
    return out


def _nearest_distances(x: np.ndarray, y: np.ndarray) -> float:
    """Sum of the distances to the nearest other point, of at least two points at whole coordinates from 0 on.

    Points that coincide have the distance 0 and are one. The others look for their nearest one in their
    cell and the 8 around it: first in cells that hold few points, then, those that found none within a
    cell's width, in cells twice as wide. Ranks leave about sqrt(n) points to a cell's row or column.
    """
    bits = max(1, int(max(x.max(), y.max())).bit_length())
    keys, counts = np.unique((x << bits) + y, return_counts=True)
    x, y = keys >> bits, keys & ((1 << bits) - 1)
    open_ = np.flatnonzero(counts == 1)
    if len(keys) < 2:
        return 0.0
    level = bits
    while level and len(np.unique(((x >> level) << bits) + (y >> level))) * 4 < len(keys):
        level -= 1
    best = np.full(len(keys), np.iinfo(np.int64).max)
    while len(open_):
        cx, cy = x >> level, y >> level
        cells = (cx << bits) + cy
        order = np.argsort(cells, kind="stable")
        cells, px, py = cells[order], x[order], y[order]
        for by in (-1, 0, 1):
            column = ((cx[open_] + by) << bits) + cy[open_]
            low = np.searchsorted(cells, column - (cy[open_] > 0), "left")
            high = np.searchsorted(cells, column + (cy[open_] < (1 << bits) - 1), "right")
            ends = np.cumsum(high - low)
            done = 0
            while done < len(open_):  # about so many points at a time
                base = ends[done - 1] if done else 0
                until = max(done + 1, int(np.searchsorted(ends, base + (1 << 20), "right")))
                sizes = (high - low)[done:until]
                mine, starts = np.repeat(open_[done:until], sizes), np.cumsum(sizes) - sizes
                other = np.arange(len(mine)) + np.repeat(low[done:until] - starts, sizes)
                distance = (px[other] - x[mine]) ** 2 + (py[other] - y[mine]) ** 2
                distance[order[other] == mine] = np.iinfo(np.int64).max
                some = np.flatnonzero(sizes)
                if len(some):
                    at = open_[done:until][some]
                    best[at] = np.minimum(best[at], np.minimum.reduceat(distance, starts[some]))
                done = until
        open_ = open_[best[open_] > (1 << (2 * level))]
        level += 1
    return float(np.sqrt(best[counts == 1].astype(float)).sum())


def hellinger_pairs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hellinger correlation of each row of ``a`` with each of ``b``, from ranks scaled into (0, 1).

    The affinity between the joint density of the ranks and independence is estimated by the
    distances to the nearest neighbour, 2 sqrt(n - 1) / n times their sum, and cut off at 1.
    """
    n = a.shape[1]
    if n <= ALL_DISTANCES or not (np.isfinite(a).all() and np.isfinite(b).all()):
        sums = _all_distances(a, b)
    else:
        wa, wb = (np.rint(2.0 * (n + 1.0) * v).astype(np.int64) for v in (a, b))  # ranks are whole or half numbers
        sums = np.array([[_nearest_distances(x, y) for y in wb] for x in wa]) / (2.0 * (n + 1.0))
    affinity = np.minimum(1.0, 2.0 * np.sqrt(n - 1.0) / n * sums)
    quartic = affinity**4
    inner = np.maximum(0.0, quartic + np.sqrt(np.maximum(0.0, 4.0 - 3.0 * quartic)) - 2.0)
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(affinity > 0, np.minimum(1.0, 2.0 / affinity**2 * np.sqrt(inner)), 1.0)


def _rows_of(block: bytes, rows: int, method: str) -> np.ndarray:
    return np.frombuffer(block, np.int32 if method == "kendall" else np.float64).reshape(rows, -1)


def _products(a: np.ndarray, b: np.ndarray, method: str) -> np.ndarray:
    if method == "hellcor":
        return hellinger_pairs(a, b)
    return kendall_products(a, b) if method == "kendall" else a @ b.T


def _stack(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """The rows of a column of equally long arrays; nulls are NaN."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    return flat.reshape(len(column), -1)


def prepared(x: np.ndarray, method: str) -> np.ndarray:
    """What of the rows enters the products of a method."""
    make = _VECTORS.get(method)
    return make(x) if make else ranks(x) / (x.shape[1] + 1.0)


def blocks(vectors: DataFrame, method: str, width: int, gene: str = "gene_id", total: int | None = None) -> tuple[DataFrame, int]:
    """The rows ``gene_id, ord, values`` as blocks ``block, genes, ords, z`` and the number of blocks.

    A block holds a bounded number of rows; ``ord`` runs from 1 without gaps.
    """
    length = (4 if method == "kendall" else 8) * width
    total = vectors.count() if total is None else total
    slots = max(2, vectors.sparkSession.sparkContext.defaultParallelism)
    few = max(1, min(16, (1 << 14) // max(1, width)))  # wide rows are work enough in smaller blocks
    even = max(few, -(-total // slots))  # at least as many blocks as slots, if there are rows for it
    size = int(max(1, min(BLOCK_ROWS, BLOCK_BYTES // max(1, length), even)))
    placed = vectors.select(F.floor((F.col("ord") - 1) / size).cast("int").alias("block"), "ord", gene, "values")

    def build(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("ord")
        z = prepared(_stack(table["values"]), method)
        return pa.table({"block": pa.array([key[0].as_py()], pa.int32()), "genes": [table[gene].to_pylist()], "ords": [table["ord"].to_pylist()], "z": pa.array([np.ascontiguousarray(z).tobytes()], pa.binary())})

    kind = vectors.schema[gene].dataType.simpleString()
    built = placed.groupBy("block").applyInArrow(build, f"block int, genes array<{kind}>, ords array<long>, z binary")
    return built, -(-total // size)


def pairwise(
    vectors: DataFrame, method: str, width: int, *, top: int | None = None, least: float | None = None, positive: bool = False, diagonal: bool = False, gene: str = "gene_id"
) -> DataFrame:
    """Correlated pairs ``gene_a, gene_b, ord_a, ord_b, r`` of the rows ``gene_id, ord, values``.

    Each pair of blocks meets once, by an equi-join on the pair's number, and is one matrix product in
    one task, so neither the driver nor any task holds the whole matrix. Values that are not finite are
    left out unless ``diagonal`` asks for the dense form.

    ``top``: directed, the ``top`` neighbours of each row by \\|r\\| (by r with ``positive``), ties by
    place; each task keeps its own best before the final ranking. ``least``: undirected, ord_a < ord_b
    and \\|r\\| >= ``least``. ``diagonal``: all ordered pairs with the rows themselves. Neither: all
    unordered pairs.
    """
    if method not in METHODS:
        raise ValueError(f"unknown method: {method!r}")
    kept = cut_lineage(vectors.select(gene, "ord", "values"))  # read three times: to count, and for either side
    return _pairs(kept, method, width, top, least, positive, diagonal, gene)


def _pairs(vectors: DataFrame, method: str, width: int, top: int | None = None, least: float | None = None, positive: bool = False, diagonal: bool = False, gene: str = "gene_id", total: int | None = None) -> DataFrame:
    built, count = blocks(vectors, method, width, gene, total)
    last = max(0, count - 1)
    left = built.select(F.col("block").alias("bi"), F.explode(F.sequence(F.col("block"), F.lit(last))).alias("bj"), F.col("genes").alias("ga"), F.col("ords").alias("oa"), F.col("z").alias("za"))
    right = built.select(F.explode(F.sequence(F.lit(0), F.col("block"))).alias("bi"), F.col("block").alias("bj"), F.col("genes").alias("gb"), F.col("ords").alias("ob"), F.col("z").alias("zb"))
    met = left.join(right, ["bi", "bj"]).select("bi", "bj", "ga", "oa", "za", "gb", "ob", "zb")
    kind = vectors.schema[gene].dataType.simpleString()

    def half(r: np.ndarray, side: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the ``top`` best of each row of ``r``; ``other`` is ascending, so ties go by position."""
        score = r if positive else np.abs(r)
        score = np.where(np.isfinite(r) & (side[:, None] != other[None, :]) & ((r > 0) if positive else True), score, -1.0)
        fine = score >= 0
        if score.shape[1] > top:
            limit = np.partition(score, -top, axis=1)[:, -top, None]
            above, even = score > limit, score == limit
            fine &= above | (even & (np.cumsum(even, axis=1) <= top - above.sum(1, keepdims=True)))
        return np.nonzero(fine)

    def wanted(r: np.ndarray, oa: np.ndarray, ob: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
        mask = np.ones(r.shape, bool) if diagonal else np.isfinite(r)
        if least is not None:
            mask &= np.abs(r) >= least
        if positive:
            mask &= r > 0
        if same and not diagonal:
            mask &= oa[:, None] < ob[None, :]
        return np.nonzero(mask)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["gene_a", "gene_b", "ord_a", "ord_b", "r"]
        for batch in batches:
            for k in range(batch.num_rows):
                ga, gb = batch.column("ga")[k].values, batch.column("gb")[k].values
                oa, ob = batch.column("oa")[k].values.to_numpy(), batch.column("ob")[k].values.to_numpy()
                za, zb = _rows_of(batch.column("za")[k].as_py(), len(oa), method), _rows_of(batch.column("zb")[k].as_py(), len(ob), method)
                same = batch.column("bi")[k].as_py() == batch.column("bj")[k].as_py()
                for at in range(0, len(oa), TILE_ROWS):
                    o = oa[at : at + TILE_ROWS]
                    r = np.round(np.clip(_products(za[at : at + TILE_ROWS], zb, method), -1.0, 1.0), DECIMALS) + 0.0
                    i, j = half(r, o, ob) if top is not None else wanted(r, o, ob, same)
                    yield pa.RecordBatch.from_arrays([ga.take(pa.array(i + at)), gb.take(pa.array(j)), pa.array(o[i]), pa.array(ob[j]), pa.array(r[i, j])], names=names)
                    if not same and (top is not None or diagonal):
                        if top is not None:
                            j, i = half(r.T, ob, o)
                        yield pa.RecordBatch.from_arrays([gb.take(pa.array(j)), ga.take(pa.array(i + at)), pa.array(ob[j]), pa.array(o[i]), pa.array(r[i, j])], names=names)

    pairs = met.mapInArrow(run, f"gene_a {kind}, gene_b {kind}, ord_a long, ord_b long, r double")
    if top is None:
        return pairs
    score = F.col("r") if positive else F.abs("r")
    best = Window.partitionBy("ord_a").orderBy(score.desc(), "ord_b")
    return pairs.withColumn("rank", F.row_number().over(best).cast("long")).where(F.col("rank") <= top)


def parse_output(spec: str) -> dict:
    """``dense``, ``edges:topk=N`` (at least 1) or ``edges:threshold=R`` as arguments of ``pairwise``."""
    text = spec.strip().lower()
    if text == "dense":
        return {"diagonal": True}
    name, _, value = text.removeprefix("edges:").partition("=")
    if text.startswith("edges:") and name == "topk":
        return {"top": max(1, int(value))}
    if text.startswith("edges:") and name == "threshold":
        return {"least": float(value)}
    raise ValueError(f"unknown output: {spec!r}")


def parse_method(text: str) -> str:
    method = text.strip().lower()
    if method not in METHODS:
        raise ValueError(f"unknown method: {text!r}")
    return method


def correlate(vectors: DataFrame, method: str, output: str, width: int, gene: str = "gene_id") -> DataFrame:
    """Edges or the dense form by the texts of a configuration; at least two genes are needed."""
    arguments = parse_output(output)
    vectors = cut_lineage(vectors.select(gene, "ord", "values"))
    total = vectors.count()
    if total < 2:
        raise ValueError("correlation needs at least two genes")
    return _pairs(vectors, parse_method(method), width, gene=gene, total=total, **arguments)


def group_sums(vectors: DataFrame, members: DataFrame, method: str = "spearman") -> DataFrame:
    """``node, total``: for each row the sum of its positive correlations with the other rows of its group.

    ``vectors`` has ``ord, values``, ``members`` ``node, component``: the group of row ``node``. Only pairs
    of one group are made, as products of blocks that leave nothing but a sum for each row. A group larger
    than a block is spread by hash over several, which meet pairwise by an equi-join; smaller ones share
    blocks, and a mask keeps them apart.
    """
    sizes = members.groupBy("component").agg(F.count(F.lit(1)).alias("n"))
    small = sizes.agg(F.coalesce(F.sum(F.when(F.col("n") <= GROUP_ROWS, F.col("n"))), F.lit(0))).first()[0]
    shared = max(1, -(-small // GROUP_ROWS))
    large = F.col("n") > GROUP_ROWS
    placed = members.join(sizes, "component").select(
        F.col("node").alias("ord"), "component",
        F.when(large, F.col("component")).otherwise(-1 - F.pmod(F.xxhash64("component"), F.lit(shared))).alias("bundle"),
        F.when(large, F.ceil(F.col("n") / GROUP_ROWS)).otherwise(1).cast("int").alias("parts"),
    )
    rows = placed.withColumn("part", F.pmod(F.xxhash64("ord", F.lit(1)), F.col("parts")).cast("int")).join(vectors.select("ord", "values"), "ord")

    def build(key: tuple, table: pa.Table) -> pa.Table:
        z = prepared(_stack(table["values"]), method)
        one = {"ords": table["ord"], "groups": table["component"]}
        return pa.table(
            {"bundle": pa.array([key[0].as_py()], pa.int64()), "part": pa.array([key[1].as_py()], pa.int32()), "parts": pa.array([table["parts"][0].as_py()], pa.int32()),
             **{k: [v.to_pylist()] for k, v in one.items()}, "z": pa.array([np.ascontiguousarray(z).tobytes()], pa.binary())}
        )

    built = rows.groupBy("bundle", "part").applyInArrow(build, "bundle long, part int, parts int, ords array<long>, groups array<long>, z binary")
    side = lambda partners, mine, theirs, name: built.select("bundle", F.col("part").alias(mine), F.explode(partners).alias(theirs), *[F.col(c).alias(f"{c}_{name}") for c in ("ords", "groups", "z")])
    left = side(F.sequence(F.col("part"), F.col("parts") - 1), "bi", "bj", "a")
    right = side(F.sequence(F.lit(0), F.col("part")), "bj", "bi", "b")
    met = left.join(right, ["bundle", "bi", "bj"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                value = lambda c: batch.column(c)[k].values.to_numpy()  # noqa: E731, B023
                oa, ob, ca, cb = value("ords_a"), value("ords_b"), value("groups_a"), value("groups_b")
                za, zb = _rows_of(batch.column("z_a")[k].as_py(), len(oa), method), _rows_of(batch.column("z_b")[k].as_py(), len(ob), method)
                same = batch.column("bi")[k].as_py() == batch.column("bj")[k].as_py()
                back = np.zeros(len(ob))
                for at in range(0, len(oa), TILE_ROWS):
                    o, c = oa[at : at + TILE_ROWS], ca[at : at + TILE_ROWS]
                    r = np.round(np.clip(_products(za[at : at + TILE_ROWS], zb, method), -1.0, 1.0), DECIMALS)
                    r = np.where(np.isfinite(r) & (c[:, None] == cb[None, :]) & (o[:, None] != ob[None, :]), np.maximum(r, 0.0), 0.0)
                    yield pa.RecordBatch.from_arrays([pa.array(o), pa.array(r.sum(1))], names=["node", "part"])
                    back += r.sum(0)
                if not same:
                    yield pa.RecordBatch.from_arrays([pa.array(ob), pa.array(back)], names=["node", "part"])

    return met.mapInArrow(run, "node long, part double").groupBy("node").agg(F.sum("part").alias("total"))


#: Rows of a block of ``group_sums``.
GROUP_ROWS = 2048


def cross(rows: DataFrame, columns: DataFrame, row: str, column: str, method: str = "spearman") -> DataFrame:
    """``row, column, r``: every row of one table of ``values`` against every row of the other.

    Both go to blocks by hash; each pair of blocks meets once by an equi-join and is one matrix product.
    Correlations that are not finite are null.
    """
    n_rows, n_columns = rows.count(), columns.count()
    a, b = max(1, -(-n_rows // BLOCK_ROWS)), max(1, -(-n_columns // BLOCK_ROWS))
    a = max(a, min(n_rows, rows.sparkSession.sparkContext.defaultParallelism) // b or 1)

    def blocked(df: DataFrame, name: str, count: int, label: str) -> DataFrame:
        def build(key: tuple, table: pa.Table) -> pa.Table:
            z = prepared(_stack(table["values"]), method)
            return pa.table({label: pa.array([key[0].as_py()], pa.int32()), f"{label}_ids": [table[name].to_pylist()], f"{label}_z": pa.array([np.ascontiguousarray(z).tobytes()], pa.binary())})

        placed = df.select(F.pmod(F.xxhash64(name), F.lit(count)).cast("int").alias(label), name, "values")
        return placed.groupBy(label).applyInArrow(build, f"{label} int, {label}_ids array<{df.schema[name].dataType.simpleString()}>, {label}_z binary")

    met = blocked(rows, row, a, "i").withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(b - 1)))).join(blocked(columns, column, b, "j").withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(a - 1)))), ["i", "j"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                x, y = batch.column("i_ids")[k].values, batch.column("j_ids")[k].values
                za, zb = _rows_of(batch.column("i_z")[k].as_py(), len(x), method), _rows_of(batch.column("j_z")[k].as_py(), len(y), method)
                for at in range(0, len(x), TILE_ROWS):
                    r = np.clip(_products(za[at : at + TILE_ROWS], zb, method), -1.0, 1.0)
                    i, j = np.divmod(np.arange(r.size), len(y))
                    flat = r.ravel()
                    yield pa.RecordBatch.from_arrays([x.take(pa.array(i + at)), y.take(pa.array(j)), pa.array(flat, mask=~np.isfinite(flat))], names=[row, column, "r"])

    kinds = f"`{row}` {rows.schema[row].dataType.simpleString()}, `{column}` {columns.schema[column].dataType.simpleString()}, r double"
    return met.mapInArrow(run, kinds)
