"""Gene-set enrichment of ranked genes, and the adjustment of p-values."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MIN_PERMUTATIONS = 100


def bh_adjust(df: DataFrame, group: list[str], p: str = "p_value", name: str = "padj", order: list[str] | None = None) -> DataFrame:
    """Benjamini-Hochberg: the least p n / rank over this and all later ranks, at most 1; null stays null."""
    known = Window.partitionBy(*group, F.col(p).isNull())
    by_p = known.orderBy(p, *(order or []))
    rank, n = F.row_number().over(by_p), F.count(p).over(known)
    marked = df.withColumns({"__raw": F.col(p) * n / rank, "__rank": rank})
    # From the last rank down, since a frame that grows at its end is kept up row by row.
    later = Window.partitionBy(*group, F.col(p).isNull()).orderBy(F.col("__rank").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return marked.withColumn(name, F.when(F.col(p).isNotNull(), F.least(F.lit(1.0), F.min("__raw").over(later)))).drop("__raw", "__rank")


def running_scores(ranked: DataFrame, sets: DataFrame, module: str = "module_id", gene: str = "gene_id", score: str = "t", weight: float = 1.0) -> DataFrame:
    """``module, pathway, size, es``: the enrichment score of each gene set, by window sums alone.

    Genes are in order of the score from high to low, ties by id. The running sum rises by the share
    of \\|score\\|^weight at members and falls evenly at others; the score is its farthest value from 0,
    the positive one if both are as far. Only member rows are joined, since the sum's extremes lie at
    members: just after one from above, just before one from below.
    """
    order = Window.partitionBy(module).orderBy(F.col(score).desc(), gene)
    placed = ranked.withColumns({"place": F.row_number().over(order), "n": F.count(F.lit(1)).over(Window.partitionBy(module))})
    members = placed.join(sets.select("pathway", gene).distinct(), gene)
    strength = F.pow(F.abs(F.col(score)), F.lit(weight))
    by_set = Window.partitionBy(module, "pathway")
    upto = by_set.orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    walk = members.withColumns({"w": strength, "size": F.count(F.lit(1)).over(by_set), "total": F.sum(strength).over(by_set), "hits": F.row_number().over(by_set.orderBy("place")), "sofar": F.sum(strength).over(upto)})
    misses = F.try_divide((F.col("place") - F.col("hits")).cast("double"), (F.col("n") - F.col("size")).cast("double"))
    rise = lambda c: F.coalesce(F.try_divide(c, F.col("total")), F.lit(0.0))
    ends = walk.withColumns({"high": rise(F.col("sofar")) - F.coalesce(misses, F.lit(0.0)), "low": rise(F.col("sofar") - F.col("w")) - F.coalesce(misses, F.lit(0.0))})
    peaks = ends.groupBy(module, "pathway").agg(F.max("size").alias("size"), F.max("high").alias("high"), F.min("low").alias("low"))
    return peaks.select(module, "pathway", "size", F.when(F.col("high") >= -F.col("low"), F.col("high")).otherwise(F.col("low")).alias("es"))


def _scores(w: np.ndarray, places: np.ndarray, n: int) -> np.ndarray:
    """Enrichment scores of many sets of equal size: sorted ``places`` by row."""
    k = places.shape[1]
    s = w[places]
    total = s.sum(1, keepdims=True)
    share = np.divide(s, total, out=np.zeros_like(s), where=total > 0)
    sofar = share.cumsum(1)
    miss = (places - np.arange(k)) / max(1, n - k)
    high, low = (sofar - miss).max(1), (sofar - share - miss).min(1)
    return np.where(high >= -low, high, low)


def permutation_test(ranked: DataFrame, sets: DataFrame, permutations: int = 1000, seed: int = 42, min_size: int = 10, module: str = "module_id", gene: str = "gene_id", score: str = "t") -> DataFrame:
    """Pre-ranked enrichment: ``module, pathway, size, es, nes, p_value, padj, log2err, leading_edge_size``.

    Sets of ``min_size`` to n - 1 genes take part. Each is compared with random sets of its size, by a
    generator seeded by ``seed``, the module and the size, so results don't depend on partitions; the
    sign of the score picks the half of the null. A module's genes (one row each) are one group.
    """
    rounds = max(MIN_PERMUTATIONS, permutations)
    modules = ranked.groupBy(module).agg(F.collect_list(F.struct(F.col(score).alias("s"), F.col(gene).alias("g"))).alias("genes"))
    memberships = ranked.select(module, gene).join(sets.select("pathway", gene).distinct(), gene).groupBy(module, "pathway").agg(F.collect_list(gene).alias("members"))
    by_module = memberships.groupBy(module).agg(F.collect_list(F.struct("pathway", "members")).alias("sets")).join(modules, module)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                data = row._asdict()
                genes = sorted(((-g["s"], g["g"]) for g in data["genes"]))
                at = {g: i for i, (_, g) in enumerate(genes)}
                w, n = np.abs(np.array([s for s, _ in genes])), len(genes)
                least = min(min_size, max(n - 1, 2))
                nulls: dict[int, np.ndarray] = {}
                out = []
                for s in sorted(data["sets"], key=lambda x: x["pathway"]):
                    places = np.sort(np.array([at[g] for g in s["members"]]))
                    k = len(places)
                    if not least <= k <= max(n - 1, 2) or k >= n:
                        continue
                    if k not in nulls:
                        key = [seed, k, *str(data[module]).encode()]
                        rng = np.random.default_rng(key)
                        draws = np.sort(np.stack([rng.choice(n, k, replace=False) for _ in range(rounds)]), axis=1)
                        nulls[k] = _scores(w, draws, n)
                    null, es = nulls[k], float(_scores(w, places[None], n)[0])
                    half = null[null >= 0] if es >= 0 else -null[null < 0]
                    beyond = int((half >= abs(es)).sum())
                    p = (beyond + 1) / (len(half) + 1)
                    mean = half.mean() if len(half) else np.nan
                    share = np.divide(w[places], w[places].sum() or 1.0).cumsum() - (places - np.arange(k)) / max(1, n - k)
                    edge = int(share.argmax()) + 1 if es >= 0 else k - int((share - np.divide(w[places], w[places].sum() or 1.0)).argmin())
                    error = float(np.sqrt(max(0.0, (1 - p) / (p * (len(half) + 1)))) / np.log(2))
                    out.append((data[module], s["pathway"], k, es, es / mean if mean else np.nan, p, error, edge))
                yield pd.DataFrame(out, columns=[module, "pathway", "size", "es", "nes", "p_value", "log2err", "leading_edge_size"])

    kind = ranked.schema[module].dataType.simpleString()
    tested = by_module.mapInPandas(run, f"`{module}` {kind}, pathway {sets.schema['pathway'].dataType.simpleString()}, size long, es double, nes double, p_value double, log2err double, leading_edge_size long")
    return bh_adjust(tested, [module], order=["pathway"])


def z_to_p(z: Column) -> Column:
    """Two-sided p of a standard normal statistic, to about 1e-7 by a rational approximation."""
    x = F.abs(z)
    t = 1.0 / (1.0 + 0.2316419 * x)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    return F.least(F.lit(1.0), 2.0 * F.exp(-x * x / 2.0) / F.lit(2.5066282746310002) * poly)
