"""Modules of genes: mutual neighbours, connected components, their profiles and statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.operators.correlate import cross, group_sums, pairwise
from cohortloom.session import cut_lineage

#: Neighbours of a gene, unless there are fewer genes.
NEIGHBOURS = 20
MAX_ROUNDS = 60


def neighbour_count(genes: int) -> int:
    return max(2, min(NEIGHBOURS, genes - 1))


def mutual_edges(vectors: DataFrame, width: int, k: int, gene: str = "gene_id") -> DataFrame:
    """Edges ``gene_a, gene_b, ord_a, ord_b, r`` (ord_a < ord_b) between genes that are both among the other's ``k`` best positive Spearman neighbours."""
    near = pairwise(vectors, "spearman", width, top=k, positive=True, gene=gene)
    back = near.select(F.col("ord_b").alias("ord_a"), F.col("ord_a").alias("ord_b"))
    return near.where("ord_a < ord_b").join(back, ["ord_a", "ord_b"], "left_semi").select("gene_a", "gene_b", "ord_a", "ord_b", "r")


def components(edges: DataFrame, a: str = "ord_a", b: str = "ord_b") -> DataFrame:
    """``node, component`` for every node of an undirected graph; the component is its smallest node.

    Nodes have a random rank, the hash of their id, so that even long paths of ordered ids have a
    smallest rank every few nodes. Nodes with one label are a tree. Each round every tree takes the
    smallest label next to any of its nodes, the trees' new labels are followed two more steps, and all
    nodes take their tree's. The number of trees falls by a factor each round. Rounds are cut by a
    written checkpoint; whether any label changed is all that reaches the driver.
    """
    ranked = lambda c: F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("n"))
    ends = edges.select(ranked(a).alias("u"), ranked(b).alias("v")).where("u <> v")
    both = cut_lineage(ends.unionByName(ends.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct())
    labels = cut_lineage(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("label")))
    for _ in range(MAX_ROUNDS):
        near = both.join(labels.select(F.col("u").alias("v"), F.col("label").alias("near")), "v").join(labels, "u")
        trees = cut_lineage(near.groupBy("label").agg(F.least(F.col("label"), F.min("near")).alias("to")))
        if not trees.where("`to` <> label").limit(1).count():
            smallest = labels.groupBy("label").agg(F.min("u.n").alias("component"))
            return labels.join(smallest, "label").select(F.col("u.n").alias("node"), "component")
        for _ in range(2):
            on = trees.select(F.col("label").alias("to"), F.col("to").alias("next"))
            trees = trees.join(on, "to", "left").select("label", F.least("to", F.coalesce("next", "to")).alias("to"))
        labels = cut_lineage(labels.join(trees, "label").select("u", F.col("to").alias("label")))
    raise RuntimeError("components did not settle")


def modules(edges: DataFrame, min_size: int = 25, top: int = 500) -> DataFrame:
    """``module_id, module_size, gene, ord, rank_in_module, connectivity`` of the components of ``edges``.

    Components smaller than max(2, ``min_size``) are left out. Connectivity is the sum of a gene's
    positive correlations within its whole component; each module keeps its ``top`` best connected
    genes, and ids follow the size that is left, ties by the smallest gene.
    """
    nodes = components(edges)
    ends = F.explode(F.array(F.struct(F.col("ord_a").alias("node"), F.col("gene_a").alias("gene")), F.struct(F.col("ord_b").alias("node"), F.col("gene_b").alias("gene"))))
    genes = edges.select(ends.alias("e")).select("e.*").distinct()
    members = nodes.join(genes, "node")
    sizes = members.groupBy("component").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= max(2, min_size))
    return members.join(sizes, "component").drop("n")


def ranked_modules(members: DataFrame, connectivity: DataFrame, top: int = 500) -> DataFrame:
    """Members ``node, component, gene`` with ``node, connectivity`` as ranked and numbered modules."""
    scored = members.join(connectivity, "node")
    inside = Window.partitionBy("component").orderBy(F.col("connectivity").desc(), "node")
    kept = scored.withColumn("rank_in_module", F.row_number().over(inside).cast("long")).where(F.col("rank_in_module") <= max(2, top))
    sizes = kept.groupBy("component").agg(F.count(F.lit(1)).alias("module_size"))
    numbered = sizes.withColumn("no", F.row_number().over(Window.orderBy(F.col("module_size").desc(), "component")))
    named = numbered.select("component", "module_size", F.concat(F.lit("M"), F.lpad(F.col("no").cast("string"), 4, "0")).alias("module_id"))
    return kept.join(named, "component").select("module_id", "module_size", "gene", F.col("node").alias("ord"), "rank_in_module", "connectivity")


def component_connectivity(vectors: DataFrame, members: DataFrame) -> DataFrame:
    """``node, connectivity``: the sum of max(r, 0) over the other genes of the same component; only these pairs are made."""
    sums = group_sums(vectors, members.select("node", "component"))
    return members.select("node").join(sums, "node", "left").select("node", F.coalesce("total", F.lit(0.0)).alias("connectivity"))


def eigengenes(ranked: DataFrame, long: DataFrame, gene: str = "gene_id", sample: str = "sample_id") -> DataFrame:
    """``module_id, sample_id, value``: the mean of a module's members in each sample."""
    members = ranked.select("module_id", F.col("gene").alias(gene))
    return long.join(members, gene).groupBy("module_id", sample).agg(F.avg("value").alias("value"))


def module_tstats(vectors: DataFrame, profiles: DataFrame, width: int, gene: str = "gene_id") -> DataFrame:
    """``module_id, gene_id, r, t`` of every gene against every module: Spearman's r and its t-statistic.

    ``vectors`` has ``gene_id, values``, ``profiles`` ``module_id, values``, over the same ``width``
    samples. r is 0 without variance; t = r sqrt((n - 2) / (1 - r^2)) with r kept from +-1, and 0 for n <= 2.
    """
    met = cross(vectors.select(gene, "values"), profiles.select("module_id", "values"), gene, "module_id")
    r = F.coalesce("r", F.lit(0.0))
    safe = F.greatest(F.lit(-0.9999999), F.least(F.lit(0.9999999), r))
    t = safe * F.sqrt(F.lit(float(width - 2)) / (1 - safe * safe)) if width > 2 else F.lit(0.0)
    return met.select("module_id", gene, r.alias("r"), t.alias("t"))
