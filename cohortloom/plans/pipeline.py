"""The stages of a cohort put together: matrix to edges, modules and enrichment."""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame

from cohortloom.operators import annotate, design, enrich, matrix, modules
from cohortloom.operators.correlate import correlate
from cohortloom.session import cut_lineage


@dataclass(frozen=True)
class CorrelationConfig:
    """Settings of the correlation stage."""

    geneset: str = "topvar:5000"
    formula: str = "~ batch + condition"
    adjust: str = "residualize"
    method: str = "pearson"
    output: str = "edges:topk=50"
    module_top: int = 500
    module_min_size: int = 25
    permutations: int = 1000
    seed: int = 42

    def as_parameters(self) -> dict:
        return asdict(self)


@dataclass(frozen=True)
class CorrelationResult:
    edges: DataFrame
    modules: DataFrame | None = None
    tstats: DataFrame | None = None
    enrichment: DataFrame | None = None


def run_correlation(
    long: DataFrame, sheet: DataFrame, config: CorrelationConfig = CorrelationConfig(), annotation: DataFrame | None = None,
    gene_sets: DataFrame | None = None, genes: DataFrame | None = None, sample: str = "sample_id",
) -> CorrelationResult:
    """Select genes, remove covariates, correlate; with gene sets also find modules and their enrichment.

    ``long`` has ``gene_id, sample_id, value``. Chosen genes that lack a cell are left out, and the
    others numbered in their order without gaps, as the blocks of pairs need it. Gene sets need
    Spearman's correlation, at least two genes and three samples.
    """
    samples = matrix.sample_order(long, sample)
    chosen = matrix.chosen_genes(long, config.geneset, genes)
    if gene_sets is not None and len(samples) < 3:
        raise ValueError("modules need at least three samples")
    if gene_sets is not None and not gene_sets.limit(1).count():
        raise ValueError("modules need at least one pathway")
    vectors = matrix.to_vectors(matrix.subset(long, chosen), samples, sample=sample)
    adjusted = design.adjust(vectors, sheet, samples, config.formula, sample, config.adjust)
    placed = cut_lineage(adjusted.join(chosen.select("gene_id", "place"), "gene_id"))
    order = matrix.numbered(placed.select("gene_id", "place"), ["place"], "ord").drop("place")
    ordered = placed.drop("place").join(order, "gene_id")
    method = "spearman" if gene_sets is not None else config.method
    edges = correlate(ordered, method, config.output, len(samples))
    if annotation is not None:
        edges = annotate.annotate_edges(edges, annotation)
    if gene_sets is None:
        return CorrelationResult(edges)
    k = modules.neighbour_count(ordered.count())
    mutual = cut_lineage(modules.mutual_edges(ordered, len(samples), k))
    members = cut_lineage(modules.modules(mutual, config.module_min_size))
    if members.limit(1).count() == 0:
        raise ValueError("no module is large enough")
    ranked = cut_lineage(modules.ranked_modules(members, modules.component_connectivity(ordered, members), config.module_top))
    profiles = modules.eigengenes(ranked, matrix.to_long(ordered, samples))
    stats = cut_lineage(modules.module_tstats(ordered, matrix.to_vectors(profiles, samples, "module_id"), len(samples)))
    tested = enrich.permutation_test(stats, gene_sets, config.permutations, config.seed)
    return CorrelationResult(edges, ranked, stats, tested)
