"""Writers of results: matrices, edges, samplesheets, reference tables, manifests."""

from __future__ import annotations

import hashlib
import json
import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.operators.matrix import dense

# The stable columns of a samplesheet, in order; metadata columns follow, sorted.
SHEET_COLUMNS = (
    "project_id", "study_accession", "run_accession", "sample_accession", "experiment_accession", "library_layout",
    "instrument_platform", "instrument_model", "read1_path", "read2_path", "condition", "batch",
)
# The columns of the module, statistic, enrichment and edge tables.
MODULE_COLUMNS = ("module_id", "module_size", "gene", "rank_in_module", "connectivity")
TSTAT_COLUMNS = ("module_id", "gene", "t_value")
ENRICHMENT_COLUMNS = ("module_id", "module_size", "pathway", "pathway_size", "es", "nes", "p_value", "padj", "log2err", "leading_edge_size")
EDGE_COLUMNS = ("gene_a", "gene_b", "r")
ANNOTATED_EDGE_COLUMNS = ("gene_a_id", "gene_a_symbol", "gene_a_biotype", "gene_b_id", "gene_b_symbol", "gene_b_biotype", "r")


def write_table(df: DataFrame, path: str, order: list[str] | None = None) -> None:
    """A tab-separated table with a header; null is an empty field."""
    out = df.orderBy(*order) if order else df
    out.write.mode("overwrite").csv(path, sep="\t", header=True, nullValue="", emptyValue="")


def write_matrix(long: DataFrame, path: str) -> None:
    """A wide matrix; a gene without a value in each sample is an error."""
    samples = long.select("sample_id").distinct().count()
    short = long.groupBy("gene_id").agg(F.count("value").alias("n")).where(F.col("n") != samples).limit(1).collect()
    if short:
        raise ValueError(f"row {short[0]['gene_id']} has {short[0]['n']} of {samples} values")
    write_table(dense(long), path, ["gene_id"])


def edge_table(edges: DataFrame, annotation: DataFrame | None = None) -> DataFrame:
    """Edges as they are written: both genes and r, with an annotation also their symbols and biotypes."""
    if annotation is None:
        return edges.select(*EDGE_COLUMNS)
    from cohortloom.operators.annotate import annotate_edges

    named = annotation.select("gene_id", F.col("gene_name").alias("symbol"), F.col("gene_biotype").alias("biotype"))
    c = F.col
    rows = annotate_edges(edges.select(*EDGE_COLUMNS), named)
    values = (c("gene_a"), c("a_symbol"), c("a_biotype"), c("gene_b"), c("b_symbol"), c("b_biotype"), c("r"))
    return rows.select(*[v.alias(n) for v, n in zip(values, ANNOTATED_EDGE_COLUMNS, strict=True)])


def write_edges(edges: DataFrame, path: str, annotation: DataFrame | None = None) -> None:
    """``path`` with the edges; with an annotation also ``path`` with ``_annotated`` before its suffix."""
    write_table(edge_table(edges), path)
    if annotation is not None:
        write_table(edge_table(edges, annotation), _annotated(path))


def _annotated(path: str) -> str:
    stem, dot, suffix = path.rpartition(".")
    return f"{stem}_annotated.{suffix}" if dot and "/" not in suffix else f"{path}_annotated"


def dense_table(pairs: DataFrame) -> DataFrame:
    """The dense form of ``pairwise(diagonal=True)`` as a wide table, a column per gene; refused for too many genes."""
    return dense(pairs.select(F.col("gene_a").alias("gene_id"), "gene_b", "r"), "gene_id", "gene_b", "r")


def write_dense_correlation(pairs: DataFrame, path: str) -> None:
    write_table(dense_table(pairs), path, ["gene_id"])


def annotated_table(table: DataFrame, annotation: DataFrame, gene: str = "gene_id") -> DataFrame:
    """A gene table with symbol and biotype right after its gene column."""
    from cohortloom.operators.annotate import annotate

    named = annotation.select(F.col("gene_id").alias("__gene"), F.col("gene_name").alias("gene_symbol"), "gene_biotype")
    at = table.columns.index(gene) + 1
    return annotate(table, named, gene, "__gene").select(*table.columns[:at], "gene_symbol", "gene_biotype", *table.columns[at:])


def write_gene_table(table: DataFrame, path: str, annotation: DataFrame | None = None, order: list[str] | None = None, gene: str = "gene_id") -> None:
    """A gene table, and with an annotation its annotated sidecar."""
    write_table(table, path, order)
    if annotation is not None:
        write_table(annotated_table(table, annotation, gene), _annotated(path), order)


def module_tables(ranked: DataFrame, stats: DataFrame, tested: DataFrame) -> dict[str, DataFrame]:
    """The module, statistic and enrichment tables as they are written, by file name."""
    sizes = ranked.select("module_id", "module_size").distinct()
    enriched = tested.withColumnRenamed("size", "pathway_size").join(sizes, "module_id")
    return {
        "modules_top_genes.tsv": ranked.select(*MODULE_COLUMNS),
        "module_t_values.tsv": stats.select("module_id", F.col("gene_id").alias("gene"), F.col("t").alias("t_value")).select(*TSTAT_COLUMNS),
        "module_fgsea.tsv": enriched.select(*ENRICHMENT_COLUMNS),
    }


def write_modules(ranked: DataFrame, stats: DataFrame, tested: DataFrame, folder: str) -> None:
    order = {"modules_top_genes.tsv": ["module_id", "rank_in_module"], "module_t_values.tsv": ["module_id", "gene"], "module_fgsea.tsv": ["module_id", "padj", "pathway"]}
    for name, table in module_tables(ranked, stats, tested).items():
        write_table(table, os.path.join(folder, name), order[name])


def write_expression(counts: DataFrame, norm: DataFrame, transformed: DataFrame, factors: DataFrame, tests: dict[str, DataFrame], folder: str, annotation: DataFrame | None = None) -> list[str]:
    """The tables of differential expression: matrices, size factors and one table per contrast. Gives their names."""
    from cohortloom.operators.normalize import safe_name

    names = []
    for name, long in (("gene_counts.tsv", counts), ("gene_norm_counts.tsv", norm), ("vst.tsv", transformed)):
        write_gene_table(dense(long), os.path.join(folder, name), annotation, ["gene_id"])
        names.append(name)
    write_table(factors.select(F.col("sample_id").alias("run_accession"), "size_factor"), os.path.join(folder, "size_factors.tsv"), ["run_accession"])
    for contrast, table in tests.items():
        name = f"de_{safe_name(contrast)}.tsv"
        write_gene_table(table, os.path.join(folder, name), annotation, ["gene_id"])
        names.append(name)
    return [*names, "size_factors.tsv"]


def sheet_table(runs: DataFrame, metadata: DataFrame, column_map: DataFrame, artifacts: DataFrame) -> DataFrame:
    """A row per run: the stable columns and ``metadata``, the rest of its attributes.

    Condition and batch are the run's own, else those of its first mapped column; they leave the rest.
    The read paths are the run's first artifacts of their kinds, by path.
    """
    from cohortloom.operators.metadata import samplesheet

    first = lambda *kinds: F.min(F.when(F.col("kind").isin(*kinds), F.col("path")))
    paths = artifacts.where(F.col("run_accession").isNotNull()).groupBy("run_accession").agg(first("FASTQ_R1", "FASTQ_SINGLE").alias("read1_path"), first("FASTQ_R2").alias("read2_path"))
    named = samplesheet(runs, metadata, column_map).select("run_accession", "condition", "batch")
    rest = F.map_filter("metadata", lambda k, v: ~k.isin("condition", "batch"))
    out = runs.join(named, "run_accession", "left").join(metadata.select("run_accession", rest.alias("metadata")), "run_accession", "left").join(paths, "run_accession", "left")
    none = F.lit(None).cast("string")
    return out.select(*[F.col(c) if c in out.columns else none.alias(c) for c in SHEET_COLUMNS], "metadata")


def write_samplesheet(runs: DataFrame, metadata: DataFrame, column_map: DataFrame, artifacts: DataFrame, path: str) -> list[str]:
    """The samplesheet, ordered by run: the stable columns, then one per metadata field in use, sorted. Gives the header."""
    from cohortloom.operators.matrix import DENSE_COLUMNS

    table = sheet_table(runs, metadata, column_map, artifacts)
    keys = table.select(F.explode(F.map_keys("metadata")).alias("k")).where(~F.col("k").isin(*SHEET_COLUMNS))
    fields = [r[0] for r in keys.distinct().orderBy("k").limit(DENSE_COLUMNS + 1).collect()]
    if len(fields) > DENSE_COLUMNS:
        raise ValueError(f"more than {DENSE_COLUMNS} metadata columns")
    wide = table.select(*SHEET_COLUMNS, *[F.element_at("metadata", F.lit(f)).alias(f) for f in fields])
    write_table(wide, path, ["run_accession"])
    return [*SHEET_COLUMNS, *fields]


def write_samplesheet_schema(path: str) -> dict:
    """What a samplesheet's columns are, as JSON."""
    notes = ["One row for each run_accession.", "Metadata columns follow the stable ones as they are.", "condition and batch are given, or found through the column map."]
    schema = {"schema_version": 1, "format": "tsv", "stable_columns": list(SHEET_COLUMNS), "notes": notes}
    with open(path, "w", encoding="utf-8") as f:
        json.dump(schema, f, indent=2)
    return schema


def write_reference(records: DataFrame, folder: str) -> None:
    """The transcript and gene tables of an annotation, sorted and distinct."""
    from cohortloom.operators.annotate import gene_annotation, tx2gene

    write_table(tx2gene(records), os.path.join(folder, "tx2gene.tsv"), ["transcript_id", "gene_id"])
    write_table(gene_annotation(records), os.path.join(folder, "gene_annotation.tsv"), ["gene_id"])


def write_manifest(path: str, stage: str, parameters: dict, inputs: dict[str, str], outputs: list[str]) -> dict:
    """What a stage was run with, as JSON."""
    manifest = {"schema_version": 1, "stage": stage, "parameters": parameters, "inputs": inputs, "outputs": sorted(outputs), "fingerprint": fingerprint(stage, parameters, inputs)}
    with open(path, "w", encoding="utf-8") as f:
        json.dump(manifest, f, indent=2, sort_keys=True)
    return manifest


def fingerprint(stage: str, parameters: dict, inputs: dict[str, str]) -> str:
    """Identity of a computation: its stage, parameters and the identities of its inputs."""
    return hashlib.sha256(json.dumps([stage, parameters, inputs], sort_keys=True, default=str).encode()).hexdigest()
