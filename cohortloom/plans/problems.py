"""Queries of the general data problems."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.functions.text import accession
from cohortloom.operators import drift, eav, packed, references, tree
from cohortloom.session import table

PACKED_FIELDS = ["fastq_ftp", "fastq_md5", "fastq_bytes", "submitted_ftp"]
#: Share of all rows from which on a study counts as one that holds most of them.
DOMINANT_SHARE = 0.05


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    refs = references.run_references(table(spark, sf_dir, "override_rows"), table(spark, sf_dir, "run_metadata"))
    parents = references.run_parents(table(spark, sf_dir, "runs"))
    return references.orphan_references(refs, parents, references.run_removals(table(spark, sf_dir, "run_withdrawals")))


def p2_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return references.orphan_report(p2_found(spark, sf_dir))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed.split_packed(table(spark, sf_dir, "ena_reports"), "report_row_id", PACKED_FIELDS)


def p4_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per run with typed canonical columns and its cast failures as text."""
    column_map = table(spark, sf_dir, "column_map")
    resolved = eav.resolve_pairs(table(spark, sf_dir, "run_metadata"), column_map)
    wide = eav.wide_table(resolved, eav.canonical_fields(column_map))
    failed = F.array_join(F.transform(F.array_sort(F.map_entries("cast_failures")), lambda e: F.concat(e["key"], F.lit("="), e["value"])), "; ")
    return wide.withColumn("cast_failures", failed)


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    column_map = table(spark, sf_dir, "column_map")
    fields = eav.canonical_fields(column_map)
    wide = eav.wide_table(eav.resolve_pairs(table(spark, sf_dir, "run_metadata"), column_map), fields)
    return eav.filled_cells(wide, fields)


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A renaming counts here only between fields of one concept that no other changed field has; that rule is exact, without flooding."""
    return drift.schema_changes(table(spark, sf_dir, "runs"), table(spark, sf_dir, "resolver_configs"), table(spark, sf_dir, "column_map"), mapped_only=True)


def p5_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Like ``p5_found``, with the renamings that similarity flooding finds, also between fields without a concept or with several candidates."""
    return drift.schema_changes(table(spark, sf_dir, "runs"), table(spark, sf_dir, "resolver_configs"), table(spark, sf_dir, "column_map"))


def p5_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    column_map = table(spark, sf_dir, "column_map")
    return drift.unified_rows(table(spark, sf_dir, "runs"), column_map, eav.canonical_fields(column_map), drift.source_names(column_map))


def _studies(runs: DataFrame, rows: int) -> DataFrame:
    runs = runs.withColumn("study_accession", accession("study_accession"))
    failed = F.count_if(F.col("state").endswith("_FAILED"))
    return tree.tree_aggregate(
        runs,
        ["study_accession"],
        {"n_rows": F.count(F.lit(1)), "n_failed": failed, "first_at": F.min("ingested_at"), "last_at": F.max("ingested_at")},
        {"n_rows": F.sum, "n_failed": F.sum, "first_at": F.min, "last_at": F.max},
        rows=rows,
    )


def p7_studies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per study: rows, failed rows, first and last delivery."""
    runs = table(spark, sf_dir, "runs")
    return _studies(runs, runs.count())


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Studies with a share of all rows; the one count from the files' footers gives the tree's height and the total."""
    runs = table(spark, sf_dir, "runs")
    rows = runs.count()
    return tree.dominant_keys(_studies(runs, rows), "study_accession", "n_rows", rows, DOMINANT_SHARE)


QUERIES = {f.__name__: f for f in (p2_found, p2_report, p3_found, p4_found, p4_wide, p5_found, p5_changes, p5_table, p7_found, p7_studies)}
