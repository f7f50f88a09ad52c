"""All queries of the core by name, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cohortloom.plans import matrices, problems, problems_sql, relational


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return problems.QUERIES | relational.QUERIES | matrices.QUERIES


def oracles() -> dict[str, str]:
    return problems_sql.ORACLES | relational.ORACLES | matrices.ORACLES


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matrices.adjusted_corr_edges(spark, sf_dir)
