"""The stages of a cohort as replaceable parts, and the stage of differential expression put together."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Protocol

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.operators import design, matrix, metadata, normalize, qc
from cohortloom.operators.correlate import correlate
from cohortloom.session import cut_lineage


class Resolver(Protocol):
    """Reports of a project to its runs."""

    def resolve(self, reports: DataFrame, project_id: str) -> DataFrame: ...


class Judge(Protocol):
    """Preprocessing reports to verdicts."""

    def judge(self, reports: DataFrame) -> DataFrame: ...


class Adjuster(Protocol):
    """Gene vectors to gene vectors without the effects of a formula."""

    def adjust(self, vectors: DataFrame, sheet: DataFrame, samples: list, formula: str) -> DataFrame: ...


class Correlator(Protocol):
    """Ordered gene vectors to edges."""

    def correlate(self, vectors: DataFrame, method: str, output: str, width: int) -> DataFrame: ...


class Tester(Protocol):
    """Count vectors to tests of contrasts."""

    def test(self, vectors: DataFrame, sizes: np.ndarray, x: np.ndarray, contrasts: dict[str, np.ndarray]) -> DataFrame: ...


@dataclass(frozen=True)
class Stages:
    """This package's own parts; any of them may be replaced by a subclass."""

    gate: qc.Gate = field(default_factory=qc.Gate)

    def resolve(self, reports: DataFrame, project_id: str) -> DataFrame:
        return metadata.report_runs(reports, project_id)

    def judge(self, reports: DataFrame) -> DataFrame:
        return qc.apply_gate(qc.gate_rates(qc.qc_record(reports)), self.gate)

    def adjust(self, vectors: DataFrame, sheet: DataFrame, samples: list, formula: str) -> DataFrame:
        return design.adjust(vectors, sheet, samples, formula)

    def correlate(self, vectors: DataFrame, method: str, output: str, width: int) -> DataFrame:
        return correlate(vectors, method, output, width)

    def test(self, vectors: DataFrame, sizes: np.ndarray, x: np.ndarray, contrasts: dict[str, np.ndarray]) -> DataFrame:
        return normalize.wald_test(vectors, sizes, x, contrasts)


@dataclass(frozen=True)
class ExpressionResult:
    """Counts, normalised and transformed counts, size factors, and the tests of all contrasts."""

    counts: DataFrame
    norm: DataFrame
    transformed: DataFrame
    factors: DataFrame
    tests: DataFrame | None


def run_expression(
    transcripts: DataFrame, tx2gene: DataFrame, sheet: DataFrame, formula: str = "~ batch + condition", contrasts: list[str] = (), mode: str = "lengthScaledTPM",
    transform: str = "vst", stages: Tester | None = None, sample: str = "sample_id",
) -> ExpressionResult:
    """Transcript abundance to gene counts, size factors, a transformation and tests of ``factor|A|B`` contrasts.

    ``sheet`` has a row per sample; samples without abundance, and those without a row, are left out. At
    least two have to be left, the formula's columns and the contrasts' factors have to be in the sheet.
    """
    design.check_formula(formula, sheet.columns)
    wanted = [normalize.contrast(c) for c in contrasts]
    normalize.check_contrasts(wanted, sheet.columns)
    kept = transcripts.join(sheet.select(sample).distinct(), sample, "left_semi")
    counts = cut_lineage(normalize.gene_counts(normalize.gene_abundance(kept, tx2gene), mode))
    samples = matrix.sample_order(counts, sample)
    normalize.check_runs(len(samples), "deseq2")
    factors = cut_lineage(normalize.size_factors(counts))
    sizes = {r[sample]: r["size_factor"] for r in factors.collect()}
    transformed = normalize.stabilized(counts, factors, samples, transform)
    tests = None
    if wanted:
        x, names = design.design_for(sheet, samples, formula, sample)
        vectors = matrix.to_vectors(counts, samples, missing=0.0)
        weights = {}
        for factor, a, b, name in wanted:
            present = sheet.where(F.col(sample).isin(samples)).select(F.coalesce(F.col(factor).cast("string"), F.lit(""))).distinct()
            weights[name] = normalize.contrast_vector(names, factor, a, b, sorted(r[0] for r in present.collect()))
        tests = (stages or Stages()).test(vectors, np.array([sizes[s] for s in samples]), x, weights)
    return ExpressionResult(counts, normalize.normalized(counts, factors), transformed, factors, tests)
