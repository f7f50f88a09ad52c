"""Design matrices and the removal of their effects from a matrix."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Numbers that make a covariate numeric; blank and spelled-out values make it categorical.
_NUMBER = re.compile(r"[+-]?(?:[0-9]+(?:\.[0-9]*)?|\.[0-9]+)(?:[eE][+-]?[0-9]+)?|[+-]?(?:inf|infinity|nan)", re.I)


def formula_terms(formula: str) -> list[str]:
    """The columns a formula names, sorted: interactions become their columns, numbers and ``Intercept`` drop out."""
    tokens = re.split(r"[^A-Za-z0-9_]+", formula)
    return sorted({t for t in tokens if t and not t.isdigit() and t != "Intercept"})


def check_formula(formula: str, columns: list[str]) -> None:
    missing = [t for t in formula_terms(formula) if t not in columns]
    if missing:
        raise ValueError(f"design columns missing in the samplesheet: {', '.join(missing)}")


def design_matrix(sheet: dict[object, dict[str, object]], samples: list, formula: str) -> tuple[np.ndarray, list[str]]:
    """Design of ``samples`` (in order) and its column names.

    An intercept always; a column of numbers as it is, if every value is one; else an indicator for
    each level but the lexicographically first; a column with one level adds nothing. A missing
    sample or column is an error.
    """
    terms = formula_terms(formula)
    lost = [s for s in samples if s not in sheet]
    if lost:
        raise ValueError(f"samples without a samplesheet row: {lost[:5]}")
    columns, names = [np.ones(len(samples))], ["Intercept"]
    for term in terms:
        if any(term not in sheet[s] for s in samples):
            raise ValueError(f"design column missing in the samplesheet: {term}")
        texts = ["" if (v := sheet[s][term]) is None else str(v) for s in samples]
        if all(_NUMBER.fullmatch(t) for t in texts):
            columns.append(np.array([float(t) for t in texts]))
            names.append(term)
            continue
        for level in sorted(set(texts))[1:]:
            columns.append(np.array([float(t == level) for t in texts]))
            names.append(f"{term}={level}")
    return np.column_stack(columns), names


def column_basis(design: np.ndarray, epsilon: float = 1e-12) -> np.ndarray:
    """Orthonormal basis of the design's columns, also where they depend on each other."""
    u, s, _ = np.linalg.svd(design, full_matrices=False)
    return u[:, s > epsilon * max(1.0, s.max(initial=0.0))]


def residualize(vectors: DataFrame, design: np.ndarray, gene: str = "gene_id") -> DataFrame:
    """``gene_id, values`` with the least-squares fit on ``design`` taken from each row.

    The basis is found once; what is broadcast has samples times design columns, never samples squared.
    Rows of another length stay as they are.
    """
    shared = vectors.sparkSession.sparkContext.broadcast(column_basis(design))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = shared.value
        for batch in batches:
            rows = batch.column(1)
            whole = pc.equal(pc.list_value_length(rows), len(q)).to_numpy(zero_copy_only=False).astype(bool)
            if whole.all():
                x = rows.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(rows), len(q))
                values = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * len(q)), pa.array((x - (x @ q) @ q.T).ravel()))
            else:
                fitted = [y - q @ (q.T @ y) if ok else y for y, ok in zip((np.array(r or [], float) for r in rows.to_pylist()), whole, strict=True)]
                values = pa.array([r.tolist() for r in fitted], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), values], names=[gene, "values"])

    return vectors.select(gene, "values").mapInArrow(run, f"`{gene}` {vectors.schema[gene].dataType.simpleString()}, values array<double>")


def adjust(vectors: DataFrame, sheet: DataFrame, samples: list, formula: str, sample: str = "sample_id", mode: str = "residualize") -> DataFrame:
    """The matrix without the effects that ``formula`` names; ``mode`` ``none`` leaves it as it is.

    The samplesheet is read for the matrix's own samples, whose number a gene's row bounds.
    """
    if mode == "none":
        return vectors
    return residualize(vectors, design_for(sheet, samples, formula, sample)[0])


def design_for(sheet: DataFrame, samples: list, formula: str, sample: str = "sample_id") -> tuple[np.ndarray, list[str]]:
    """``design_matrix`` of a samplesheet table, read for ``samples`` alone, which are joined and not written into the plan."""
    check_formula(formula, sheet.columns)
    wanted = sheet.sparkSession.createDataFrame([(s,) for s in samples], f"`{sample}` {sheet.schema[sample].dataType.simpleString()}")
    rows = sheet.select(sample, *formula_terms(formula)).join(wanted, sample, "left_semi").dropDuplicates([sample]).collect()
    return design_matrix({r[sample]: r.asDict() for r in rows}, samples, formula)
