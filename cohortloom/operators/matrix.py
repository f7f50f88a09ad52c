"""Gene by sample matrices: long and vector form, and selections of genes."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.session import cut_lineage

#: Cells of a dense table that is written out wide; larger ones are refused.
DENSE_COLUMNS = 5_000


#: Rows that one task numbers; more are numbered where they lie after a range partitioning.
ONE_TASK_ROWS = 1_000_000


def numbered(df: DataFrame, order: list[Column | str], name: str) -> DataFrame:
    """``df`` with a number from 1 without gaps in an order without ties.

    A table of more than ``ONE_TASK_ROWS`` rows is partitioned by ranges of the order and sorted within
    them; each row's number is its place there and the sum of the partitions before. What reaches the
    driver is one count per partition.
    """
    kept = cut_lineage(df)
    if kept.count() <= ONE_TASK_ROWS:
        return kept.withColumn(name, F.row_number().over(Window.orderBy(*order)).cast("long"))
    ranged = cut_lineage(kept.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id()))
    part = F.shiftright("__at", 33).cast("int")
    counts = dict(ranged.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect())
    before, total = [], 0
    for i in range(max(counts) + 1):
        before.append(total)
        total += counts.get(i, 0)
    offset = F.get(F.array(*[F.lit(n) for n in before]), part)
    return ranged.withColumn(name, offset + F.col("__at").bitwiseAND(F.lit((1 << 33) - 1)) + 1).drop("__at")


def with_order(long: DataFrame, gene: str = "gene_id") -> DataFrame:
    """``gene_id, ord``: a place for every gene, by its id, for stable ties."""
    return numbered(long.select(gene).distinct(), [gene], "ord")


def sample_order(long: DataFrame, sample: str = "sample_id") -> list:
    """The samples in order: the columns of the matrix, whose number one gene's row already holds."""
    return [r[0] for r in long.select(sample).distinct().orderBy(sample).collect()]


def _places(long: DataFrame, samples: list, sample: str) -> DataFrame:
    """``sample, at``: the samples' places; as many rows as a gene's array has elements, so it may be broadcast."""
    rows = [(s, i) for i, s in enumerate(samples)]
    return F.broadcast(long.sparkSession.createDataFrame(rows, f"`{sample}` {long.schema[sample].dataType.simpleString()}, at int"))


def to_vectors(long: DataFrame, samples: list, gene: str = "gene_id", sample: str = "sample_id", value: str = "value", missing: float | None = None) -> DataFrame:
    """``gene_id, values``: one array per gene in the order of ``samples``.

    A cell that is absent or null becomes ``missing``; without it a gene that lacks a cell is left out.
    Repeated cells are summed.
    """
    cells = long.select(gene, sample, F.col(value).cast("double").alias("v")).where(F.col("v").isNotNull()).join(_places(long, samples, sample), sample)
    summed = cells.groupBy(gene, "at").agg(F.sum("v").alias("v"))
    rows = summed.groupBy(gene).agg(F.collect_list("at").alias("at"), F.collect_list("v").alias("v"))
    if missing is None:
        rows = rows.where(F.size("at") == len(samples))
    width, fill = len(samples), np.nan if missing is None else float(missing)

    def scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, v = batch.column("at"), batch.column("v")
            grid = np.full((batch.num_rows, width), fill)
            row = np.repeat(np.arange(batch.num_rows), np.diff(at.offsets.to_numpy()))
            grid[row, at.flatten().to_numpy()] = v.flatten().to_numpy()
            offsets = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * width)
            yield pa.RecordBatch.from_arrays([batch.column(gene), pa.ListArray.from_arrays(offsets, pa.array(grid.ravel()))], names=[gene, "values"])

    return rows.mapInArrow(scatter, f"`{gene}` {long.schema[gene].dataType.simpleString()}, values array<double>")


def to_long(vectors: DataFrame, samples: list, gene: str = "gene_id", kind: str | None = None) -> DataFrame:
    """The cells ``gene_id, sample_id, value`` of vectors."""
    if kind is None:
        kind = "string" if samples and isinstance(samples[0], str) else "long"
    names = F.broadcast(vectors.sparkSession.createDataFrame(list(enumerate(samples)), f"at int, sample_id {kind}"))
    return vectors.select(gene, F.posexplode("values").alias("at", "value")).join(names, "at").select(gene, "sample_id", "value")


def gene_stats(long: DataFrame, gene: str = "gene_id") -> DataFrame:
    """Mean and population variance of each gene over its samples."""
    return long.groupBy(gene).agg(F.avg("value").alias("mean"), F.var_pop("value").alias("variance"), F.count("value").alias("n"))


def select_genes(long: DataFrame, spec: str = "all", genes: DataFrame | None = None, gene: str = "gene_id") -> DataFrame:
    """``gene_id, place`` of the genes that ``spec`` selects, in its order.

    ``all`` (or blank): every gene by id. ``topvar:N``: the N of highest variance, in that order, ties
    by id. ``mean_gt:X``: mean strictly above. ``genes:`` with ``genes`` (a table with ``gene_id``):
    those listed. ``regex:P``: the id contains a match. Anything else is an error.
    """
    kind, _, arg = (spec or "all").strip().partition(":")
    everything = long.select(gene).distinct()
    if kind == "topvar":
        if int(arg) < 1:
            raise ValueError("topvar needs a positive number")
        top = gene_stats(long, gene).orderBy(F.col("variance").desc(), gene).limit(int(arg))
        return numbered(top.select(gene, "variance"), [F.col("variance").desc(), gene], "place").select(gene, "place")
    if kind in ("all", ""):
        chosen = everything
    elif kind == "mean_gt":
        chosen = gene_stats(long, gene).where(F.col("mean") > float(arg)).select(gene)
    elif kind == "genes":
        if genes is None:
            raise ValueError("genes: needs the list of genes")
        listed = genes.select(F.trim(F.col(gene)).alias(gene)).where(F.col(gene) != "").distinct()
        chosen = everything.join(listed, gene, "left_semi")
    elif kind == "regex":
        re.compile(arg)
        chosen = everything.where(F.col(gene).rlike(arg))
    else:
        raise ValueError(f"unknown gene set: {spec!r}")
    return numbered(chosen.select(gene), [gene], "place")


def chosen_genes(long: DataFrame, spec: str = "all", genes: DataFrame | None = None, gene: str = "gene_id") -> DataFrame:
    """``select_genes`` for a correlation: a matrix of fewer than two genes passes as it is, a selection of
    fewer than two is an error, and one of all genes keeps the matrix's own order."""
    everything = numbered(long.select(gene).distinct(), [gene], "place")
    total = everything.count()
    if total < 2:
        return everything
    chosen = cut_lineage(select_genes(long, spec, genes, gene))
    n = chosen.count()
    if n < 2:
        raise ValueError(f"gene set {spec!r} selects fewer than 2 genes ({n})")
    return everything if n == total else chosen


def subset(long: DataFrame, chosen: DataFrame, gene: str = "gene_id") -> DataFrame:
    """The cells of the chosen genes."""
    return long.join(chosen.select(gene), gene, "left_semi")


def dense(long: DataFrame, gene: str = "gene_id", sample: str = "sample_id", value: str = "value") -> DataFrame:
    """The wide table of a long one, a column per sample; refused beyond ``DENSE_COLUMNS`` samples."""
    names = [r[0] for r in long.select(sample).distinct().orderBy(sample).limit(DENSE_COLUMNS + 1).collect()]
    if len(names) > DENSE_COLUMNS:
        raise ValueError(f"more than {DENSE_COLUMNS} columns")
    return long.groupBy(gene).pivot(sample, names).agg(F.sum(value))


def average_rank(df: DataFrame, group: list[str], value: str, name: str = "rank") -> DataFrame:
    """Rank of ``value`` in its group, equal values sharing the mean of their places."""
    ordered, same = Window.partitionBy(*group).orderBy(value), Window.partitionBy(*group, value)
    return df.withColumn(name, F.rank().over(ordered) + (F.count(F.lit(1)).over(same) - 1) / F.lit(2.0))
