"""Readers of the files that a cohort comes in."""

from __future__ import annotations

import io
import tarfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortloom.functions.scalars import basename, strip_version
from cohortloom.operators.annotate import gtf_records
from cohortloom.operators.matrix import sample_order, to_vectors

_NUMBER = r"^\s*[+-]?(?:[0-9]+(?:\.[0-9]*)?|\.[0-9]+)(?:[eE][+-]?[0-9]+)?\s*$"

# The fields of a run report.
REPORT_COLUMNS = (
    "run_accession", "study_accession", "secondary_study_accession", "experiment_accession", "sample_accession", "secondary_sample_accession",
    "library_layout", "instrument_platform", "instrument_model", "fastq_ftp", "fastq_md5", "fastq_bytes", "submitted_ftp", "submitted_md5",
    "submitted_bytes", "library_source", "library_strategy",
)


def _tsv(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    """A delimited text file with a header, all columns as text, white space kept."""
    return spark.read.csv(path, sep=sep, header=True, inferSchema=False, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, nullValue="", emptyValue="")


def read_reports(spark: SparkSession, path: str) -> DataFrame:
    """File reports: a JSON array of objects, all fields as text; fields that a file lacks are null."""
    schema = ", ".join(f"{c} STRING" for c in REPORT_COLUMNS)
    return spark.read.json(path, schema=schema, multiLine=True, primitivesAsString=True)


def read_overrides(spark: SparkSession, path: str, strategy: str, first_ord: int = 0) -> DataFrame:
    """Override rows of one table, comma or tab separated: keys, values by column, strategy and order.

    One of the columns ``run_accession`` and ``sample_accession`` must be there; blank cells are no values.
    """
    head = spark.read.text(path).limit(1).first()
    line = head[0] if head else ""
    df = _tsv(spark, path, "\t" if line.count("\t") >= line.count(",") else ",")
    keys = [c for c in df.columns if c in ("run_accession", "sample_accession")]
    if not keys:
        raise ValueError("an override table needs run_accession or sample_accession")
    values = [c for c in df.columns if c not in keys]
    pairs = F.map_from_arrays(F.array(*[F.lit(c) for c in values]), F.array(*[F.trim(c) for c in values])) if values else F.create_map().cast("map<string,string>")
    key = lambda c: F.col(c) if c in keys else F.lit(None).cast("string")
    return df.select(
        key("run_accession").alias("run_accession"), key("sample_accession").alias("sample_accession"),
        F.map_filter(pairs, lambda _, v: F.coalesce(v, F.lit("")) != "").alias("override_values"), F.lit(strategy).alias("merge_strategy"),
        (F.monotonically_increasing_id() + first_ord).alias("ord"),
    )


def read_matrix(spark: SparkSession, path: str) -> tuple[DataFrame, list[str]]:
    """A matrix file (also gzipped): rows ``gene_id, values`` and the sample names of its header.

    The first column has the row ids. A cell that is no number ends the read with an error.
    """
    df = _tsv(spark, path)
    gene, samples = df.columns[0], df.columns[1:]
    cell = lambda c: F.when(F.col(f"`{c}`").rlike(_NUMBER), F.col(f"`{c}`").try_cast("double")).otherwise(F.raise_error(F.concat(F.lit("no number in column " + c + ": "), F.coalesce(F.col(f"`{c}`"), F.lit("")))).cast("double"))
    return df.select(F.col(f"`{gene}`").alias("gene_id"), F.array(*[cell(c) for c in samples]).alias("values")), samples


#: Rows of an archived matrix that a task holds at a time.
ARCHIVE_ROWS = 4_096


def read_matrix_archive(spark: SparkSession, path: str) -> DataFrame:
    """The first table in each ``.tar.gz``: long rows ``path, gene_id, sample_id, value``.

    An archive is one task's, which reads its table in pieces and never holds it unpacked.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for name, content in zip(frame["path"], frame["content"], strict=True):
                with tarfile.open(fileobj=io.BytesIO(content), mode="r:gz") as archive:
                    for member in archive:
                        if member.isfile() and member.name.endswith((".tsv", ".txt")):
                            for wide in pd.read_csv(archive.extractfile(member), sep="\t", dtype={0: str}, chunksize=ARCHIVE_ROWS):
                                wide = wide.rename(columns={wide.columns[0]: "gene_id"})
                                yield wide.melt("gene_id", var_name="sample_id").assign(path=name)[["path", "gene_id", "sample_id", "value"]].astype({"gene_id": str, "value": float})
                            break

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "path string, gene_id string, sample_id string, value double")


def read_samplesheet(spark: SparkSession, path: str, key: str = "run_accession") -> DataFrame:
    """A samplesheet; of several rows of a run the last one counts."""
    df = _tsv(spark, path).withColumn("__at", F.monotonically_increasing_id())
    last = Window.partitionBy(key).orderBy(F.col("__at").desc())
    return df.withColumn("__n", F.row_number().over(last)).where("__n = 1").drop("__n", "__at")


def read_gtf(spark: SparkSession, path: str) -> DataFrame:
    """Feature records of an annotation file in its order."""
    return gtf_records(spark.read.text(path).withColumn("line_no", F.monotonically_increasing_id()))


def read_gene_annotation(spark: SparkSession, path: str) -> DataFrame:
    """``gene_id, gene_name, gene_biotype``; the first row of each stable id counts."""
    df = _tsv(spark, path).withColumns({"gene_id": strip_version("gene_id"), "__at": F.monotonically_increasing_id()})
    names = [c for c in df.columns if c not in ("gene_id", "__at")]
    return df.groupBy("gene_id").agg(F.min_by(F.struct(*names), "__at").alias("p")).select("gene_id", "p.*")


def read_gmt(spark: SparkSession, path: str) -> DataFrame:
    """``pathway, description, gene_id`` of a gene-set file; blank genes are left out."""
    parts = F.split("value", "\t")
    rows = spark.read.text(path).where(F.size(parts) >= 3)
    genes = F.transform(F.slice(parts, 3, F.size(parts) - 2), lambda g: F.trim(g))
    return rows.select(parts[0].alias("pathway"), parts[1].alias("description"), F.explode(genes).alias("gene_id")).where("gene_id <> ''")


def read_gene_list(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.trim("value").alias("gene_id")).where("gene_id <> ''").distinct()


def read_qc_reports(spark: SparkSession, path: str) -> DataFrame:
    """Preprocessing reports, one JSON file per run, as ``path, report`` for the gate."""
    from cohortloom.operators.qc import parse_report

    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), parse_report(F.col("value")).alias("report"))


def read_abundance(spark: SparkSession, path: str) -> DataFrame:
    """Quantification tables ``<run>/abundance.tsv``: ``tx, sample_id, counts, tpm, eff_length``; the folder names the run."""
    df = _tsv(spark, path)
    run = F.element_at(F.split(F.input_file_name(), "/"), -2)
    return df.select(F.col("target_id").alias("tx"), run.alias("sample_id"), F.col("est_counts").try_cast("double").alias("counts"), F.col("tpm").try_cast("double").alias("tpm"), F.col("eff_length").try_cast("double").alias("eff_length"))


def abundance_status(sheet: DataFrame, abundance: DataFrame, key: str = "run_accession") -> DataFrame:
    """The runs of a samplesheet with ``status``: ``valid``, ``missing`` where a run has no table or an empty one, ``broken`` where a figure is none or below 0."""
    bad = [F.col(c).isNull() | F.isnan(c) | (F.col(c) < 0) for c in ("counts", "tpm", "eff_length")]
    seen = abundance.groupBy(F.col("sample_id").alias(key)).agg(F.bool_or(bad[0] | bad[1] | bad[2] | F.col("tx").isNull()).alias("__broken"))
    joined = sheet.select(key).distinct().join(seen, key, "left")
    return joined.select(key, F.when(F.col("__broken").isNull(), "missing").when(F.col("__broken"), "broken").otherwise("valid").alias("status"))


def read_tx2gene(spark: SparkSession, path: str) -> DataFrame:
    """``tx, gene_id`` from the first two columns; the first gene of a transcript counts."""
    df = _tsv(spark, path)
    a, b = df.columns[:2]
    rows = df.select(strip_version(F.col(f"`{a}`")).alias("tx"), strip_version(F.col(f"`{b}`")).alias("gene_id"), F.monotonically_increasing_id().alias("__at"))
    return rows.groupBy("tx").agg(F.min_by("gene_id", "__at").alias("gene_id"))


def read_column_map(spark: SparkSession, path: str) -> DataFrame:
    """``source_column, canonical_field`` of the pairs that are filled in."""
    df = _tsv(spark, path).select(F.trim("source_column").alias("source_column"), F.trim("canonical_field").alias("canonical_field"))
    return df.where("source_column <> '' AND canonical_field <> ''")


def read_listing(spark: SparkSession, path: str) -> DataFrame:
    """The link targets of listing pages: ``page, name``."""
    links = F.explode(F.regexp_extract_all("value", F.lit('href="([^"]+)"'), F.lit(1)))
    return spark.read.text(path, wholetext=True).select(basename(F.input_file_name()).alias("page"), links.alias("name"))


def read_checksums(spark: SparkSession, path: str) -> DataFrame:
    """Size and checksums of files, to verify them against what was announced."""
    files = spark.read.format("binaryFile").load(path)
    return files.select("path", F.col("length").alias("bytes"), F.md5("content").alias("md5"), F.sha2("content", 256).alias("sha256"))


def verify_files(found: DataFrame, announced: DataFrame) -> DataFrame:
    """``path, verified, provenance``: the size must fit if it was announced, then the md5; without an md5 the sha256 is kept."""
    named = announced.select("path", F.col("bytes").alias("want_bytes"), F.lower("md5").alias("want_md5"))
    joined = found.join(named, "path", "left")
    sized = F.col("want_bytes").isNull() | (F.col("bytes") == F.col("want_bytes"))
    summed = F.col("want_md5").isNull() | (F.col("md5") == F.col("want_md5"))
    return joined.select("path", (sized & summed).alias("verified"), F.when(F.col("want_md5").isNotNull(), F.concat(F.lit("md5:"), "md5")).otherwise(F.concat(F.lit("sha256:"), "sha256")).alias("provenance"))


def vectors_of_long(long: DataFrame) -> tuple[DataFrame, list]:
    samples = sample_order(long)
    return to_vectors(long, samples), samples


def folder_size(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a folder; their contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]


def verify_blobs(spark: SparkSession, root: str) -> DataFrame:
    """``path, digest, verified`` of every blob of a content-addressed store: whether its content has the digest that is its name."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{root}/blobs/sha256")
    digest = basename(F.col("path"))
    return files.select("path", digest.alias("digest"), (F.sha2("content", 256) == digest).alias("verified"))
