"""Reference annotation: parsing it and joining it to gene tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.functions.scalars import is_versioned, strip_version

#: Annotation tables up to this many bytes are broadcast, after they are measured; a genome's genes take less.
ANNOTATION_BYTES = 64 << 20


def gtf_records(lines: DataFrame, line: str = "value") -> DataFrame:
    """Feature lines of a GTF: ``line_no`` (if given), ``feature`` and the attributes; lines without a gene id are left out."""
    parts = F.split(F.col(line), "\t")
    attribute = lambda k: F.nullif(F.regexp_extract(parts[8], rf'(?:^|[ ;]){k} "([^"]*)"', 1), F.lit(""))
    kept = lines.where(~F.col(line).startswith("#") & (F.size(parts) >= 9))
    carried = [c for c in lines.columns if c != line]
    return kept.select(
        *carried, parts[2].alias("feature"), strip_version(attribute("gene_id")).alias("gene_id"), strip_version(attribute("transcript_id")).alias("transcript_id"),
        attribute("gene_name").alias("gene_name"), F.coalesce(attribute("gene_biotype"), attribute("gene_type")).alias("gene_biotype"),
    ).where(F.col("gene_id").isNotNull())


def gene_annotation(records: DataFrame, order: str = "line_no") -> DataFrame:
    """``gene_id, gene_name, gene_biotype``: from the gene's own line if there is one, else from its first line."""
    rank = F.struct((F.col("feature") != "gene").cast("int"), F.col(order))
    pick = F.min_by(F.struct(F.coalesce("gene_name", F.lit("")).alias("gene_name"), F.coalesce("gene_biotype", F.lit("")).alias("gene_biotype")), rank)
    return records.groupBy("gene_id").agg(pick.alias("p")).select("gene_id", "p.*")


def tx2gene(records: DataFrame) -> DataFrame:
    return records.where(F.col("transcript_id").isNotNull()).select("transcript_id", "gene_id").distinct()


def _ready(annotation: DataFrame, key: str) -> DataFrame:
    """One row per id; broadcast only if it is small."""
    once = annotation.groupBy(strip_version(key).alias("__id")).agg(F.min_by(F.struct(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in annotation.columns if c != key]), F.col(key)).alias("__a"))
    size = once.agg(F.sum(F.octet_length(F.to_json("__a")) + F.octet_length(F.col("__id").cast("string")))).first()[0]
    return F.broadcast(once) if (size or 0) <= ANNOTATION_BYTES else once


def annotate(table: DataFrame, annotation: DataFrame, gene: str = "gene_id", key: str = "gene_id", prefix: str = "") -> DataFrame:
    """``table`` with the annotation's columns; genes without one keep their row with empty texts."""
    names = [c for c in annotation.columns if c != key]
    joined = table.withColumn("__id", strip_version(gene)).join(_ready(annotation, key), "__id", "left")
    return joined.select(*table.columns, *[F.coalesce(F.col(f"__a.{c}"), F.lit("")).alias(f"{prefix}{c}") for c in names])


def annotate_edges(edges: DataFrame, annotation: DataFrame, key: str = "gene_id") -> DataFrame:
    """Edges with the annotation of both ends."""
    return annotate(annotate(edges, annotation, "gene_a", key, "a_"), annotation, "gene_b", key, "b_")


def pick_listing(names: Column, contains: str, suffix: str) -> Column:
    """The last name of a listing that fits and is no basic, patch or primary assembly file."""
    fits = F.filter(names, lambda n: n.contains(contains) & n.endswith(suffix) & ~n.contains(".basic.") & ~n.contains("primary_assembly") & ~n.contains("patch"))
    return F.array_max(fits)


def listing_names(html: Column) -> Column:
    """The targets of all links of a page."""
    return F.regexp_extract_all(html, F.lit('href="([^"]+)"'), F.lit(1))


def reference_id(gtf: Column, transcripts: Column, organism: Column, release: Column) -> Column:
    """Identity of a reference: by content for a custom one, else by organism and release."""
    short = lambda c: F.substr(F.sha2(c, 256), F.lit(1), F.lit(12))
    return F.when(release.isNull(), F.format_string("custom_%s_%s", short(transcripts), short(gtf))).otherwise(F.format_string("%s_gencode_%s_txall_v2", organism, release))


#: Rows from the top of a table by which it is told whether its ids still have versions.
PROBED_ROWS = 32


def needs_rebuild(table: DataFrame, column: str, order: str) -> DataFrame:
    """One row ``needs_rebuild``: whether the first id among the first rows, empty ones aside, has a version; a table without the column has to be made anew."""
    if column not in table.columns:
        return table.sparkSession.createDataFrame([(True,)], "needs_rebuild boolean")
    top = table.orderBy(order).limit(PROBED_ROWS).where(F.coalesce(column, F.lit("")) != "")
    return top.agg(F.coalesce(F.min_by(is_versioned(column), order), F.lit(False)).alias("needs_rebuild"))
