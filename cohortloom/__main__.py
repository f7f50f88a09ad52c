"""``python -m cohortloom VERB``: the stages on files.

resolve: report JSON to runs and files. qc: preprocessing reports to verdicts. normalize: abundance
tables to count tables and tests. corr: a matrix to edges, with gene sets also modules.
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import functions as F

from cohortloom.operators import matrix, metadata
from cohortloom.plans.pipeline import CorrelationConfig, run_correlation
from cohortloom.plans.stages import Stages, run_expression
from cohortloom.session import build_session
from cohortloom.sources import readers, writers


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="cohortloom", description=__doc__)
    verbs = p.add_subparsers(dest="verb", required=True)
    add = lambda name: verbs.add_parser(name)
    v = add("resolve")
    v.add_argument("--reports", required=True)
    v.add_argument("--project", required=True)
    v.add_argument("--out", required=True)
    v = add("qc")
    v.add_argument("--reports", required=True)
    v.add_argument("--out", required=True)
    v = add("normalize")
    for name in ("abundance", "tx2gene", "samplesheet", "out"):
        v.add_argument(f"--{name}", required=True)
    v.add_argument("--design", default="~ batch + condition")
    v.add_argument("--contrast", nargs=3, action="append", default=[], metavar=("FACTOR", "A", "B"))
    v.add_argument("--counts-from-abundance", default="lengthScaledTPM")
    v.add_argument("--transform", default="vst")
    v = add("corr")
    for name in ("matrix", "samplesheet", "out"):
        v.add_argument(f"--{name}", required=True)
    v.add_argument("--gmt")
    for name, default in (("geneset", "topvar:5000"), ("formula", "~ batch + condition"), ("adjust", "residualize"), ("method", "pearson"), ("output", "edges:topk=50")):
        v.add_argument(f"--{name}", default=default)
    for name, default in (("module_top", 500), ("module_min_size", 25), ("permutations", 1000), ("seed", 42)):
        v.add_argument(f"--{name.replace('_', '-')}", type=int, default=default)
    return p


def main(argv: list[str] | None = None, spark=None) -> None:
    a = parser().parse_args(argv)
    spark = spark or build_session("cohortloom")
    at = lambda name: os.path.join(a.out, name)
    if a.verb == "resolve":
        reports = readers.read_reports(spark, a.reports)
        writers.write_table(Stages().resolve(reports, a.project).withColumn("metadata", F.to_json("metadata")), at("runs.tsv"), ["run_accession"])
        writers.write_table(metadata.remote_files(reports, "run_accession"), at("files.tsv"), ["run_accession", "file_no"])
    elif a.verb == "qc":
        writers.write_table(Stages().judge(readers.read_qc_reports(spark, a.reports)), at("qc.tsv"), ["path"])
    elif a.verb == "normalize":
        sheet = readers.read_samplesheet(spark, a.samplesheet).withColumnRenamed("run_accession", "sample_id")
        result = run_expression(
            readers.read_abundance(spark, a.abundance), readers.read_tx2gene(spark, a.tx2gene), sheet, a.design, ["|".join(c) for c in a.contrast], a.counts_from_abundance, a.transform,
        )
        names = [] if result.tests is None else [f"{f}_{x}_vs_{y}" for f, x, y in a.contrast]
        tests = {n: result.tests.where(F.col("contrast") == n).drop("contrast") for n in names}
        writers.write_expression(result.counts, result.norm, result.transformed, result.factors, tests, a.out)
    else:
        vectors, samples = readers.read_matrix(spark, a.matrix)
        sheet = readers.read_samplesheet(spark, a.samplesheet).withColumnRenamed("run_accession", "sample_id")
        config = CorrelationConfig(a.geneset, a.formula, a.adjust, a.method, a.output, a.module_top, a.module_min_size, a.permutations, a.seed)
        sets = readers.read_gmt(spark, a.gmt) if a.gmt else None
        result = run_correlation(matrix.to_long(vectors, samples), sheet, config, gene_sets=sets)
        writers.write_edges(result.edges, at("edges.tsv"))
        if sets is not None:
            writers.write_modules(result.modules, result.tstats, result.enrichment, a.out)


if __name__ == "__main__":
    main()
