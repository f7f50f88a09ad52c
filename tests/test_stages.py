import json

import numpy as np
import pytest

from cohortloom.__main__ import main
from cohortloom.plans.stages import Stages, run_expression
from cohortloom.sources import readers as R


def abundance(runs, genes=30, seed=1):
    rng = np.random.default_rng(seed)
    level = rng.uniform(50, 500, genes)
    rows = []
    for j, run in enumerate(runs):
        for g in range(genes):
            n = float(rng.negative_binomial(20, 20 / (20 + level[g] * (6 if g == 0 and j % 2 else 1))))
            rows += [(f"t{g}a.1", run, n * 0.7, n * 0.7, 900.0), (f"t{g}b.2", run, n * 0.3, n * 0.3, 600.0)]
    return rows


def test_expression(spark):
    runs = [f"r{j}" for j in range(8)]
    tx = spark.createDataFrame(abundance([*runs, "stray"]), "tx string, sample_id string, counts double, tpm double, eff_length double")
    genes = spark.createDataFrame([(f"t{g}{v}", f"g{g}") for g in range(30) for v in "ab"], "tx string, gene_id string")
    sheet = spark.createDataFrame([(r, "xy"[j % 2], "b1") for j, r in enumerate(runs)] + [("absent", "x", "b1")], "sample_id string, condition string, batch string")
    out = run_expression(tx, genes, sheet, contrasts=["condition|y|x", "condition|x|y|back"])
    assert out.counts.select("sample_id").distinct().count() == 8 and out.norm.count() == 240 == out.transformed.count()
    got = {(r.contrast, r.gene_id): r for r in out.tests.collect()}
    assert len(got) == 60 and got["condition_y_vs_x", "g0"].log2_fold_change > 1.5 and got["condition_y_vs_x", "g0"].padj < 0.01
    assert got["back", "g0"].stat == pytest.approx(-got["condition_y_vs_x", "g0"].stat)
    for bad in ({"formula": "~ other"}, {"contrasts": ["other|x|y"]}, {"contrasts": ["condition|x"]}, {"contrasts": ["condition|x|z"]}, {"mode": "median"}, {"transform": "log"}):
        with pytest.raises(ValueError):
            run_expression(tx, genes, sheet, **bad)
    with pytest.raises(ValueError, match="at least 2"):
        run_expression(tx, genes, sheet.where("sample_id = 'r1'"))


def test_a_part_is_replaced(spark):
    class Own(Stages):
        def test(self, vectors, sizes, x, contrasts):
            return vectors.select("gene_id")

    tx = spark.createDataFrame(abundance(["r0", "r1", "r2", "r3"], 4), "tx string, sample_id string, counts double, tpm double, eff_length double")
    genes = spark.createDataFrame([(f"t{g}{v}", f"g{g}") for g in range(4) for v in "ab"], "tx string, gene_id string")
    sheet = spark.createDataFrame([(f"r{j}", "xy"[j % 2]) for j in range(4)], "sample_id string, condition string")
    assert run_expression(tx, genes, sheet, "~ condition", ["condition|x|y"], stages=Own()).tests.columns == ["gene_id"]


def test_verbs(spark, tmp_path):
    reports = [{"run_accession": "SRR1", "study_accession": "PRJ1", "library_layout": "PAIRED", "fastq_ftp": "h/a_1.fastq.gz;h/a_2.fastq.gz", "fastq_bytes": "5;6"}]
    (tmp_path / "reports.json").write_text(json.dumps(reports))
    main(["resolve", "--reports", str(tmp_path / "reports.json"), "--project", "P", "--out", str(tmp_path / "o")], spark)
    assert R._tsv(spark, str(tmp_path / "o" / "files.tsv")).count() == 2 and R._tsv(spark, str(tmp_path / "o" / "runs.tsv")).first().project_id == "P"
    (tmp_path / "qc").mkdir()
    (tmp_path / "qc" / "x.json").write_text(json.dumps({"filtering_result": {"passed_filter_reads": 4, "low_quality_reads": 6}}))
    main(["qc", "--reports", str(tmp_path / "qc"), "--out", str(tmp_path / "o")], spark)
    assert R._tsv(spark, str(tmp_path / "o" / "qc.tsv")).first().gate_reason == "pass_rate 0.4000 < 0.6000; low_quality_rate 0.6000 > 0.3000"
    runs = [f"r{j}" for j in range(6)]
    for run in runs:
        (tmp_path / "q" / run).mkdir(parents=True)
        rows = "".join(f"{t}\t{l}\t{n}\t{p}\n" for t, s, n, p, l in abundance(runs) if s == run)
        (tmp_path / "q" / run / "abundance.tsv").write_text("target_id\teff_length\test_counts\ttpm\n" + rows)
    (tmp_path / "t.tsv").write_text("transcript_id\tgene_id\n" + "".join(f"t{g}{v}\tg{g}\n" for g in range(30) for v in "ab"))
    (tmp_path / "s.tsv").write_text("run_accession\tcondition\tbatch\n" + "".join(f"r{j}\t{'xy'[j % 2]}\tb{j // 3}\n" for j in range(6)))
    main(["normalize", "--abundance", str(tmp_path / "q" / "*" / "abundance.tsv"), "--tx2gene", str(tmp_path / "t.tsv"), "--samplesheet", str(tmp_path / "s.tsv"), "--contrast", "condition", "y", "x", "--out", str(tmp_path / "de")], spark)
    assert R._tsv(spark, str(tmp_path / "de" / "de_condition_y_vs_x.tsv")).count() == 30
    main(["corr", "--matrix", str(tmp_path / "de" / "vst.tsv"), "--samplesheet", str(tmp_path / "s.tsv"), "--output", "edges:topk=3", "--out", str(tmp_path / "c")], spark)
    edges = R._tsv(spark, str(tmp_path / "c" / "edges.tsv"))
    assert edges.columns == ["gene_a", "gene_b", "r"] and edges.count() == 90
