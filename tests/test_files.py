import gzip
import io
import json
import tarfile

import pytest

from cohortloom.operators import qc
from cohortloom.plans.cache import ResultCache
from cohortloom.sources import readers as R
from cohortloom.sources import writers as W


def test_reports_and_files(spark, tmp_path):
    from cohortloom.operators import metadata as M

    row = {"run_accession": "SRR1", "study_accession": "PRJ1", "secondary_study_accession": "SRP1", "library_layout": "PAIRED", "fastq_ftp": "a/x_1.fq.gz;a/x_2.fq.gz", "fastq_md5": "m1;m2", "fastq_bytes": "10;x", "library_strategy": "RNA-Seq"}
    (tmp_path / "r.json").write_text(json.dumps([row, {**row, "run_accession": "SRR2", "secondary_study_accession": "", "fastq_ftp": ""}]))
    reports = R.read_reports(spark, str(tmp_path / "r.json"))
    runs = {r.run_accession: r for r in M.report_runs(reports, "p").collect()}
    assert runs["SRR1"].study_accession == "SRP1" and runs["SRR1"].source_study_accession == "PRJ1" and runs["SRR2"].study_accession == "PRJ1"
    assert runs["SRR1"].metadata["ena_library_strategy"] == "RNA-Seq"
    files = [(r.kind, r.md5, r.bytes) for r in M.remote_files(reports, "run_accession").orderBy("file_no").collect()]
    assert files == [("FASTQ_R1", "m1", 10), ("FASTQ_R2", "m2", None)]


def test_overrides(spark, tmp_path):
    (tmp_path / "o.csv").write_text("run_accession,condition,batch\nSRR1,a,\nSRR2, ,2\n")
    rows = R.read_overrides(spark, str(tmp_path / "o.csv"), "override").orderBy("ord").collect()
    assert [(r.run_accession, r.override_values) for r in rows] == [("SRR1", {"condition": "a"}), ("SRR2", {"batch": "2"})]
    (tmp_path / "bad.tsv").write_text("x\ty\n1\t2\n")
    with pytest.raises(ValueError):
        R.read_overrides(spark, str(tmp_path / "bad.tsv"), "override")


def test_matrix_files(spark, tmp_path):
    text = "gene_id\ts1\ts2\nA\t1\t2.5\nB\t-3e2\t4\n"
    with gzip.open(tmp_path / "m.tsv.gz", "wt") as f:
        f.write(text)
    rows, samples = R.read_matrix(spark, str(tmp_path / "m.tsv.gz"))
    assert samples == ["s1", "s2"] and {r.gene_id: r["values"] for r in rows.collect()} == {"A": [1.0, 2.5], "B": [-300.0, 4.0]}
    for cell in ("x", "", "1.5d"):
        (tmp_path / "bad.tsv").write_text(text.replace("2.5", cell))
        with pytest.raises(Exception, match="no number"):
            R.read_matrix(spark, str(tmp_path / "bad.tsv"))[0].collect()
    with tarfile.open(tmp_path / "a.tar.gz", "w:gz") as t:
        info = tarfile.TarInfo("m.tsv")
        info.size = len(text)
        t.addfile(info, io.BytesIO(text.encode()))
    long = R.read_matrix_archive(spark, str(tmp_path / "a.tar.gz"))
    assert sorted((r.gene_id, r.sample_id, r.value) for r in long.collect()) == [("A", "s1", 1.0), ("A", "s2", 2.5), ("B", "s1", -300.0), ("B", "s2", 4.0)]
    W.write_matrix(long.drop("path"), str(tmp_path / "out"))
    back, names = R.read_matrix(spark, str(tmp_path / "out"))
    assert names == ["s1", "s2"] and back.count() == 2
    with pytest.raises(ValueError):
        W.write_matrix(long.drop("path").where("not (gene_id = 'A' and sample_id = 's1')"), str(tmp_path / "no"))


def test_annotation_files(spark, tmp_path):
    attrs = 'gene_id "G1.4"; transcript_id "T1.2"; gene_name "tr"; gene_biotype "x";'
    lines = ["#!head", "1\ts\ttranscript\t1\t2\t.\t+\t.\t" + attrs, '1\ts\tgene\t1\t2\t.\t+\t.\tgene_id "G1.4"; gene_name "ge"; gene_type "lnc";', "1\ts\texon\t1\t2\t.\t+\t.\tother;", "short\tline"]
    (tmp_path / "a.gtf").write_text("\n".join(lines))
    from cohortloom.operators.annotate import gene_annotation, pick_listing, tx2gene

    records = R.read_gtf(spark, str(tmp_path / "a.gtf"))
    assert [tuple(r) for r in gene_annotation(records).collect()] == [("G1", "ge", "lnc")]
    assert [tuple(r) for r in tx2gene(records).collect()] == [("T1", "G1")]
    W.write_reference(records, str(tmp_path / "ref"))
    assert R.read_gene_annotation(spark, str(tmp_path / "ref/gene_annotation.tsv")).first().gene_name == "ge"
    assert R.read_tx2gene(spark, str(tmp_path / "ref/tx2gene.tsv")).first().gene_id == "G1"
    (tmp_path / "l.html").write_text('<a href="g.v44.basic.annotation.gtf.gz"> <a href="g.v44.annotation.gtf.gz"> <a href="g.v43.annotation.gtf.gz">')
    from pyspark.sql import functions as F

    names = R.read_listing(spark, str(tmp_path / "l.html")).groupBy().agg(F.collect_list("name").alias("n"))
    assert names.select(pick_listing(F.col("n"), "annotation", ".gtf.gz")).first()[0] == "g.v44.annotation.gtf.gz"
    (tmp_path / "s.gmt").write_text("P1\tdesc\tA\tB \t\nP2\td\n")
    assert sorted(tuple(r) for r in R.read_gmt(spark, str(tmp_path / "s.gmt")).collect()) == [("P1", "desc", "A"), ("P1", "desc", "B")]
    (tmp_path / "g.txt").write_text(" A \n\nB\nA\n")
    assert sorted(r.gene_id for r in R.read_gene_list(spark, str(tmp_path / "g.txt")).collect()) == ["A", "B"]
    (tmp_path / "sheet.tsv").write_text("run_accession\tcondition\nR1\ta\nR1\tb\n")
    assert R.read_samplesheet(spark, str(tmp_path / "sheet.tsv")).first().condition == "b"
    (tmp_path / "R9").mkdir()
    (tmp_path / "R9/abundance.tsv").write_text("target_id\tlength\teff_length\test_counts\ttpm\nT1\t9\t8.5\t3\t1.5\n")
    assert tuple(R.read_abundance(spark, str(tmp_path / "R9/abundance.tsv")).first()) == ("T1", "R9", 3.0, 1.5, 8.5)


def test_gate(spark, tmp_path):
    def report(passed, low, complexity, n, short, total=None):
        r = {"filtering_result": {"passed_filter_reads": passed, "low_quality_reads": low, "low_complexity_reads": complexity, "too_many_N_reads": n, "too_short_reads": short}}
        return json.dumps(r | ({"summary": {"before_filtering": {"total_reads": total}}} if total else {}))

    for name, text in {"a": report(92, 3, 2, 1, 2, 100), "b": report(7, 2, 1, 0, 0, 10), "c": "{broken"}.items():
        (tmp_path / f"{name}.json").write_text(text)
    rates = qc.gate_rates(qc.qc_record(R.read_qc_reports(spark, str(tmp_path))))
    got = {r.path[-6]: r for r in qc.apply_gate(rates).collect()}
    assert (got["a"].passed, got["a"].failed, got["a"].gate_passed) == (92, 8, True)
    assert got["c"].total == 0 and got["c"].gate_reason == "pass_rate 0.0000 < 0.6000" and got["c"].mode == "unknown"
    strict = {r.path[-6]: r for r in qc.apply_gate(rates, qc.Gate(min_pass_rate=0.8, max_low_quality_rate=0.1)).collect()}
    assert strict["b"].gate_reason == "pass_rate 0.7000 < 0.8000; low_quality_rate 0.2000 > 0.1000"


def test_checksums_manifest_and_cache(spark, tmp_path):
    (tmp_path / "f.bin").write_bytes(b"abc")
    found = R.read_checksums(spark, str(tmp_path / "f.bin"))
    path = found.first().path
    check = lambda size, md5: R.verify_files(found, spark.createDataFrame([(path, size, md5)], "path string, bytes long, md5 string")).first()
    assert check(3, "900150983CD24FB0D6963F7D28E17F72").verified and not check(4, None).verified and check(None, None).provenance.startswith("sha256:")
    m = W.write_manifest(str(tmp_path / "m.json"), "corr", {"k": 1}, {"matrix": "x"}, ["b", "a"])
    assert json.loads((tmp_path / "m.json").read_text()) == m and m["outputs"] == ["a", "b"]
    cache, calls = ResultCache(spark, str(tmp_path / "cache")), []
    make = lambda: (calls.append(1), spark.range(3))[1]
    for parameters in ({"k": 1}, {"k": 1}, {"k": 2}):
        assert cache.get("corr", parameters, {"matrix": "x"}, make).count() == 3
    assert (len(calls), cache.hits, cache.misses) == (2, 1, 2)


def test_samplesheet_and_column_map(spark, tmp_path):
    runs = spark.createDataFrame([("p", "S", "R2", "PAIRED", "x"), ("p", "S", "R1", "SINGLE", "x")], "project_id string, study_accession string, run_accession string, library_layout string, state string")
    md = spark.createDataFrame([("R1", {"z": "1", "a": "2", "condition": "c1"}), ("R2", {"a": "3", "lane": "L4", "center": "C"})], "run_accession string, metadata map<string,string>")
    cmap = spark.createDataFrame([("lane", "batch"), ("a", "condition"), ("q", None)], "source_column string, canonical_field string")
    art = spark.createDataFrame([("R1", "FASTQ_SINGLE", "f/1"), ("R2", "FASTQ_R1", "f/2b"), ("R2", "FASTQ_R1", "f/2a"), ("R2", "FASTQ_R2", "f/2z"), (None, "FASTQ_R1", "f/0")], "run_accession string, kind string, path string")
    header = W.write_samplesheet(runs, md, cmap, art, str(tmp_path / "s"))
    assert header == [*W.SHEET_COLUMNS, "a", "center", "lane", "z"]
    rows = [r.asDict() for r in R.read_samplesheet(spark, str(tmp_path / "s")).collect()]
    got = {r["run_accession"]: (r["read1_path"], r["read2_path"], r["condition"], r["batch"], r["a"], r["z"]) for r in rows}
    assert got == {"R1": ("f/1", None, "c1", None, "2", "1"), "R2": ("f/2a", "f/2z", "3", "L4", "3", None)}
    assert W.write_samplesheet_schema(str(tmp_path / "s.json"))["stable_columns"][8:] == ["read1_path", "read2_path", "condition", "batch"]
    (tmp_path / "c.tsv").write_text("source_column\tcanonical_field\na\tcondition\nb\t\n")
    assert [tuple(r) for r in R.read_column_map(spark, str(tmp_path / "c.tsv")).collect()] == [("a", "condition")]


def test_result_tables(spark, tmp_path):
    notes = spark.createDataFrame([("g1", "ABC", "coding"), ("g2.4", "DEF", None)], "gene_id string, gene_name string, gene_biotype string")
    edges = spark.createDataFrame([("g1", "g2", 0.5), ("g2", "g3", -0.25)], "gene_a string, gene_b string, r double")
    W.write_edges(edges, str(tmp_path / "edges_topk.tsv"), notes)
    assert tuple(R._tsv(spark, str(tmp_path / "edges_topk.tsv")).columns) == W.EDGE_COLUMNS
    rows = {tuple(r) for r in R._tsv(spark, str(tmp_path / "edges_topk_annotated.tsv")).collect()}
    assert rows == {("g1", "ABC", "coding", "g2", "DEF", None, "0.5"), ("g2", "DEF", None, "g3", None, None, "-0.25")}
    square = spark.createDataFrame([(a, b, 1.0 if a == b else 0.5) for a in "xy" for b in "xy"], "gene_a string, gene_b string, r double")
    W.write_dense_correlation(square, str(tmp_path / "corr_dense.tsv"))
    assert [tuple(r) for r in R._tsv(spark, str(tmp_path / "corr_dense.tsv")).orderBy("gene_id").collect()] == [("x", "1.0", "0.5"), ("y", "0.5", "1.0")]
    ranked = spark.createDataFrame([("M0001", 2, "g1", 1, 1, 0.5), ("M0001", 2, "g2", 2, 2, 0.25)], "module_id string, module_size long, gene string, ord long, rank_in_module long, connectivity double")
    stats = spark.createDataFrame([("M0001", "g1", 0.5, 2.0)], "module_id string, gene_id string, r double, t double")
    tested = spark.createDataFrame([("M0001", "p", 12, 0.5, 1.0, 0.1, 0.2, 0.3, 4)], "module_id string, pathway string, size long, es double, nes double, p_value double, padj double, log2err double, leading_edge_size long")
    W.write_modules(ranked, stats, tested, str(tmp_path))
    for name, columns in (("modules_top_genes.tsv", W.MODULE_COLUMNS), ("module_t_values.tsv", W.TSTAT_COLUMNS), ("module_fgsea.tsv", W.ENRICHMENT_COLUMNS)):
        assert tuple(R._tsv(spark, str(tmp_path / name)).columns) == columns
    long = spark.createDataFrame([("g1", "r1", 1.5), ("g1", "r2", 2.5)], "gene_id string, sample_id string, value double")
    factors = spark.createDataFrame([("r1", 1.0), ("r2", 2.0)], "sample_id string, size_factor double")
    de = spark.createDataFrame([("g1", 2.0)], "gene_id string, base_mean double")
    assert "de_a_vs_b_.tsv" in W.write_expression(long, long, long, factors, {"a vs b?": de}, str(tmp_path / "de"), notes)
    assert R._tsv(spark, str(tmp_path / "de" / "vst_annotated.tsv")).columns == ["gene_id", "gene_symbol", "gene_biotype", "r1", "r2"]
    assert R._tsv(spark, str(tmp_path / "de" / "size_factors.tsv")).columns == ["run_accession", "size_factor"]


def test_folder_size_and_blobs(spark, tmp_path):
    import hashlib

    for text in (b"abc", b"defg"):
        digest = hashlib.sha256(text).hexdigest()
        place = tmp_path / "blobs" / "sha256" / digest[:2] / digest[2:4]
        place.mkdir(parents=True)
        (place / digest).write_bytes(text if text == b"abc" else b"other")
    assert R.folder_size(spark, str(tmp_path)) == 8
    assert sorted(r.verified for r in R.verify_blobs(spark, str(tmp_path)).collect()) == [False, True]


def test_remote_source_is_known(spark):
    from cohortloom.sources.remote import register

    register(spark)
    assert spark.read.format("run_reports").option("url", "http://localhost:9").load().count() == 0


def test_retries(monkeypatch):
    from cohortloom.sources.remote import with_retries

    waits, tries = [], []

    def flaky(fail):
        def fetch():
            tries.append(1)
            if len(tries) <= fail:
                raise OSError("no network")
            return "rows"

        return fetch

    assert with_retries(flaky(4), 5, sleep=waits.append) == "rows" and waits == [1.0, 5.0, 15.0, 30.0]
    tries.clear()
    with pytest.raises(OSError):
        with_retries(flaky(9), 2, sleep=waits.append)
    assert len(tries) == 3


def test_abundance_status(spark):
    sheet = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "run_accession string")
    rows = spark.createDataFrame([("t", "a", 1.0, 2.0, 3.0), ("u", "a", 0.0, 0.0, 1.0), ("t", "b", None, 2.0, 3.0), ("t", "c", 1.0, float("nan"), 3.0), ("t", "x", 1.0, 1.0, 1.0)], "tx string, sample_id string, counts double, tpm double, eff_length double")
    assert {tuple(r) for r in R.abundance_status(sheet, rows).collect()} == {("a", "valid"), ("b", "broken"), ("c", "broken"), ("d", "missing")}
