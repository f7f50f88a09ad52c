import random
from datetime import datetime as D

import pytest
from pyspark.sql import functions as F

from cohortloom.functions import scalars as S
from cohortloom.operators import metadata as M

RUNS = "project_id string, study_accession string, source_study_accession string, run_accession string, sample_accession string, experiment_accession string, library_layout string, instrument_platform string, instrument_model string, metadata map<string,string>"
OVER = "run_accession string, sample_accession string, override_values map<string,string>, merge_strategy string, ord long"


def runs(spark, rows):
    return spark.createDataFrame([("p", "SRP1", None, r, s, None, "PAIRED", "ILLUMINA", None, m) for r, s, m in rows], RUNS)


def fold(base, steps):
    state = dict(base or {})
    for strategy, values in steps:
        values = {k: v for k, v in values.items() if v and v.strip()}
        old = dict(state)
        for k, v in values.items():
            if strategy == "prefer_remote":
                state.setdefault(k, v)
            elif strategy == "union_with_prefix":
                if k not in old:
                    state.setdefault(k, v)
                elif old[k] != v:
                    state["remote_" + k], state["local_" + k] = old[k], v
            else:
                state[k] = v
    return state


@pytest.mark.parametrize("seed", range(3))
def test_mixed_fold_against_a_plain_one(spark, seed):
    rng = random.Random(seed)
    held = [(f"R{i}", rng.choice(["S1", "S2", None]), {k: rng.choice("xyz") for k in rng.sample("abc", rng.randint(0, 2))}) for i in range(8)]
    steps = [(rng.choice(["r1", " R2 ", "R3", None, "-", ""]), rng.choice(["s1", None, "S3", "NA"]), {k: rng.choice(["x", "y", "z", " ", ""]) for k in rng.sample("abcd", rng.randint(0, 3))}, rng.choice(M.STRATEGIES), i) for i in range(25)]
    got = {r.run_accession: r.metadata for r in M.merge_overrides(runs(spark, held), spark.createDataFrame(steps, OVER)).collect()}
    norm = lambda x: None if x is None or x.strip().upper() in ("", "-", "NA") else x.strip().upper()
    for run, sample, base in held:
        mine = [(m, v) for r, s, v, m, _ in steps if norm(r) == run or (sample and norm(s) == sample)]
        assert got[run] == fold(base, mine), run


def test_known_merges():
    assert fold({"condition": "a", "center": "c"}, [("union_with_prefix", {"condition": "b", "batch": "1"})]) == {"condition": "a", "center": "c", "remote_condition": "a", "local_condition": "b", "batch": "1"}
    assert fold({"k": "R"}, [("prefer_remote", {"k": "L", "n": "X"})]) == {"k": "R", "n": "X"}


def test_heavy_sample_and_empty_overrides(spark):
    held = runs(spark, [(f"R{i}", "S1", None) for i in range(60)])
    steps = spark.createDataFrame([(None, "S1", {"a": "1"}, "override", 1)], OVER)
    assert M.matched_overrides(held, steps, shard_rows=7).count() == 60
    assert all(r.metadata == {} for r in M.merge_overrides(held, steps.limit(0)).collect())


def test_predicates(spark):
    df = runs(spark, [("R1", "S1", {"Tissue": " Liver "}), ("R2", "S2", {"tissue": "skin"}), ("R3", None, None)])
    pick = lambda **kw: sorted(r.run_accession for r in M.select_runs(df, metadata=F.col("metadata"), **kw).collect())
    assert pick(include=["TISSUE = liver"]) == ["R1"]
    assert pick(include=["tissue!=liver"]) == ["R2"]  # a missing field never matches
    assert pick(exclude=["tissue=liver"]) == ["R2", "R3"]
    assert pick(include=["library_layout=paired"], exclude=["sample_accession=s2"]) == ["R1", "R3"]
    some = spark.createDataFrame([("s1 ",), (None,)], "sample_accession string")
    assert pick(include_samples=some) == ["R1"] and pick(exclude_samples=some) == ["R2", "R3"]
    for bad in ("tissue", "=x", "x="):
        with pytest.raises(ValueError):
            M.Predicate(bad)


def test_scalars(spark):
    def one(column, value, kind="string"):
        return spark.createDataFrame([(value,)], f"x {kind}").select(column(F.col("x"))).first()[0]

    assert one(S.parse_size_bytes, "1.5 GiB") == 1610612736 and one(S.parse_size_bytes, "2k") == 2000 and one(S.parse_size_bytes, "x") is None
    assert one(S.strip_version, "X.5_PAR_Y") == "X" and one(S.strip_trailing_version, "X.5_PAR_Y") == "X.5_PAR_Y"
    assert one(S.format_duration, 3725.9, "double") == "01:02:05" and one(S.format_duration, None, "double") is None and one(S.format_duration, 360000.0, "double") == "100:00:00"
    assert one(S.accession_kind, "samn1") == "SAMPLE" and one(S.accession_kind, "X1") is None
    assert one(S.split_list, "a; ;b ") == ["a", "b"]
    assert one(S.parse_instant, "2024-01-02T03:04:05+01:00") == D(2024, 1, 2, 2, 4, 5) and one(S.parse_instant, "yesterday") is None
    assert one(S.release_tag, "gencode.vM33.annotation.gtf.gz") == "vM33" and one(lambda c: S.normalize_release(c, "mouse"), "m33") == "M33"
    assert one(lambda c: S.ratio(c, F.lit(0)), 5, "int") == 0.0
    assert one(S.normalize_url, "ftp.a/b") == "https://ftp.a/b" and one(S.r_boolean, "maybe") is None


def test_samplesheet_prefers_the_direct_field(spark):
    cm = spark.createDataFrame([("grp", "condition"), ("lane", "batch"), ("z", None)], "source_column string, canonical_field string")
    md = spark.createDataFrame([("R1", {"condition": "c", "grp": "g", "lane": "7"}), ("R2", {"grp": "g"})], "run_accession string, metadata map<string,string>")
    rows = {r.run_accession: (r.condition, r.batch) for r in M.samplesheet(runs(spark, [("R1", "S", None), ("R2", "S", None), ("R3", "S", None), ("r3 ", "S", None)]), md, cm).collect()}
    assert rows == {"R1": ("c", "7"), "R2": ("g", None), "R3": (None, None)}


def test_samplesheet_refuses_a_longer_map(spark, monkeypatch):
    cm = spark.range(10_001).select(F.concat(F.lit("c"), F.col("id").cast("string")).alias("source_column"), F.lit("batch").alias("canonical_field"))
    md = spark.createDataFrame([("R1", {"c1": "b"})], "run_accession string, metadata map<string,string>")
    with pytest.raises(ValueError, match="more than 10000"):
        M.samplesheet(runs(spark, [("R1", "S", None)]), md, cm)
    monkeypatch.setattr(M, "MAP_ROWS", 3)
    assert M.samplesheet(runs(spark, [("R1", "S", None)]), md, cm.limit(3)).first().batch == "b"
