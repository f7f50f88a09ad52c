import math
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortloom.operators import correlate as C
from cohortloom.operators import design, enrich, matrix, modules, normalize


def vectors(spark, x):
    return spark.createDataFrame([(f"g{i:03d}", i + 1, [float(v) for v in row]) for i, row in enumerate(x)], "gene_id string, ord long, values array<double>")


def table(df):
    return {(r.gene_a, r.gene_b): r.r for r in df.collect()}


@pytest.fixture(scope="module")
def x():
    return np.round(np.random.default_rng(3).normal(size=(70, 12)), 1)


@pytest.mark.parametrize("method", C.METHODS)
def test_symmetric_bounded_and_independent_of_blocks(spark, x, method, monkeypatch):
    x = x[:40]
    whole = table(C.pairwise(vectors(spark, x), method, 12, diagonal=True))
    assert len(whole) == 1600 and all(abs(v) <= 1 for v in whole.values())
    assert all(abs(whole[a, b] - whole[b, a]) < 1e-9 for a, b in whole)
    monkeypatch.setattr(C, "BLOCK_ROWS", 7)
    assert table(C.pairwise(vectors(spark, x).repartition(5), method, 12, diagonal=True)) == whole


def test_kernels_against_definitions(spark, x):
    got = {m: table(C.pairwise(vectors(spark, x[:8]), m, 12)) for m in ("pearson", "kendall", "bicor")}
    for i in range(8):
        for j in range(i + 1, 8):
            a, b, key = x[i], x[j], (f"g{i:03d}", f"g{j:03d}")
            assert got["pearson"][key] == pytest.approx(np.corrcoef(a, b)[0, 1], abs=1e-8)
            sa, sb = np.sign(a[:, None] - a), np.sign(b[:, None] - b)
            assert got["kendall"][key] == pytest.approx((sa * sb).sum() / math.sqrt((sa**2).sum() * (sb**2).sum()), abs=1e-8)
            w = []
            for v in (a, b):
                m = np.median(v)
                u = (v - m) / (9 * np.median(np.abs(v - m)))
                w.append((v - m) * np.where(abs(u) < 1, (1 - u**2) ** 2, 0))
            assert got["bicor"][key] == pytest.approx((w[0] * w[1]).sum() / math.sqrt((w[0] ** 2).sum() * (w[1] ** 2).sum()), abs=1e-8)


def memory_of(call):
    tracemalloc.start()
    out = call()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return out, peak


@pytest.mark.parametrize("method", ["kendall", "hellcor"])
def test_wide_rows_take_memory_in_proportion(method):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(4, 4000))
    x[1] = np.round(x[1], 1)
    x[2] = np.where(rng.random(4000) < 0.7, 0.0, x[0])
    x[3] = x[0] + 0.1 * x[3]

    def run():
        z = C.prepared(x, method)
        return C._products(z, C._rows_of(z.tobytes(), 4, method), method)

    got, peak = memory_of(run)
    assert got.shape == (4, 4) and np.allclose(got, got.T) and peak < 64e6
    assert len(C.prepared(x, method).tobytes()) <= 8 * x.size


@pytest.mark.parametrize("n", [1, 2, 7, 8, 64, 65])
def test_kendall_of_sorted_rows_is_that_of_the_signs(n):
    rng = np.random.default_rng(n)
    for decimals, gaps in ((9, 0.0), (0, 0.0), (1, 0.2)):
        x = np.round(rng.normal(size=(6, n)), decimals)
        x[rng.random(x.shape) < gaps] = np.nan
        signs = np.nan_to_num(np.sign(x[:, :, None] - x[:, None, :])).reshape(6, -1)
        r = C.dense_ranks(x)
        assert (2 * C.ordered_products(r[:3], r) == signs[:3] @ signs.T).all() and (2 * C.sign_products(r[:3], r) == signs[:3] @ signs.T).all()
        norm = np.outer((signs[:3] ** 2).sum(1), (signs**2).sum(1))
        with np.errstate(invalid="ignore", divide="ignore"):
            assert np.allclose(C.kendall_products(r[:3], r), np.where(norm > 0, (signs[:3] @ signs.T) / np.sqrt(norm), np.nan), equal_nan=True)


@pytest.mark.parametrize("n", [2, 3, 40, 401])
def test_nearest_points_are_those_of_all_distances(n):
    rng = np.random.default_rng(n)
    noise = rng.normal(size=(5, n))
    for x in (noise, np.round(noise), np.where(rng.random(noise.shape) < 0.7, 0.0, noise), noise[0] + 0.01 * noise, np.tile(noise[:, : n // 3 + 1], (1, 3))[:, :n]):
        u = C.ranks(x) / (n + 1.0)
        whole = np.rint(2 * (n + 1) * u).astype(np.int64)
        near = [[C._nearest_distances(a, b) / (2 * (n + 1)) for b in whole] for a in whole]
        assert np.allclose(near, C._all_distances(u, u), rtol=0, atol=1e-11)


def test_constant_rows_have_no_edges(spark, x):
    y = np.vstack([x[:5], np.ones((1, 12))])
    edges = C.pairwise(vectors(spark, y), "pearson", 12, top=3)
    assert not any("g005" in k for k in table(edges)) and edges.count() == 15
    assert sum(math.isnan(v) for v in table(C.pairwise(vectors(spark, y), "pearson", 12, diagonal=True)).values()) == 11


def test_topk_and_specs(spark, x):
    full = table(C.pairwise(vectors(spark, x), "spearman", 12, diagonal=True))
    got = {(r.gene_a, r.gene_b) for r in C.correlate(vectors(spark, x), "Spearman", "edges:topk=4", 12).collect()}
    genes = sorted({a for a, _ in full})
    want = {(a, b) for a in genes for b in sorted((g for g in genes if g != a), key=lambda g: (-abs(full[a, g]), g))[:4]}
    assert got == want
    assert C.parse_output("dense") == {"diagonal": True} and C.parse_output("edges:topk=0") == {"top": 1} and C.parse_output("edges:threshold=0.5") == {"least": 0.5}
    for bad in ("edges", "edges:top=3", "x"):
        with pytest.raises(ValueError):
            C.parse_output(bad)
    with pytest.raises(ValueError):
        C.correlate(vectors(spark, x[:1]), "pearson", "dense", 12)


def test_design(spark, x):
    sheet = {s: {"age": a, "batch": b, "one": "k"} for s, a, b in zip("wxyz", ["30", "40", "50", "60"], ["B1", "B1", "B2", "B3"], strict=True)}
    d, names = design.design_matrix(sheet, list("wxyz"), "~ batch + age:one")
    assert names == ["Intercept", "age", "batch=B2", "batch=B3"] and d[:, 1].tolist() == [30, 40, 50, 60]
    sheet["x"]["age"] = ""
    assert design.design_matrix(sheet, list("wxyz"), "~ age")[1] == ["Intercept", "age=30", "age=50", "age=60"]
    with pytest.raises(ValueError):
        design.design_matrix(sheet, ["w", "q"], "~ age")
    with pytest.raises(ValueError):
        design.check_formula("~ nothing", ["age"])
    wide = np.random.default_rng(1).normal(size=(3, 4))  # more columns than samples
    basis = design.column_basis(wide)
    assert basis.shape == (3, 3) and np.isfinite(basis).all()
    full = np.column_stack([np.ones(12), np.arange(12), np.arange(12) * 2.0])
    res = np.array([r["values"] for r in design.residualize(vectors(spark, x), full).collect()])
    assert np.abs(res @ full).max() < 1e-8


def test_gene_selection(spark):
    long = spark.createDataFrame([("a", "s", 1.0), ("a", "t", 9.0), ("b", "s", 5.0), ("b", "t", 5.0), ("c", "s", 2.0), ("c", "t", 4.0)], "gene_id string, sample_id string, value double")
    pick = lambda *a: [r.gene_id for r in matrix.select_genes(long, *a).orderBy("place").collect()]
    assert pick("all") == ["a", "b", "c"] == pick("") and pick("topvar:2") == ["a", "c"] and pick("mean_gt:4.9") == ["a", "b"] and pick("regex:[bc]") == ["b", "c"]
    assert pick("genes:x", spark.createDataFrame([(" c ",), ("",)], "gene_id string")) == ["c"]
    for bad in ("topvar:0", "what:1", "genes:x"):
        with pytest.raises(ValueError):
            matrix.select_genes(long, bad)
    dense = {r.gene_id: (r.s, r.t) for r in matrix.dense(long).collect()}
    assert dense["a"] == (1.0, 9.0)
    assert matrix.to_vectors(long.where("not (gene_id = 'a' and sample_id = 's')"), ["s", "t"]).count() == 2


def test_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 40)] + [(100, 101), (101, 100), (200, 200), (300, 301), (301, 302)], "ord_a long, ord_b long")
    got = {r.node: r.component for r in modules.components(edges).collect()}
    assert {got[i] for i in range(1, 41)} == {1} and got[101] == 100 and got[302] == 300 and 200 not in got


def test_numbers_by_ranges(spark, monkeypatch):
    df = spark.range(500).select((F.col("id") * 7919 % 1009).alias("k")).repartition(5)
    want = {k: n for n, k in enumerate(sorted(r.k for r in df.collect()), 1)}
    for limit in (10_000, 50):
        monkeypatch.setattr(matrix, "ONE_TASK_ROWS", limit)
        assert {r.k: r.n for r in matrix.numbered(df, ["k"], "n").collect()} == want
        assert {r.k: r.n for r in matrix.numbered(df, [F.col("k").desc()], "n").collect()} == {k: 501 - n for k, n in want.items()}
        assert matrix.numbered(df.limit(0), ["k"], "n").count() == 0


@pytest.mark.parametrize("rows", [4, 9, 1000])
def test_sums_within_groups(spark, monkeypatch, rows):
    monkeypatch.setattr(C, "GROUP_ROWS", rows)
    monkeypatch.setattr(C, "TILE_ROWS", 3)
    x = np.random.default_rng(2).normal(size=(40, 12))
    x[7] = 1.0
    group = [1 if i < 23 else 100 + i // 3 for i in range(40)]
    vectors_ = spark.createDataFrame([(i, x[i].tolist()) for i in range(40)], "ord long, values array<double>")
    members = spark.createDataFrame([(i, g, "z") for i, g in enumerate(group) if i != 39], "node long, component long, gene string")
    z = np.nan_to_num(C.spearman_vectors(x))
    r = np.maximum(np.round(z @ z.T, C.DECIMALS), 0)
    want = {i: sum(r[i, j] for j in range(39) if j != i and group[j] == group[i]) for i in range(39)}
    got = {m.node: m.connectivity for m in modules.component_connectivity(vectors_, members).collect()}
    assert got == pytest.approx(want)


def test_rows_against_columns(spark, monkeypatch):
    monkeypatch.setattr(C, "BLOCK_ROWS", 6)
    monkeypatch.setattr(C, "TILE_ROWS", 2)
    x, y = np.random.default_rng(3).normal(size=(20, 9)), np.random.default_rng(4).normal(size=(7, 9))
    y[2] = 5.0
    make = lambda a, n: spark.createDataFrame([(f"{n}{i}", a[i].tolist()) for i in range(len(a))], f"{n} string, values array<double>")
    got = {(r.g, r.m): r.r for r in C.cross(make(x, "g"), make(y, "m"), "g", "m").collect()}
    want = C.spearman_vectors(x) @ C.spearman_vectors(y).T
    assert len(got) == 140 and all(got[f"g{i}", "m2"] is None for i in range(20))
    assert all(got[f"g{i}", f"m{j}"] == pytest.approx(want[i, j]) for i in range(20) for j in range(7) if j != 2)
    assert C.cross(make(x, "g").limit(0), make(y, "m"), "g", "m").count() == 0


def test_enrichment(spark):
    import random

    rng = random.Random(2)
    genes = [f"g{i}" for i in range(60)]
    ranked = spark.createDataFrame([("M", g, rng.gauss(0, 1) + (3 if i < 12 else 0)) for i, g in enumerate(genes)], "module_id string, gene_id string, t double")
    sets = spark.createDataFrame([("top", g) for g in genes[:12]] + [("any", g) for g in rng.sample(genes, 12)] + [("tiny", "g1"), ("other", "zz")], "pathway string, gene_id string")
    tested = {r.pathway: r for r in enrich.permutation_test(ranked, sets, 300).collect()}
    again = {r.pathway: r.p_value for r in enrich.permutation_test(ranked.repartition(7), sets, 300).collect()}
    exact = {r.pathway: r.es for r in enrich.running_scores(ranked, sets).collect()}
    assert set(tested) == {"top", "any"} and {k: r.p_value for k, r in tested.items()} == again
    assert tested["top"].p_value < 0.02 < tested["any"].p_value and tested["top"].padj >= tested["top"].p_value
    assert all(tested[k].es == pytest.approx(exact[k]) for k in tested)


def test_bh_and_normalization(spark):
    rows = spark.createDataFrame([("a", 0.01), ("b", 0.04), ("c", 0.03), ("d", None)], "g string, p_value double")
    got = {r.g: r.padj for r in enrich.bh_adjust(rows, [], order=["g"]).collect()}
    assert got["a"] == pytest.approx(0.03) and got["b"] == pytest.approx(0.04) and got["c"] == pytest.approx(0.04) and got["d"] is None
    long = spark.createDataFrame([(f"g{i}", s, float((i + 1) * f)) for i in range(9) for s, f in (("s", 10), ("t", 20), ("u", 40))], "gene_id string, sample_id string, value double")
    factors = {r.sample_id: r.size_factor for r in normalize.size_factors(long).collect()}
    assert factors["t"] == pytest.approx(2 * factors["s"]) and factors["u"] == pytest.approx(2 * factors["t"])
    rng = np.random.default_rng(5)
    y = rng.negative_binomial(10, 10 / (10 + 50), size=(40, 12)).astype(float)
    y[0, 6:] *= 8
    design_ = np.column_stack([np.ones(12), np.repeat([0.0, 1.0], 6)])
    tested = {r.gene_id: r for r in normalize.wald_test(vectors(spark, np.vstack([y, np.zeros(12)])), np.ones(12), design_, {"c": np.array([0.0, 1.0])}).collect()}
    assert tested["g000"].log2_fold_change == pytest.approx(3, abs=0.8) and tested["g000"].padj < 0.001
    assert tested["g040"].p_value is None and sum((r.padj or 1) < 0.01 for r in tested.values()) <= 4


def test_trend_and_shrinkage(spark):
    rng = np.random.default_rng(7)
    mean = np.exp(rng.uniform(1, 9, 1500))
    own = (3.0 / mean + 0.2) * rng.gamma(20, 1 / 20, 1500)
    df = spark.createDataFrame([(f"g{i}", float(m), float(d)) for i, (m, d) in enumerate(zip(mean, own, strict=True))] + [("zero", 0.0, 1e-8)], "gene_id string, mean double, dispersion double")
    a, e = normalize.fit_trend(df)
    assert a == pytest.approx(0.2, rel=0.1) and e == pytest.approx(3.0, rel=0.15)
    rows = normalize.shrunk_dispersions(df, a, e, 10).where("mean > 0").collect()
    assert all(min(r.dispersion, r.trend) * 0.999 <= r.alpha <= max(r.dispersion, r.trend) * 1.001 for r in rows)
    assert normalize._trigamma(1.0) == pytest.approx(np.pi**2 / 6, abs=1e-7) and normalize._trigamma(7.5) == pytest.approx(np.pi**2 / 2 - 4 * sum(1 / (2 * k - 1) ** 2 for k in range(1, 8)), abs=1e-7)
    flat = spark.createDataFrame([("a", 1.0, 0.1), ("b", 10.0, 0.2), ("c", 100.0, 0.9)], "gene_id string, mean double, dispersion double")
    assert normalize.fit_trend(flat) == (pytest.approx(0.4), 0.0)
    assert normalize.fit_trend(flat.limit(0)) == (1e-8, 0.0)


def test_fit_solves_its_equations():
    rng = np.random.default_rng(3)
    x = np.column_stack([np.ones(20), np.arange(20) % 2, rng.normal(size=20)])
    size, alpha = rng.uniform(0.5, 2, 20), np.array([0.05, 0.3, 1.0])
    y = rng.negative_binomial(5, 0.1, (3, 20)).astype(float)
    beta, cov = normalize._fit(y, x, np.log(size), alpha)
    mu = np.exp(beta @ x.T) * size
    score = ((y - mu) / (1 + alpha[:, None] * mu)) @ x
    assert np.abs(score - 1e-6 * beta).max() < 1e-4
    assert np.allclose(cov[1], np.linalg.inv(x.T @ ((mu[1] / (1 + 0.3 * mu[1]))[:, None] * x) + np.eye(3) * 1e-6))


def test_contrasts(spark):
    assert normalize.parse_contrasts(["t", "x", "y"]) == [("t", "x", "y", "t_x_vs_y")] and normalize.contrast("t|x|y|own")[3] == "own"
    for bad in (lambda: normalize.parse_contrasts(["t", "x"]), lambda: normalize.contrast("t|x"), lambda: normalize.check_contrasts([("q", "a", "b", "n")], ["t"]), lambda: normalize.check_runs(1, "deseq2")):
        with pytest.raises(ValueError):
            bad()
    names = ["Intercept", "t=b", "t=c"]
    assert normalize.contrast_vector(names, "t", "c", "b", ["a", "b", "c"]).tolist() == [0, -1, 1] and normalize.contrast_vector(names, "t", "b", "a", ["a", "b", "c"]).tolist() == [0, 1, 0]
    with pytest.raises(ValueError):
        normalize.contrast_vector(names, "t", "d", "a", ["a", "b", "c"])
    rng = np.random.default_rng(11)
    y = rng.negative_binomial(10, 10 / 70, size=(60, 12)).astype(float)
    y[0, 4:8] *= 6
    x = np.column_stack([np.ones(12), np.repeat([0.0, 1.0, 0.0], 4), np.repeat([0.0, 0.0, 1.0], 4)])
    wanted = {"ba": (0, 1, 0), "ab": (0, -1, 0), "bc": (0, 1, -1)}
    rows = normalize.wald_test(vectors(spark, y), np.ones(12), x, {k: np.array(v, float) for k, v in wanted.items()}).collect()
    got = {(r.contrast, r.gene_id): r for r in rows}
    assert len(rows) == 180
    assert got["ba", "g000"].log2_fold_change == pytest.approx(2.6, abs=0.9) and got["ba", "g000"].padj < 0.01
    for i in range(60):
        assert got["ab", f"g{i:03d}"].log2_fold_change == pytest.approx(-got["ba", f"g{i:03d}"].log2_fold_change, abs=1e-9)
    a = {r.gene_id: r for r in rows if r.contrast == "bc"}
    assert a["g000"].stat > 3


def test_count_modes(spark):
    df = spark.createDataFrame([("g", "s", 10.0, 4.0, 2.0), ("h", "s", 30.0, 4.0, 6.0)], "gene_id string, sample_id string, counts double, tpm double, length double")
    got = {m: {r.gene_id: r.value for r in normalize.gene_counts(df, m).collect()} for m in normalize.COUNT_MODES}
    assert got == {"no": {"g": 10.0, "h": 30.0}, "scaledTPM": {"g": 20.0, "h": 20.0}, "lengthScaledTPM": {"g": 10.0, "h": 30.0}}
    with pytest.raises(ValueError):
        normalize.gene_counts(df, "other")


def test_transformations_even_out_the_variance(spark):
    rng = np.random.default_rng(8)
    mean = np.exp(np.linspace(2, 8, 60))
    y = rng.negative_binomial(5, 5 / (5 + mean[:, None]), size=(60, 30)).astype(float)
    long = spark.createDataFrame([(f"g{i:02d}", f"s{j:02d}", float(y[i, j])) for i in range(60) for j in range(30)], "gene_id string, sample_id string, value double")
    factors = spark.createDataFrame([(f"s{j:02d}", 1.0) for j in range(30)], "sample_id string, size_factor double")
    names = [f"s{j:02d}" for j in range(30)]
    for method in ("vst", "rlog"):
        rows = normalize.stabilized(long, factors, names, method).groupBy("gene_id").agg(F.stddev("value").alias("sd")).orderBy("gene_id").collect()
        low, high = np.mean([r.sd for r in rows[:20]]), np.mean([r.sd for r in rows[40:]])
        assert 0.4 < low / high < 1.6
    with pytest.raises(ValueError):
        normalize.stabilized(long, factors, names, "log")


def test_chosen_genes(spark):
    long = spark.createDataFrame([(g, f"s{j}", float(v * j)) for g, v in (("c", 1), ("a", 3), ("b", 2)) for j in range(4)], "gene_id string, sample_id string, value double")
    places = lambda df: [r.gene_id for r in df.orderBy("place").collect()]
    assert places(matrix.chosen_genes(long, "topvar:2")) == ["a", "b"] and places(matrix.chosen_genes(long, "topvar:3")) == ["a", "b", "c"]
    assert places(matrix.chosen_genes(long.where("gene_id = 'a'"), "regex:zzz")) == ["a"]
    with pytest.raises(ValueError):
        matrix.chosen_genes(long, "topvar:1")


def test_average_rank(spark):
    df = spark.createDataFrame([("a", 2.0), ("a", 1.0), ("a", 2.0), ("a", 5.0)], "g string, v double")
    assert sorted(r["rank"] for r in matrix.average_rank(df, ["g"], "v").collect()) == [1.0, 2.5, 2.5, 4.0]


def test_pipeline(spark):
    from cohortloom.plans.pipeline import CorrelationConfig, run_correlation

    rng = np.random.default_rng(9)
    base = rng.normal(size=(3, 16))
    x = np.vstack([base[i % 3] * 3 + rng.normal(scale=0.2, size=16) for i in range(90)])
    long = spark.createDataFrame([(f"g{i:02d}", f"s{j:02d}", float(x[i, j])) for i in range(90) for j in range(16)], "gene_id string, sample_id string, value double")
    sheet = spark.createDataFrame([(f"s{j:02d}", f"b{j % 2}", "c") for j in range(16)], "sample_id string, batch string, condition string")
    sets = spark.createDataFrame([(f"set{k}", f"g{i:02d}") for k in range(3) for i in range(k, 90, 3)], "pathway string, gene_id string")
    out = run_correlation(long, sheet, CorrelationConfig(module_min_size=3, permutations=200), gene_sets=sets)
    assert out.edges.count() == 90 * 50 and out.modules.count() == 90
    assert {r.module_size for r in out.modules.collect()} == {30}
    best = out.enrichment.where("padj < 0.05 and es > 0").collect()
    assert len({r.module_id for r in best}) == 3
    assert out.tstats.select(F.max("t")).first()[0] > 5


def test_pipeline_compares_all_complete_genes(spark, monkeypatch):
    from cohortloom.plans.pipeline import CorrelationConfig, run_correlation

    monkeypatch.setattr(C, "BLOCK_ROWS", 7)
    x = np.random.default_rng(4).normal(size=(40, 8))
    absent, null = {1: 0, 2: 3, 9: 7, 16: 1, 17: 2}, {4: 5, 23: 0, 24: 6, 31: 4}
    cells = [(f"g{i:02d}", f"s{j}", None if null.get(i) == j else float(x[i, j])) for i in range(40) for j in range(8) if absent.get(i) != j]
    long = spark.createDataFrame(cells, "gene_id string, sample_id string, value double")
    sheet = spark.createDataFrame([(f"s{j}",) for j in range(8)], "sample_id string")
    config = CorrelationConfig(geneset="all", adjust="none", output="edges:threshold=0")
    got = {(r.gene_a, r.gene_b): (r.ord_a, r.ord_b, r.r) for r in run_correlation(long, sheet, config).edges.collect()}
    whole = [i for i in range(40) if i not in absent and i not in null]
    want = np.corrcoef(x[whole])
    assert set(got) == {(f"g{a:02d}", f"g{b:02d}") for n, a in enumerate(whole) for b in whole[n + 1 :]}
    assert all(got[f"g{a:02d}", f"g{b:02d}"] == (m + 1, n + 1, pytest.approx(want[m, n], abs=1e-8)) for m, a in enumerate(whole) for n, b in enumerate(whole) if m < n)


def test_modules_with_the_usual_settings(spark, sf_dir):
    from cohortloom.plans import registry
    from cohortloom.session import table as read

    rows = read(spark, sf_dir, "embeddings").orderBy("vec_id").collect()
    z = C.spearman_vectors(np.array([r.embedding for r in rows], float))
    r = np.round(z @ z.T, C.DECIMALS)
    np.fill_diagonal(r, -2.0)
    near = np.zeros(r.shape, bool)
    np.put_along_axis(near, np.argsort(-r, axis=1, kind="stable")[:, : min(20, len(r) - 1)], True, 1)
    near &= (r > 0) & near.T & (r.T > 0)
    label = np.arange(len(r))
    for _ in range(len(r)):
        label = np.minimum(label, np.where(near, label[None, :], len(r)).min(1))
    want = {}
    for c in set(label):
        inside = np.flatnonzero(label == c)
        if len(inside) >= 25:
            score = np.maximum(r[np.ix_(inside, inside)], 0).sum(1)
            want |= {rows[inside[i]].vec_id: (min(500, len(inside)), pytest.approx(score[i], abs=2e-5)) for i in np.argsort(-score)[:500]}
    got = {m.gene: (m.module_size, m.connectivity) for m in registry.queries()["module_members_usual"](spark, sf_dir).collect()}
    assert want and got == want
