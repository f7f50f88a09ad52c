import math
import random

import pytest

from cohortloom.llm import topn

SCHEMA = "col_id string, row_id string, cell_value double, bound string"


def brute(rows, n):
    best = {}
    for g, i, v, _ in rows:
        if g is not None and i is not None and v is not None and math.isfinite(v):
            best.setdefault(g, {})[i] = max(best.get(g, {}).get(i, -math.inf), v)
    return sorted((g, i, k) for g, m in best.items() for k, (i, _) in enumerate(sorted(m.items(), key=lambda x: (-x[1], x[0].encode()))[:n], 1))


def run(spark, rows, n=5, parts=7):
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    return sorted(tuple(r) for r in topn.top_n(df, "col_id", "row_id", "cell_value", n).collect())


@pytest.mark.parametrize("seed", range(4))
def test_against_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(topn, "GATHER_ROWS", 100)
    rng = random.Random(seed)
    values = [None, math.nan, math.inf, -math.inf, 0.0, -0.0, 1.0, 2.5, 2.5, -3.0]
    rows = [(rng.choice(["hot", "hot", "hot", "a", "b", None, "éñ"]), rng.choice([f"r{rng.randint(0, 60)}", "R1", "ß", None]), rng.choice([*values, rng.random()]), "clash") for _ in range(3000)]
    assert run(spark, rows) == brute(rows, 5)
    assert run(spark, rows, 1, 1) == brute(rows, 1)


def test_local_bound_is_exact(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(topn, "GATHER_ROWS", 10)
    best = topn.LocalBest(2)
    for k in range(30):
        best.add(pa.table({"group": ["g"] * 3 + ["h"], "item": [f"i{k}", f"i{k}", f"j{k}", "x"], "value": [float(k % 11), 1.0, float(k % 7), 5.0]}))
    kept = best.shrink().to_pylist()
    assert [(r["item"], r["value"], r["bound"]) for r in kept if r["group"] == "g"] == [("i10", 10.0, 10.0), ("i21", 10.0, 10.0)]
    assert [(r["item"], r["bound"]) for r in kept if r["group"] == "h"] == [("x", None)]


@pytest.mark.parametrize("most", [0, 1, 100])
def test_bounds_drop_rows_before_the_shuffle(spark, monkeypatch, most):
    rng = random.Random(9)
    rows = [(rng.choice("abc"), f"r{rng.randint(0, 900)}", float(rng.randint(0, 300)), "") for _ in range(4000)]
    whole = topn.listed_bounds
    seen = []

    def some(kept, n):
        out = whole(kept, n, most)
        left = kept.join(out, "group", "left").where("listed is null or value >= listed").count()
        seen.append((kept.count(), out.count(), left))
        return out

    monkeypatch.setattr(topn, "listed_bounds", some)
    assert run(spark, rows) == brute(rows, 5)
    ((kept, listed, left),) = seen
    assert kept == 3 * 5 * 7 and listed == min(most, 3)
    assert left == kept if not most else left < kept
    assert most < 3 or left < kept / 2


def test_empty_and_all_unusable(spark):
    assert run(spark, []) == []
    assert run(spark, [("g", "i", math.nan, ""), ("g", "j", None, "")]) == []
