import numpy as np
import pytest

from cohortloom.llm import vectors as V

SCHEMA = "row_key long, row_values array<double>, key string, z string"


def brute(keys, x, k, least):
    z = x - x.mean(1, keepdims=True)
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    s = np.round(z @ z.T, 6)
    out = {}
    for i in range(len(x)):
        order = sorted((j for j in range(len(x)) if j != i), key=lambda j: (-s[i, j], keys[j]))[:k]
        out[keys[i]] = [(keys[j], s[i, j]) for j in order if least is None or s[i, j] >= least]
    return out


def data(n, seed, size=48):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(n // 6, size))
    x = centres[rng.integers(0, len(centres), n)] + rng.normal(scale=0.25, size=(n, size))
    x = np.round(x * rng.uniform(0.5, 5, (n, 1)) + rng.uniform(-3, 3, (n, 1)), 4)
    x[: n // 10] = x[rng.integers(0, n, n // 10)]  # repeated rows
    x[n // 2 : n // 2 + n // 4] = x[0]  # one vector that a quarter of the rows share
    return rng.permutation(n * 3)[:n].tolist(), x


def test_hilbert_neighbours_are_next_to_each_other():
    for dims, bits in ((2, 4), (3, 3), (5, 2)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
        keys = V.hilbert_keys(grid, bits)
        assert sorted(keys) == list(range(len(grid)))
        path = grid[np.argsort(keys)]
        assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


@pytest.mark.parametrize("seed", range(2))
def test_pairs_against_brute_force(spark, seed):
    keys, x = data(900, seed)
    df = spark.createDataFrame([(k, v.tolist(), "a", "b") for k, v in zip(keys, x, strict=True)], SCHEMA)
    want = {(min(k, o), max(k, o)) for k, near in brute(keys, x, 5, 0.9).items() for o, _ in near}
    got = {tuple(r) for r in V.neighbour_pairs(V.nearest(df, "row_key", "row_values", 48, 5, 0.9, shard_rows=50)).collect()}
    assert len(got & want) >= 0.99 * len(want) and len(got - want) <= 0.01 * len(want)


def test_recall_without_threshold(spark):
    keys, x = data(1500, 7)
    df = spark.createDataFrame([(k, v.tolist(), "a", "b") for k, v in zip(keys, x, strict=True)], SCHEMA)
    want = {(k, o) for k, near in brute(keys, x, 5, None).items() for o, _ in near}
    rows = V.nearest(df, "row_key", "row_values", 48, 5).collect()
    assert len({(r.key, r.other) for r in rows} & want) >= 0.9 * len(want)
    ranks = {}
    for r in rows:
        ranks.setdefault(r.key, []).append((r.rank_no, -r.sim, r.other))
    assert all(sorted(v) == sorted(v, key=lambda e: e[1:]) and len(v) == 5 for v in ranks.values())


def test_unusable_vectors_and_empty(spark):
    ok, other = [float(i) for i in range(4)], [0.0, 1.0, 2.0, 3.5]
    rows = [(1, ok), (2, other), (3, None), (4, [1.0] * 4), (5, [1.0, None, 2.0, 3.0]), (6, [1.0, float("nan"), 2.0, 3.0]), (7, [1.0, float("inf"), 2.0, 3.0]), (8, [1.0, 2.0]), (9, []), (None, ok), (10, [1e300, -1e300, 1e300, 2.0])]
    df = spark.createDataFrame([(*r, "", "") for r in rows], SCHEMA)
    assert {tuple(r) for r in V.neighbour_pairs(V.nearest(df, "row_key", "row_values", 4, 5, 0.9)).collect()} == {(1, 2)}
    assert V.nearest(df.limit(0), "row_key", "row_values", 4, 5, 0.9).count() == 0


def test_ties_take_the_smaller_key(spark):
    df = spark.createDataFrame([(k, [1.0, 2.0, 4.0, 8.0], "", "") for k in (9, 3, 7, 1, 5, 8, 2)], SCHEMA)
    got = {}
    for r in V.nearest(df, "row_key", "row_values", 4, 3).collect():
        got.setdefault(r.key, []).append((r.rank_no, r.other, r.sim))
    assert [o for _, o, _ in sorted(got[9])] == [1, 2, 3] and [o for _, o, _ in sorted(got[2])] == [1, 3, 5]


def found_and_wanted(spark, keys, x):
    """Pairs found and those of brute force, with k = 5 and at least 0.9."""
    by_key = np.argsort(keys)
    z = x[by_key] - x[by_key].mean(1, keepdims=True)
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    s = np.round(z @ z.T, 6)
    np.fill_diagonal(s, -2.0)
    near = np.argsort(-s, axis=1, kind="stable")[:, :5]
    at = np.sort(keys)
    want = {(min(at[i], at[j]), max(at[i], at[j])) for i in range(len(at)) for j in near[i] if s[i, j] >= 0.9}
    df = spark.createDataFrame([(int(k), v.tolist(), "a", "b") for k, v in zip(keys, x, strict=True)], SCHEMA)
    return {tuple(r) for r in V.neighbour_pairs(V.nearest(df, "row_key", "row_values", 48, 5, 0.9)).collect()}, want


def test_scaled_copies_take_the_smallest_keys(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(3000, 48))
    x[400:] = x[0] * rng.uniform(0.5, 5, (2600, 1)) + rng.uniform(-3, 3, (2600, 1))
    got, want = found_and_wanted(spark, rng.permutation(9000)[:3000], x)
    assert len(want) > 12000 and got == want


def test_copies_that_differ_by_rounding(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(3000, 48))
    x[400:] = x[0] * rng.uniform(0.5, 5, (2600, 1)) + rng.uniform(-3, 3, (2600, 1))
    got, want = found_and_wanted(spark, rng.permutation(9000)[:3000], np.round(x, 4))
    assert len(got & want) >= 0.99 * len(want) and len(got - want) <= 0.01 * len(want)


def test_close_replicates_are_ranked_exactly(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(600, 48))
    x[100:] = x[0] + rng.normal(scale=0.005, size=(500, 48))
    got, want = found_and_wanted(spark, rng.permutation(5000)[:600], x)
    assert len(got & want) >= 0.99 * len(want) and len(got - want) <= 0.01 * len(want)


def test_windows_cut_nothing_that_rounding_leaves_undecided():
    low, high = np.array([[0.95, 0.91, 0.91, 0.90, 0.90]]), np.array([[0.95, 0.92, 0.91, 0.91, 0.90]])
    assert V._first(low, high, 2).tolist() == [[True, True, False, False, False]]
    assert V._first(low[:, ::-1], high[:, ::-1], 2).tolist() == [[False, True, True, True, True]]


def test_parts_begin_with_cells_and_cut_only_large_ones():
    rng = np.random.default_rng(1)
    spots, keys = np.concatenate([rng.integers(0, 1000, 4000), np.full(4000, 500)]), rng.permutation(8000).astype(np.int64)
    at_spot, at_key = V.cut_points(spots, keys, 8)
    inside = at_key != V._FIRST
    assert inside.sum() >= 3 and set(at_spot[inside]) == {500}
    part = V._part_of(spots, keys, (at_spot, at_key))
    want = [sum((s, k) <= (a, b) for s, k in zip(at_spot, at_key, strict=True)) for a, b in zip(spots, keys, strict=True)]
    assert part.tolist() == want and np.bincount(part).max() < 2500
    assert all(len(set(part[spots == s])) == 1 for s in set(spots) - {500})
    assert V._part_of(spots, keys, (np.empty(0, np.int64), np.empty(0, np.int64))).max() == 0


def test_a_cell_of_near_copies_over_many_tasks(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(6000, 48))
    x[500:] = x[0] + rng.normal(scale=1e-5, size=(5500, 48))
    keys = rng.permutation(20_000)[:6000]
    df = spark.createDataFrame([(int(k), v.tolist(), "a", "b") for k, v in zip(keys, x, strict=True)], SCHEMA)
    cuts = V.cut_points(np.full(6000, 7), keys.astype(np.int64), 12)
    assert len(cuts[0]) == 11  # the copies of one cell are cut into all parts
    got = {}
    for r in V.nearest(df, "row_key", "row_values", 48, 5, 0.9, part_rows=500).collect():
        got.setdefault(r.key, []).append((r.rank_no, r.other))
    near = sorted([int(keys[0]), *map(int, keys[500:])])[:6]
    copies = {int(keys[0]), *map(int, keys[500:])}
    right = sum([o for _, o in sorted(got[c])] == [n for n in near if n != c][:5] for c in copies)
    assert right >= 0.99 * len(copies)


def test_small_parts_find_the_same(spark):
    keys, x = data(900, 3)
    df = spark.createDataFrame([(k, v.tolist(), "a", "b") for k, v in zip(keys, x, strict=True)], SCHEMA)
    find = lambda **kw: {tuple(r) for r in V.neighbour_pairs(V.nearest(df, "row_key", "row_values", 48, 5, 0.9, **kw)).collect()}
    one, many = find(), find(part_rows=150)
    assert len(one & many) >= 0.99 * len(one | many)


def test_orderings_grow_with_the_input():
    assert V.curve_count(0) == V.curve_count(1 << 17) == V.CURVES and V.curve_count((1 << 17) + 1) == V.CURVES + 1 and V.curve_count(1 << 30) == V.CURVES + 26
