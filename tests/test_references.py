from datetime import datetime as D

import pytest

from cohortloom.operators import references as R

REFS = "key_kind string, key string, src_table string, row_id long, ref_field string, at timestamp_ntz, extra string"
PARENTS = "key_kind string, key string, record string, arrived_at timestamp_ntz, status string"
REMOVALS = "record string, removed_at timestamp_ntz"


def t(day):
    return D(2024, 3, day)


def found(spark, refs, parents, removals, **kw):
    out = R.orphan_references(spark.createDataFrame(refs, REFS), spark.createDataFrame(parents, PARENTS), spark.createDataFrame(removals, REMOVALS), **kw)
    return {(r.row_id, r.status, r.ref_month) for r in out.collect()}


def ref(i, key, at, kind="run"):
    return (kind, key, "t", i, "run_accession", at, "x")


def test_statuses(spark):
    parents = [("run", "A", "A", t(5), "s"), ("run", "A", "A", t(9), "s"), ("run", "B", "B", t(5), None)]
    removals = [("B", t(10)), ("B", t(20)), ("Z", t(1))]
    refs = [ref(1, "A", t(5)), ref(2, "A", t(4)), ref(3, "Q", t(5)), ref(4, "B", t(9)), ref(5, "B", t(10)), ref(6, "B", t(30)), ref(7, None, t(5)), ref(8, "A", None), ref(9, "Q", None)]
    m = "2024-03"
    assert found(spark, refs, parents, removals) == {(2, "late", m), (3, "missing", m), (5, "withdrawn", m), (6, "withdrawn", m), (9, "missing", None)}


def test_several_records_carry_one_key(spark):
    parents = [("sample", "S", "A", t(2), ""), ("sample", "S", "B", t(10), "")]
    removals = [("A", t(5)), ("B", t(12))]
    refs = [ref(i, "S", t(i), "sample") for i in (1, 2, 4, 5, 9, 10, 11, 12, 20)]
    got = {(i, s) for i, s, _ in found(spark, refs, parents, removals)}
    assert got == {(1, "late"), (5, "withdrawn"), (9, "withdrawn"), (12, "withdrawn"), (20, "withdrawn")}


def test_removed_before_arrival_is_never_valid(spark):
    got = found(spark, [ref(1, "A", t(9)), ref(2, "A", t(3))], [("run", "A", "A", t(6), "")], [("A", t(2))])
    assert {(i, s) for i, s, _ in got} == {(1, "withdrawn"), (2, "late")}


def test_heavy_key_over_shards_gives_the_same(spark):
    parents = [("run", "A", "A", t(5), ""), ("run", "B", "B", t(5), "")]
    refs = [ref(i, "A" if i % 3 else "B", t(1 + i % 20)) for i in range(300)]
    assert found(spark, refs, parents, [("A", t(12))], shard_rows=20) == found(spark, refs, parents, [("A", t(12))])


def test_hot_key_whose_records_were_all_removed(spark):
    parents = [("sample", "S", f"R{i}", D(2024, 3, 1 + i % 3, i % 24, i % 60), "") for i in range(900)]
    removals = [(f"R{i}", t(10 + i % 3)) for i in range(900)] + [("R5", t(9))] * 4
    frames = spark.createDataFrame(parents, PARENTS), spark.createDataFrame(removals, REMOVALS)
    events = R.parent_intervals(*frames).collect()
    assert len(events) == 4  # known, first arrival, and one interval in place of 900
    refs = [ref(i, "S", t(i), "sample") for i in (1, 4, 11, 12, 13)]
    assert {(i, s) for i, s, _ in found(spark, refs, parents, removals, shard_rows=2)} == {(12, "withdrawn"), (13, "withdrawn")}


def test_intervals_are_merged(spark):
    rows = [("a", t(1), t(4)), ("a", t(2), t(3)), ("a", t(4), t(6)), ("a", t(8), t(9)), ("b", t(1), t(2))]
    got = R.merge_intervals(spark.createDataFrame(rows, "k string, begin timestamp_ntz, end timestamp_ntz"), ["k"]).collect()
    assert sorted(map(tuple, got)) == [("a", t(1), t(6)), ("a", t(8), t(9)), ("b", t(1), t(2))]


def test_repeated_rows_each_count_and_empty_tables(spark):
    out = R.orphan_references(spark.createDataFrame([ref(1, "Q", t(1))] * 3, REFS), spark.createDataFrame([], PARENTS), spark.createDataFrame([], REMOVALS))
    assert out.count() == 3
    assert found(spark, [], [("run", "A", "A", t(1), "")], []) == set()


@pytest.mark.parametrize("seed", range(3))
def test_against_brute_force(spark, seed):
    import random

    rng = random.Random(seed)
    records = {f"R{i}": (t(rng.randint(1, 28)), t(rng.randint(1, 28)) if rng.random() < 0.6 else None) for i in range(15)}
    carried = [("sample", f"S{rng.randint(0, 4)}", r, a, "") for r, (a, _) in records.items()]
    refs = [ref(i, f"S{rng.randint(0, 6)}", t(rng.randint(1, 28)), "sample") for i in range(150)]
    want = set()
    for _, key, _, i, _, at, _ in refs:
        own = [records[r] for _, k, r, _, _ in carried if k == key]
        here = [w for a, w in own if a <= at]
        status = "missing" if not own else "late" if not here else "withdrawn" if all(w and w <= at for w in here) else None
        if status:
            want.add((i, status, "2024-03"))
    assert found(spark, refs, carried, [(r, w) for r, (_, w) in records.items() if w]) == want
