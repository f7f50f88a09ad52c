import random

import pytest

from cohortloom.llm.packing import SumOfSquares, fill_report, pack, placement_report


@pytest.mark.parametrize("capacity", [5, 16, 100])
def test_rule_against_the_definition(capacity):
    rng = random.Random(capacity)
    packer, counts = SumOfSquares(capacity), [0] * (capacity + 1)
    fill = {}
    for _ in range(400):
        size = rng.randint(1, capacity)
        options = []
        for h in range(capacity - size + 1):
            if h and not counts[h]:
                continue
            trial = counts[:]
            if h:
                trial[h] -= 1
            trial[h + size] += 1
            options.append((sum(c * c for c in trial[1:capacity]), -h))
        where, level = packer.place(size)
        best = min(options)
        assert level == -best[1]
        assert fill.get(where, 0) == level
        fill[where] = level + size
        if level:
            counts[level] -= 1
        counts[level + size] += 1
        counts[capacity] = 0


def items(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, n_tokens long, container_id string")


def test_everything_is_placed_once(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice([None, 0, rng.randint(1, 90), 100, rng.randint(101, 350)]), "x") for i in range(3000)]
    out = pack(items(spark, rows), "doc_id", "n_tokens", 100, shard_items=500).collect()
    placed, filled = {}, {}
    for r in out:
        placed[r.doc_id] = placed.get(r.doc_id, 0) + r.n_tokens
        if r.container_id is None:
            assert r.n_tokens == 0 and r.start_at is None
        else:
            filled.setdefault(r.container_id, []).append((r.start_at, r.n_tokens))
    assert placed == {i: n or 0 for i, n, _ in rows}
    for spans in filled.values():
        end = 0
        for start, length in sorted(spans):
            assert start == end
            end += length
        assert end <= 100
    total = sum(n or 0 for _, n, _ in rows)
    assert total / (100 * len(filled)) > 0.97
    pieces = {}
    for r in out:
        pieces.setdefault(r.doc_id, []).append(r.n_tokens)
    assert all(len(p) == 1 for i, p in pieces.items() if (rows[i][1] or 0) <= 100)
    again = pack(items(spark, rows).repartition(3), "doc_id", "n_tokens", 100, shard_items=500).collect()
    assert sorted(map(tuple, again), key=str) == sorted(map(tuple, out), key=str)


def test_report_repeats_and_empty(spark):
    out = pack(items(spark, [(1, 10, ""), (1, 10, ""), (2, 5, "")]), "doc_id", "n_tokens", 10)
    assert out.count() == 3
    assert sum(r.n_containers for r in fill_report(out, 10).collect()) == 3
    assert pack(items(spark, []), "doc_id", "n_tokens").count() == 0


def test_placement_report(spark):
    schema = "doc_id long, piece_no long, container_id long, start_at long, n_tokens long"
    rows = [(1, 1, 7, 0, 6), (2, 1, 7, 6, 4), (3, 1, None, None, 0), (4, 1, 8, 0, 10), (4, 2, 9, 0, 1), (5, 1, 9, 1, 10), (6, 1, 10, 0, 2), (6, 2, 10, 2, 2), (7, 1, 11, 5, 2)]
    got = {r.doc_id: (r.placed, r.whole, r.fits) for r in placement_report(spark.createDataFrame(rows, schema), "doc_id", 10).collect()}
    good = (True, True, True)
    assert got == {1: good, 2: good, 3: (False, True, True), 4: (True, True, False), 5: (True, True, False), 6: (True, False, True), 7: (True, True, False)}
    packed = pack(items(spark, [(i, i % 13 * 9, "") for i in range(500)]), "doc_id", "n_tokens", 50, shard_items=60)
    assert all((r.whole, r.fits) == (True, True) and r.placed == (r.doc_id % 13 > 0) for r in placement_report(packed, "doc_id", 50).collect())
