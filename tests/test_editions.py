"""Differences between editions and totals over grouping sets against plain Python."""

import random
from collections import Counter

import pytest

from addrspark.operators import editions, totals
from test_plans import plan


@pytest.fixture(scope="module")
def both(spark):
    rng = random.Random(1)
    rows = [[(rng.choice([None, 1, 2, 3]), rng.choice([None, "a", "b"])) for _ in range(400)] for _ in range(2)]
    rows[0] += [(9, "hot")] * 1000
    rows[1] += [(9, "hot")] * 300 + [(None, None)] * 5
    return [spark.createDataFrame(r, "`a.x` int, b string") for r in rows], [Counter(r) for r in rows]


def test_set_operations_count_copies(both):
    (old, new), (was, now) = both
    want = {"except": was - now, "added": now - was, "intersect": was & now, "union": was + now}
    for operation, rows in want.items():
        found = editions.edition_rows(old, new, operation)
        assert found.columns == old.columns
        assert Counter(map(tuple, found.collect())) == rows
    with pytest.raises(ValueError, match="none of"):
        editions.edition_rows(old, new, "minus")
    with pytest.raises(ValueError, match="missing"):
        editions.counted_editions(old, new.drop("b"))


def test_copies_are_written_in_runs(both):
    (old, new), (was, now) = both
    counted = editions.counted_editions(old, new)
    found = editions.repeated(counted, counted.n_old, run=7)
    assert Counter(map(tuple, found.collect())) == was
    assert editions.edition_changes(old.limit(0), new.limit(0)).count() == 0


def test_editions_share_one_shuffle(both):
    (old, new), _ = both
    text = plan(editions.counted_editions(old, new))
    assert text.count("Exchange hashpartitioning") == 1


def grouped(rows, sets):
    out = set()
    for chosen in sets:
        groups = {}
        for a, b, v in rows:
            groups.setdefault((a if "a" in chosen else None, b if "b" in chosen else None), []).append(v)
        if not chosen and not rows:
            groups[None, None] = []
        mask = 2 * ("a" not in chosen) + ("b" not in chosen)
        out |= {(*g, mask, len(v), len({x for x in v if x is not None})) for g, v in groups.items()}
    return out


def test_totals_of_rollup_and_cube(spark):
    rng = random.Random(3)
    rows = [(rng.choice([None, "x", "x", "x", "y"]), rng.choice([None, 1, 2]), rng.choice([None, *range(30)])) for _ in range(600)]
    for data in (rows, []):
        table = spark.createDataFrame(data, "a string, b int, v int")
        for sets in (totals.rollup_sets(["a", "b"]), totals.cube_sets(["a", "b"]), [["b"]]):
            found = totals.totals(table, ["a", "b"], sets, "v")
            assert found.count() == len(grouped(data, sets))
            assert set(map(tuple, found.collect())) == grouped(data, sets)
    with pytest.raises(ValueError, match="besides"):
        totals.totals(table, ["a"], [["b"]], "v")


def test_sets_multiply_groups_and_not_rows(spark):
    text = plan(totals.totals(spark.createDataFrame([], "a string, b int, v int"), ["a", "b"], [["a", "b"], ["a"]], "v"))
    # Below (after) the copies for the sets there is an aggregate of its own.
    assert text.index("Generate") < text.rindex("HashAggregate")
