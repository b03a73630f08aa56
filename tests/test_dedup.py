import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from addrspark.operators import checks, dedup
from addrspark.operators.documents import collect_items, district_dimension, door_maps, street_documents

DOORS = "id_via bigint, numpuerta bigint, tipo_via string, nom_via string, ubigeo bigint, lon_x double, lat_y double"


@pytest.fixture(scope="module")
def doors(spark):
    rng = random.Random(1)
    rows = [
        (rng.choice([1, 2, 3, None]), rng.choice([1, 2, None]), "AV", "A", 1, float(rng.randrange(3)), 0.0)
        for _ in range(200)
    ]
    rows += [(9, 9, None, "B", None, 1.0, 1.0)] * 400  # copies of one row
    rows += [(8, 8, "JR", "C", 2, float(i), 2.0) for i in range(300)]  # one hot key
    rows += [(7, n, "CA", "D", 2, 1.0, 2.0) for n in range(5)]
    return spark.createDataFrame(rows, DOORS).repartition(6)


def by_key(rows):
    return Counter((r.id_via, r.numpuerta) for r in rows)


def test_keys_report_null_rows_do_not(doors):
    counts = by_key(doors.collect())
    keys = {(r.id_via, r.numpuerta): r["count"] for r in dedup.duplicate_keys(doors).collect()}
    assert keys == {k: n for k, n in counts.items() if n > 1}
    assert (None, None) in keys
    detail = by_key(dedup.duplicate_rows(doors).collect())
    assert detail == {k: n for k, n in counts.items() if n > 1 and None not in k}
    safe = by_key(dedup.duplicate_rows(doors, null_safe=True).collect())
    assert safe == {k: n for k, n in counts.items() if n > 1}


@pytest.mark.parametrize("heavy_rows", [10, 50, 350, 1_000_000])
def test_split_numbers_each_key_once(doors, heavy_rows):
    rows = dedup.split_duplicates(doors, heavy_rows=heavy_rows).collect()
    want = {k: n for k, n in by_key(doors.collect()).items() if n > 1 and None not in k}
    assert by_key(rows) == want
    for key, n in want.items():
        numbers = sorted(r.dup_group for r in rows if (r.id_via, r.numpuerta) == key)
        assert numbers == list(range(1, n + 1))
    strip = lambda rs: Counter(tuple(r[c] for c in doors.columns) for r in rs)
    assert strip(rows) == Counter({r: n for r, n in strip(doors.collect()).items() if (r[0], r[1]) in want})


def test_unique_rows(doors):
    unique = dedup.unique_doors(doors)
    rows = unique.collect()
    assert set(by_key(rows).values()) == {1}
    assert set(by_key(rows)) == set(by_key(doors.collect()))
    assert {r.lon for r in rows if r.id_via == 8} == {0.0}
    assert dedup.duplicates_among_unique(doors).count() == 0


def test_unique_limits_before_the_shuffle(doors):
    plan = dedup.unique_doors(doors)._jdf.queryExecution().executedPlan().toString()
    partial, exchange = plan.index("Partial"), plan.index("Exchange hashpartitioning")
    assert exchange < partial  # the tree prints children below parents


def test_distinct_count_ignores_null(doors):
    assert dedup.distinct_count(doors, "id_via", "n").first().n == 6


def test_last_wins(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "c", 1)], "postcode int, v string, ord int")
    assert sorted(r.v for r in dedup.last_wins(df, ["postcode"], "ord").collect()) == ["b", "c"]


def test_district_dimension(spark):
    sheet = spark.createDataFrame(
        [(1, "A", "B", "C", "X"), (1, "A", "B", "D", "X"), (2, None, "B", "C", "Y")],
        "ubigeo bigint, NOMBDEP string, NOMBPROV string, NOMBDIST string, `REGION NATURAL` string",
    )
    rows = sorted(district_dimension(sheet).collect(), key=lambda r: r.postcode)
    assert len(rows) == 2 and rows[1].context == "Y"


@pytest.mark.parametrize("max_items", [1, 3, 7, 50, 10_000])
def test_parts_hold_every_item_once(spark, max_items):
    sizes = {"a": 1, "b": 7, "c": 20, None: 160}
    rows = [(k, i) for k, n in sizes.items() for i in range(n)]
    rows += [("copies", 5)] * 100
    df = spark.createDataFrame(rows, "k string, v int").repartition(5)
    parts = collect_items(df, ["k"], F.col("v"), "items", max_items).collect()
    assert Counter(v for p in parts if p.k == "copies" for v in p["items"]) == {5: 100}
    assert all(len(p["items"]) <= max_items for p in parts)
    for key, n in sizes.items():
        mine = [p for p in parts if p.k == key]
        assert sorted(v for p in mine for v in p["items"]) == list(range(n))
        assert len({p.part for p in mine}) == len(mine)
        assert all(p["items"] == sorted(p["items"]) and len(p["items"]) <= max_items for p in mine)
        if n <= max_items:
            assert [p.part for p in mine] == [0]


def test_street_documents_keep_unknown_districts(spark, doors):
    districts = spark.createDataFrame(
        [(1, "DEP", "PROV", "DIST", "COSTA")],
        "postcode bigint, cod_departament string, cod_province string, cod_district string, context string",
    )
    whole = street_documents(doors, districts).collect()
    assert {d.cod_departament for d in whole} == {"DEP", None}
    assert all(d.part == 0 and d.type == "street" for d in whole)
    small = street_documents(doors, districts, max_items=2).collect()
    houses = lambda docs: Counter((d.id_via, d.name, h.number, h.location.lon) for d in docs for h in d.housenumbers)
    assert houses(whole) == houses(small) and len(small) > len(whole)


def test_door_maps(doors):
    maps = door_maps(doors).collect()
    seven = next(m for m in maps if m.id_via == 7)
    assert set(seven.housenumbers) == {"0", "1", "2", "3", "4"}


def test_a_key_of_any_size_is_one_row(spark):
    rows = spark.range(25_000).selectExpr("1 k", "cast(id as int) v")
    whole = collect_items(rows, ["k"], F.col("v"), "items").collect()
    assert len(whole) == 1 and whole[0]["items"] == list(range(25_000)) and whole[0].part == 0


def test_ranks_do_not_depend_on_size(spark):
    rows = [(1, n % 3, float(n % 200)) for n in range(500)] + [(2, None, 1.0), (2, None, None), (2, 0, 5.0), (3, 1, 1.0)]
    df = spark.createDataFrame(rows, "k int, a int, b double").repartition(4)
    few = Counter(map(tuple, dedup.split_duplicates(df, ["k"]).collect()))
    for heavy_rows in (1, 7, 100):
        assert Counter(map(tuple, dedup.split_duplicates(df, ["k"], heavy_rows=heavy_rows).collect())) == few


def test_more_heavy_keys_than_a_thousand(spark):
    df = spark.range(4500).selectExpr("cast(id % 1500 as int) k", "cast(id as int) v")
    got = dedup.split_duplicates(df, ["k"], heavy_rows=2).collect()
    assert Counter(r.dup_group for r in got) == {1: 1500, 2: 1500, 3: 1500}
    assert all(r.dup_group == r.v // 1500 + 1 for r in got)


def test_duplicate_rows_in_order(spark):
    df = spark.createDataFrame([(2, 5), (1, 9), (2, 3), (1, None), (3, 1)], "k int, v int")
    assert [tuple(r) for r in dedup.duplicate_rows(df, ["k"], sort=True).collect()] == [(1, None), (1, 9), (2, 3), (2, 5)]


def test_checks(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    with pytest.raises(ValueError):
        checks.require_columns(df, "a", "c")
    assert checks.pick_column(df, "x", "b") == "b"
    with pytest.raises(ValueError):
        checks.pick_column(df, "x")
    assert checks.capped(spark.range(10), 3).count() == 3 and checks.capped(df, None) is df
    assert checks.outcome_counts(spark.range(3), spark.range(0)).first() == (3, 0)
    assert checks.outcome_counts(spark.range(0), spark.range(0)).first() == (0, 0)
    checks.require_empty(spark.range(0), "none")
    with pytest.raises(ValueError, match="bad rows"):
        checks.require_empty(spark.range(1), "bad rows")
