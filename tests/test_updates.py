"""Patches in place, repeatable loads, bounded arrays, sketches and table functions."""

import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

from addrspark.functions import tables
from addrspark.functions.shapes import shape, vertex
from addrspark.operators import documents, patch, sketches
from addrspark.plans import flows
from addrspark.schemas import INDEX_MAPPING, schema_from_mapping


def stored(path):
    return {str(f.relative_to(path)): f.stat().st_mtime_ns for f in path.rglob("*.parquet")}


@pytest.fixture
def buckets(spark, tmp_path):
    rows = [(i if i % 50 else None, f"n{i}", i * 2) for i in range(1000)] + [(5, "again", 0)] * 3
    patch.write_buckets(spark.createDataFrame(rows, "id bigint, name string, v bigint"), str(tmp_path / "docs"), "id", 8)
    return tmp_path / "docs", rows


def test_only_patched_buckets_are_rewritten(spark, buckets):
    path, rows = buckets
    before = stored(path)
    patches = spark.createDataFrame([(5, "new"), (6, None), (7, "a"), (7, "b"), (70_000, "x"), (None, "null")], "id bigint, name string")
    unknown, repeated = patch.patch_buckets(spark, str(path), patches, "id", 8)
    assert Counter(map(tuple, unknown.collect())) == Counter([(70_000, "x"), (None, "null")])
    assert Counter(map(tuple, repeated.collect())) == Counter([(7, "a"), (7, "b")])
    new = {5: "new", 6: None}
    want = Counter((i, new.get(i, n), v) for i, n, v in rows)
    assert Counter(map(tuple, spark.read.parquet(str(path)).select("id", "name", "v").collect())) == want
    after = stored(path)
    asked = spark.createDataFrame([(5,), (6,), (7,)], "id bigint").select(patch.bucket_of(["id"], 8).alias("b")).distinct()
    folders = {f"{patch.BUCKET}={r.b}" for r in asked.collect()}
    for file, time in before.items():
        if file.split("/")[0] not in folders:
            assert after[file] == time
    assert any(file not in after for file in before)
    assert len({f.split("/")[0] for f in after}) == 8


def test_patches_of_nothing_change_nothing(spark, buckets):
    path, _ = buckets
    before = stored(path)
    patches = spark.createDataFrame([(123_456, "x")], "id bigint, name string")
    unknown, _ = patch.patch_buckets(spark, str(path), patches, "id", 8)
    assert unknown.count() == 1 and stored(path) == before
    patch.patch_buckets(spark, str(path), patches.limit(0), "id", 8)
    assert stored(path) == before
    with pytest.raises(LookupError, match="123456"):
        patch.patch_buckets(spark, str(path), patches, "id", 8, strict=True)
    assert stored(path) == before


def test_the_highest_order_wins_in_place(spark, buckets):
    path, _ = buckets
    patches = spark.createDataFrame([(9, "old", 1), (9, "new", 2)], "id bigint, name string, at int")
    patch.patch_buckets(spark, str(path), patches, "id", 8, order="at")
    assert [r.name for r in spark.read.parquet(str(path)).filter("id = 9").collect()] == ["new"]


def test_a_load_may_be_run_again(spark, tmp_path):
    def line(i, name):
        return json.dumps({"id_via": i, "name": name, "postcode": 1, "housenumbers": []})

    (tmp_path / "docs.ndjson").write_text("\n".join([line(1, "b"), line(1, "a"), line(2, "c"), "{", line("x", "d")]) + "\n")
    schema = schema_from_mapping(INDEX_MAPPING)
    spark.sql("DROP TABLE IF EXISTS loaded_again")
    counts = [
        flows.load_documents(spark, str(tmp_path / "docs.ndjson"), "loaded_again", schema, str(tmp_path / "rejects"), ["id_via"])
        for _ in range(3)
    ]
    assert counts == [{"succeeded": 2, "failed": 2}] + [{"succeeded": 0, "failed": 2}] * 2
    assert Counter((r.id_via, r.name) for r in spark.table("loaded_again").collect()) == Counter([(1, "a"), (2, "c")])
    assert spark.read.text(str(tmp_path / "rejects")).count() == 2
    spark.sql("DROP TABLE loaded_again")


@pytest.mark.parametrize("most", [1, 7, 1000])
def test_arrays_are_cut_before_they_are_collected(spark, most):
    rows = spark.range(300).selectExpr("CASE WHEN id < 200 THEN 1 ELSE id % 3 END k", "(id * 37) % 300 v")
    got = documents.collect_items(rows, ["k"], F.col("v"), "vs", most).collect()
    for key in {r.k for r in got}:
        parts = sorted((r.part, r.vs) for r in got if r.k == key)
        values = sorted(r.v for r in rows.collect() if r.k == key)
        assert [p for p, _ in parts] == list(range(len(parts)))
        assert [v for _, vs in parts for v in vs] == values and all(len(vs) == most for _, vs in parts[:-1])
    text = documents.collect_items(rows, ["k"], F.col("v"), "vs", most)._jdf.queryExecution().executedPlan().toString()
    assert text.index("ObjectHashAggregate") < text.index("Window")  # parents come first


def test_sketches_merge_without_the_rows(spark):
    rows = spark.range(60_000).selectExpr("id % 4 a", "id % 3 b", "id % 9000 v").unionByName(spark.createDataFrame([(9, 9, None)], "a bigint, b bigint, v bigint"))
    stored = sketches.distinct_sketches(rows, ["a", "b"], "v")
    for keys in (["a"], ["b"], ["a", "b"]):
        exact = {tuple(r)[:-1]: r.n for r in rows.groupBy(*keys).agg(F.count_distinct("v").alias("n")).collect()}
        near = sketches.estimated(sketches.merged_sketches(stored, keys)).collect()
        assert {tuple(r)[:-1] for r in near} == set(exact)
        assert all(abs(r.estimate - exact[tuple(r)[:-1]]) <= exact[tuple(r)[:-1]] * sketches.relative_error() for r in near)


def test_shape_edges_in_sql(spark):
    def ring(points):
        return F.array(*[vertex(F.lit(float(x)), F.lit(float(y))) for x, y in points])

    square, hole, line = [(0, 0), (4, 0), (4, 4), (0, 0)], [(1, 1), (2, 1), (1, 1)], [(5, 5), (6, 7)]
    kinds = {
        1: shape("MultiPolygon", F.array(F.array(ring(square), ring(hole)), F.array(ring(square)))),
        2: shape("LineString", F.array(F.array(ring(line)))),
    }
    rows = [spark.range(1).select(F.lit(i).cast("bigint").alias("lot_id"), g.alias("geometry"), F.lit("x").alias("other")) for i, g in kinds.items()]
    lots = rows[0].unionByName(rows[1])
    empty = lots.limit(1).withColumn("lot_id", F.lit(4).cast("bigint")).withColumn("geometry", F.when(F.lit(False), F.col("geometry")))
    tables.register_table_functions(spark)
    got = spark.sql("SELECT * FROM shape_edges(TABLE({lots}) PARTITION BY lot_id)", lots=lots.unionByName(empty)).collect()
    want = []
    for i, parts in ((1, [[square, hole], [square]]), (2, [[line]])):
        for p, rings in enumerate(parts):
            for r, points in enumerate(rings):
                want += [(i, p, r, e, *map(float, (*a, *b))) for e, (a, b) in enumerate(zip(points, points[1:], strict=False))]
    assert Counter(map(tuple, got)) == Counter(want)
    assert spark.sql("SELECT * FROM shape_edges(TABLE({lots}) PARTITION BY lot_id)", lots=lots.limit(0)).count() == 0
    # Whole batches hold null shapes among others, and lots that come twice.
    many = empty.unionByName(lots).unionByName(empty).unionByName(lots).coalesce(1)
    assert Counter(map(tuple, spark.sql("SELECT * FROM shape_edges(TABLE({lots}))", lots=many).collect())) == Counter(want * 2)
