"""Shape of the physical plans on the test tables."""

import re

import pytest

from addrspark.operators import totals
from addrspark.workload import fixtures as fx
from addrspark.workload.queries import QUERIES

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text


def test_scans_read_only_what_is_used(spark):
    text = plan(QUERIES["distinct_streets"](spark, SF))
    assert re.search(r"ReadSchema: struct<l_orderkey:bigint>", text)
    assert "l_comment" not in plan(QUERIES["street_documents"](spark, SF))


def test_no_python_outside_the_binary_and_accent_steps(spark):
    with_python = {n for n, q in QUERIES.items() if "ArrowEval" in plan(q(spark, SF))}
    assert with_python == {
        "accents_removed", "provinces_by_department", "blocks_v2", "blocks_v2_rejects", "blocks_v2_broken", "hex_rejects",
        "hex_shapes", "wkb_roundtrip", "point_geometry", "hex_geometry", "json_array_lines",
        "geo_roundtrip", "shape_edges_sql",
    }


def test_shapes_are_decoded_once(spark):
    assert plan(QUERIES["hex_shapes"](spark, SF)).count("ArrowEvalPython [_decode") == 1


def test_parts_of_lots_are_built_after_the_spread_and_without_hexagons(spark):
    text = plan(QUERIES["hex_multi_shapes"](spark, SF))
    assert "Filter (" not in text[text.index("Exchange RoundRobin"):]
    assert "boundary" not in text


def test_edges_come_from_whole_batches(spark):
    text = plan(QUERIES["shape_edges_sql"](spark, SF))
    assert "ArrowEvalPythonUDTF shape_edges" in text
    assert "hashpartitioning" not in text and "Sort" not in text  # neither dealt nor called by lot


def test_totals_read_rows_once_and_keep_their_tasks(spark):
    for name in ("door_totals_rollup", "door_totals_cube"):
        text = plan(QUERIES[name](spark, SF))
        assert len(re.findall(r"ReadSchema: struct<l_orderkey", text)) == 1
        assert len(re.findall(r"REPARTITION_BY_NUM", text)) == 2  # adaptive execution does not merge these
    rows = spark.range(10).selectExpr("id % 2 a", "id v")
    text = plan(totals.totals(rows, ["a"], totals.cube_sets(["a"]), "v", tasks=7))
    assert re.search(r"hashpartitioning\(value#\d+L, 7\)", text)


def test_districts_are_broadcast_and_probed_after_grouping(spark):
    df = QUERIES["street_documents_nested"](spark, SF)
    df.collect()
    final = plan(df).split("== Initial Plan ==")[0]
    join = final.index("BroadcastHashJoin [postcode")
    assert "LeftOuter" in final[join : join + 120]
    assert join < final.index("ObjectHashAggregate")  # parents come first


def test_heavy_path_costs_nothing_without_heavy_keys(spark):
    df = QUERIES["duplicate_split"](spark, SF)
    df.collect()
    final = plan(df).split("== Initial Plan ==")[0]
    assert "Union" not in final and "copies" not in final


def test_fixture_statements_name_their_tables(spark):
    assert fx.duck(fx.DOORS).count("lineitem") == 1
