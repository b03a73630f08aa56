"""Queries that SQL can express, on the smallest tables, on a table of hard cases and on empty tables."""

import pytest

from addrspark.llm.oracle import ORACLE
from addrspark.llm.queries import QUERIES
from brute import edge_tables, rows_of, write_tables
from compare import duck


@pytest.fixture(scope="module")
def folders(tmp_path_factory):
    return {
        "sf0.001": "/root/testdata/sf0.001",
        "edges": edge_tables(tmp_path_factory.mktemp("edges")),
        "empty": write_tables(tmp_path_factory.mktemp("empty"), {}),
    }


@pytest.mark.parametrize("where", ["sf0.001", "edges", "empty"])
@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, folders, name, where):
    got = QUERIES[name](spark, folders[where])
    result = duck(folders[where]).execute(ORACLE[name])
    columns = [d[0] for d in result.description]
    assert sorted(got.columns) == sorted(columns)
    want = sorted(map(repr, ({c: v for c, v in sorted(zip(columns, r, strict=True))} for r in result.fetchall())))
    assert rows_of(got) == want


def test_every_operator_is_registered():
    assert [sum(n.startswith(f"op{k}_") for n in QUERIES) for k in range(1, 14)] == [1] * 13
