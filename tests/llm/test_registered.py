"""Registered queries against their SQL on the whole of the smallest tables."""

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries
from drumlin.llm.queries import ORACLE, QUERIES
from tests import compare

SF_DIR = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def test_all_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(queries()) and set(ORACLE) <= set(oracle_sql())
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_agrees_with_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF_DIR}/{t}.parquet'")
    relation = con.execute(ORACLE[name])
    names = [d[0] for d in relation.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    want = [tuple(row[i] for i in order) for row in relation.fetchall()]
    got_names, got = compare.spark_rows(QUERIES[name](spark, SF_DIR))
    assert got_names == sorted(names) and got
    assert compare.normal(got) == compare.normal(want)
