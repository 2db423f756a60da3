"""Keys of payloads, their types and days, and drift against a contract."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from drumlin.operators import payload_schema as ps

ROWS = "timestamp string, text string"


def raw(spark, *rows):
    return spark.createDataFrame(list(rows), ROWS).selectExpr("cast(timestamp as timestamp) as timestamp", "parse_json(text) as payload")


def found(frame):
    return {r.path: r for r in frame.collect()}


def test_types_counts_and_days(spark):
    got = found(ps.payload_schema(raw(
        spark,
        ("2024-02-01", '{"a": 1, "b": "x", "c": null, "m": 1, "deep": {"x": {"y": {"z": 1}}}, "list": [1, "a"]}'),
        ("2024-02-03", '{"a": 2.5, "c": null, "m": "t", "deep": {"x": 5}}'),
        ("2024-02-02", '{"a": 1e300, "b": null, "t": true}'),
        (None, '{"a": 7}'),
        ("2024-02-09", None),
        ("2024-02-09", '[1, 2]'),
        ("2024-02-09", '{}'),
        ("2024-02-09", 'null'),
    )))
    types = {"a": "double", "b": "text", "c": "null", "m": "mixed", "deep": "object", "deep.x": "mixed", "deep.x.y": "object",
             "list": "array", "t": "boolean"}
    assert {p: r.type for p, r in got.items()} == types
    a, b = got["a"], got["b"]
    assert (a.present, a.nulls, a.share, a.first_day, a.last_day) == (4, 0, 0.5, date(2024, 2, 1), date(2024, 2, 3))
    assert (b.present, b.nulls) == (2, 1) and got["c"].nulls == got["c"].present == 2


def test_depth_and_empty(spark):
    rows = raw(spark, ("2024-02-01", '{"a": {"b": {"c": 1}}}'))
    assert set(found(ps.payload_schema(rows, depth=1))) == {"a"}
    assert set(found(ps.payload_schema(rows, depth=2))) == {"a", "a.b"}
    assert ps.payload_schema(rows.limit(0)).count() == 0


@pytest.mark.parametrize(("kinds", "want"), [
    (["integer", "null"], "integer"), (["decimal", "integer"], "decimal"), (["double", "integer"], "double"),
    (["integer", "text"], "mixed"), (["null"], "null"), (["array", "object"], "mixed"),
])
def test_merging(spark, kinds, want):
    assert spark.createDataFrame([(kinds,)], "k array<string>").select(ps.merged(F.col("k"))).first()[0] == want


def test_drift(spark):
    schema = ps.payload_schema(raw(spark, ("2024-02-01", '{"w": 1.5, "n": 1, "t": 5, "s": "x", "z": null, "extra": {"k": 1}}')))
    want = {"w": "integer", "n": "decimal", "t": "text", "s": "text", "z": "text", "gone": "text"}
    got = {r.path: r.status for r in ps.drift(schema, want).collect()}
    assert got == {"w": ps.WIDENED, "n": ps.NARROWED, "t": ps.CHANGED, "s": ps.SAME, "z": ps.SAME, "gone": ps.MISSING,
                   "extra": ps.NEW, "extra.k": ps.NEW}


def test_one_pass_over_the_payload(spark):
    plan = ps.payload_schema(raw(spark, ("2024-02-01", "{}")))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Generate explode") == 1 and "Python" not in plan
