from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from drumlin.operators.upsert import IGNORE, NARROW, UPDATE, upsert

COLUMNS = ["device_id", "event_type", "timestamp", "payload", "source_api"]
SCHEMA = "event_id string, " + ", ".join(f"{c} string" for c in COLUMNS)


def merge(spark, target, batch, update, created="new"):
    old = spark.createDataFrame(target, SCHEMA + ", created_at string")
    new = spark.createDataFrame(batch, "seq int, " + SCHEMA)
    defaults = {"created_at": F.lit(created)}
    result = upsert(old, new, key="event_id", update=update, order=["seq"], defaults=defaults)
    assert result.columns == old.columns
    return sorted((tuple(row) for row in result.collect()), key=repr)


def replay(target, batch, update, created="new"):
    """The batch applied row by row."""
    table = {row[0]: dict(zip(COLUMNS + ["created_at"], row[1:])) for row in target}
    for _, key, *values in sorted(batch, key=lambda row: row[0]):
        row = dict(zip(COLUMNS, values))
        if key in table:
            table[key].update({c: row[c] for c in update})
        else:
            table[key] = {**row, "created_at": created}
    return sorted(((k, *row.values()) for k, row in table.items()), key=repr)


OLD = [("a", "d0", "t0", "s0", "p0", "src0", "c0"), ("z", "dz", "tz", "sz", "pz", "srcz", "cz")]


def test_first_and_last_of_a_key(spark):
    batch = [(1, "n", "d1", "t1", "s1", "p1", "src1"), (2, "n", "d2", "t2", "s2", None, "src2")]
    assert merge(spark, OLD, batch, UPDATE)[1] == ("n", "d2", "t2", "s2", None, "src1", "new")
    assert merge(spark, OLD, batch, NARROW)[1] == ("n", "d2", "t1", "s2", None, "src1", "new")
    assert merge(spark, OLD, batch, IGNORE)[1] == ("n", "d1", "t1", "s1", "p1", "src1", "new")


def test_existing_key(spark):
    batch = [(1, "a", "d1", "t1", "s1", "p1", "src1")]
    assert merge(spark, OLD, batch, UPDATE)[0] == ("a", "d1", "t1", "s1", "p1", "src0", "c0")
    assert merge(spark, OLD, batch, NARROW)[0] == ("a", "d1", "t0", "s1", "p1", "src0", "c0")
    assert merge(spark, OLD, batch, IGNORE)[0] == OLD[0]


value = st.sampled_from(["x", "y", None])
key = st.sampled_from("abcde")
line = st.tuples(key, value, value, value, value, value)
cases = st.lists(
    st.tuples(st.lists(line, max_size=4, unique_by=lambda r: r[0]), st.lists(line, max_size=8)),
    min_size=40,
    max_size=60,
)


@settings(
    max_examples=3, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck)
)
@given(cases)
def test_equals_replay(spark, many):
    """Many random tables and batches, kept apart by their keys, in one job per policy."""
    target, batch = [], []
    for number, (old, new) in enumerate(many):
        target += [(f"{number}{row[0]}", *row[1:], "old") for row in old]
        batch += [(i, f"{number}{row[0]}", *row[1:]) for i, row in enumerate(new)]
    target = target or OLD
    for update in (UPDATE, NARROW, IGNORE):
        once = replay(target, batch, update)
        assert merge(spark, target, batch, update) == once
        assert merge(spark, once, batch, update, "later") == replay(once, batch, update, "later")
        if update == UPDATE:  # a batch twice equals once
            assert replay(once, batch, update, "later") == once


def test_hot_key(spark):
    """A third of the batch under one key."""
    batch = spark.range(30000).selectExpr(
        "cast(id as int) seq",
        "if(id % 3 = 0, 'hot', concat('k', id)) event_id",
        *[f"concat('{c}', id) {c}" for c in COLUMNS],
    )
    old = spark.createDataFrame(OLD, SCHEMA + ", created_at string")
    result = upsert(old, batch, key="event_id", update=UPDATE, order=["seq"],
                    defaults={"created_at": F.lit("new")})
    assert result.count() == 20003
    hot = result.filter("event_id = 'hot'").first()
    assert (hot.device_id, hot.source_api) == ("device_id29997", "source_api0")
