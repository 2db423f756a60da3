"""Tokens against Python's HMAC, and the masked fact against a plain loop over levels."""

import hashlib
import hmac
import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from drumlin.functions import masking
from drumlin.plans import masked

SECRET = b"a secret of the tests"
EVENTS = """user_id string, event_timestamp string, event_type string, device_model string, os_version string,
    country string, duration_ms int, metric_value decimal(38,18)"""


@pytest.mark.parametrize("secret", [SECRET, b"x" * 64, b"y" * 200])
def test_tokens_are_hmac(spark, secret):
    ids = ["user_1", "", "ünï", None, "x" * 5000]
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(ids)], "n int, user_id string")
    got = masking.masked(rows, masking.keys(spark, secret), {"user_id": "user"}).orderBy("n").collect()
    for row, value in zip(got, ids, strict=True):
        whole = None if value is None else hmac.new(secret, b"user\0" + value.encode(), hashlib.sha256).hexdigest()
        assert row.user_id == (whole and whole[: masking.DIGITS])


def test_kinds_and_keys_differ(spark):
    rows = spark.createDataFrame([("1", "1", "1")], "a string, b string, c string")
    one, other = masking.keys(spark, b"one"), masking.keys(spark, b"other")
    row = masking.masked(masking.masked(rows, one, {"a": "user", "b": "device"}), other, {"c": "user"}).first()
    assert len({row.a, row.b, row.c}) == 3
    with pytest.raises(ValueError, match="empty"):
        masking.keys(spark, b"")


def test_the_secret_is_in_no_plan(spark):
    rows = masking.masked(spark.range(3), masking.keys(spark, SECRET), {"id": "user"})
    rows.collect()
    said = rows._jdf.queryExecution().toString() + rows._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("extended")
    )
    pads = [bytes(x ^ pad for x in SECRET) for pad in (0x36, 0x5C)]
    assert not any(form in said.lower() for x in (SECRET, *pads) for form in (x.decode("latin1").lower(), x.hex()))
    assert "Python" not in said


def events(seed, rows=600):
    dice = random.Random(seed)
    pick = dice.choice
    return [
        (pick([None, *[f"u{i}" for i in range(12)]]), f"2024-02-0{pick([1, 1, 1, 2, 3])} 10:00:00",
         pick(["view", "view", "view", "error"]), pick(["m1", "m2", None]), pick(["o1", "o2"]), pick(["c1", "c2", "c3", None]),
         pick([None, dice.randint(0, 99)]), None)
        for _ in range(rows)
    ] + [("u1", "2024-02-05 00:00:00", "view", "m1", "o1", "c1", 5, None)]


def expected(rows, k):
    names = ("metric_date", "event_type", "device_model", "os_version", "country")
    left = [dict(zip(names, (r[1][:10], *r[2:6]), strict=True)) | {"user": r[0], "ms": r[6]} for r in rows]
    found = []
    for level, by in enumerate(masked.LEVELS):
        groups = {}
        for row in left:
            groups.setdefault(tuple(row[c] for c in by), []).append(row)
        left = []
        for group, members in groups.items():
            users = {m["user"] for m in members} - {None}
            if len(users) < k:
                left += members
                continue
            spent = [m["ms"] for m in members if m["ms"] is not None]
            shown = dict(zip(by, group, strict=True))
            found.append((level, *[shown.get(c) for c in names], len(users), len(members), sum(spent) if spent else None))
    days = {}
    for row in left:
        days[row["metric_date"]] = days.get(row["metric_date"], 0) + 1
    return found + [(len(masked.LEVELS), day, None, None, None, None, None, n, None) for day, n in days.items()]


def staged(spark, rows):
    return spark.createDataFrame(rows, EVENTS).withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp"))


@pytest.mark.parametrize("k", [1, 4, 9, 13])
def test_masked_fact_equals_a_plain_loop(spark, folder, k):
    rows = events(k)
    got = masked.masked_fact(staged(spark, rows), folder, k).collect()
    plain = [(r.level, str(r.metric_date), *r[2:9]) for r in got]
    assert sorted(plain, key=repr) == sorted(expected(rows, k), key=repr)
    assert sum(r.event_count for r in got) == len(rows)
    assert all(r.users is None if r.level == len(masked.LEVELS) else r.users >= k for r in got)
    assert any(r.level == len(masked.LEVELS) and r.metric_date == date(2024, 2, 5) for r in got) == (k > 1)


def test_small_groups(spark):
    rows = spark.createDataFrame([("a", "u1"), ("a", "u1"), ("a", None), ("b", "u1"), ("b", "u2"), (None, None)], "g string, user_id string")
    got = {(r.g, r.users) for r in masked.small_groups(rows, ["g"], 2).collect()}
    assert got == {("a", 1), (None, 0)}


def test_no_events(spark, folder):
    assert masked.masked_fact(staged(spark, []), folder).count() == 0
