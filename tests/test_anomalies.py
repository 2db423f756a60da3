"""Anomalies of daily metrics against plain Python, and ranks against a sort."""

from datetime import date, timedelta
from math import floor
from statistics import median

from pyspark.sql import functions as F
import random

from drumlin.operators import anomalies as an

FACT = "device_id string, metric_date date, event_type string, event_count bigint, total_duration_ms bigint"
START = date(2024, 1, 1)
METRICS = ("event_count", "total_duration_ms")


def series(seed):
    """Series with gaps, missing metrics, constant stretches and a few wild days."""
    dice = random.Random(seed)
    rows = []
    for device in ("d1", "d2", None):
        for kind in ("view", "error"):
            for day in range(90):
                if dice.random() < 0.2:
                    continue
                count = 5 if day < 20 else dice.randint(1, 9) * (100 if dice.random() < 0.05 else 1)
                spent = None if dice.random() < 0.1 else dice.randint(0, 3000)
                rows.append((device, START + timedelta(day), kind, count, spent))
    return rows


def expected(rows, days=an.DAYS, least_days=an.LEAST_DAYS):
    found = {}
    for device, day, kind, *values in rows:
        for place, metric in enumerate(METRICS):
            value = values[place]
            before = [
                r[3 + place] for r in rows
                if (r[0], r[2]) == (device, kind) and 1 <= (day - r[1]).days <= days and r[3 + place] is not None
            ]
            if value is None or len(before) < least_days:
                continue
            middle = median(before)
            mad = median(abs(x - middle) for x in before)
            spread = max(4 * mad, floor(2 * middle * 2 * an.LEAST_SHARE), 2)
            size = floor(abs(2 * value - 2 * middle) * 1349.0 / spread) / 1000
            found[device, kind, day, metric] = (value, len(before), middle, mad, size if value >= middle else -size)
    return found


def shown(frame):
    return {(r.device_id, r.event_type, r.metric_date, r.metric): (r.value, r.days, r.median, r.mad, r.score) for r in frame.collect()}


def test_scores_equal_plain_python(spark):
    for seed in range(3):
        rows = series(seed)
        got = shown(an.scores(spark.createDataFrame(rows, FACT), METRICS))
        assert got and got == expected(rows)


def test_a_later_first_day_changes_no_score(spark):
    fact = spark.createDataFrame(series(7), FACT)
    whole = shown(an.scores(fact, METRICS))
    late = shown(an.scores(fact, METRICS, first_day="2024-03-01"))
    assert late and late == {k: v for k, v in whole.items() if k[2] >= date(2024, 3, 1)}


def test_constant_series_and_short_ones(spark):
    flat = [("d", START + timedelta(i), "t", 100, 0) for i in range(10)]
    last = [("d", START + timedelta(10), "t", 90, 0)]
    got = shown(an.scores(spark.createDataFrame(flat + last, FACT), METRICS))
    # No spread at all: five per cent of the median stands for it.
    assert got["d", "t", START + timedelta(10), "event_count"] == (90, 10, 100.0, 0.0, -1.349)
    assert got["d", "t", START + timedelta(10), "total_duration_ms"][4] == 0
    assert min(day for _, _, day, _ in got) == START + timedelta(an.LEAST_DAYS)
    assert an.anomalies(spark.createDataFrame([], FACT), metrics=METRICS).count() == 0


def test_scores_saturate(spark):
    rows = [("d", START + timedelta(i), "t", 1, 1) for i in range(8)] + [("d", START + timedelta(8), "t", 2**40, 1)]
    top = an.anomalies(spark.createDataFrame(rows, FACT), metrics=METRICS).first()
    assert (top.score, top.rank) == (an.LARGEST / 1000, 1)


def test_ranks_equal_a_sort(spark):
    dice = random.Random(5)
    rows = [(dice.choice(["a", "b", None]), i, dice.choice([0.0, 0.001, -3.5, 32.768, 65.536, 1e6, dice.randint(-99999, 99999) / 1000]))
            for i in range(3000)]
    got = an.ranked(spark.createDataFrame(rows, "kind string, id long, score double"), ["kind"]).collect()
    assert len(got) == len(rows)
    for kind in ("a", "b", None):
        sizes = sorted((abs(s) for k, _, s in rows if k == kind), reverse=True)
        first = {}
        for place, size in enumerate(sizes, start=1):
            first.setdefault(size, place)
        assert {r.id: r.rank for r in got if r.kind == kind} == {i: first[abs(s)] for k, i, s in rows if k == kind}


def test_one_window_shuffle_for_all_metrics(spark, folder):
    spark.createDataFrame(series(1), FACT).write.parquet(f"{folder}/fact")
    fact = spark.read.parquet(f"{folder}/fact")
    plan = an.scores(fact, METRICS, first_day="2024-03-01")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Python" not in plan
    assert "GreaterThanOrEqual(metric_date,2024-02-02)" in plan


def test_scores_are_made_once(spark):
    """The ranks read what stands out, not the series; a filter on the score repeats no score."""
    fact = spark.createDataFrame(series(1), FACT)
    found = an.anomalies(fact, 1.5, metrics=METRICS)
    assert "Window [collect_list" not in found._jdf.queryExecution().toString()
    expected_rows = {key: value for key, value in expected(series(1)).items() if abs(value[4]) >= 1.5}
    assert shown(found) == expected_rows
    kept = an.scores(fact, METRICS).where(F.abs("score") >= 1.5)._jdf.queryExecution().optimizedPlan().toString()
    assert kept.index("Filter") < kept.index("Generate") and kept.count("sort_array") == 2
