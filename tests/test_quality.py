import pytest

from drumlin.operators import quality as Q


def table(spark, column, values):
    return spark.createDataFrame([(v,) for v in values], f"{column} string")


def outcome(spark, df, rule):
    (row,) = Q.evaluate({rule.model: df}, [rule]).collect()
    return row.failures, row.passed


@pytest.mark.parametrize("values, failures", [(["a", "b"], 0), (["a", None, None], 2), ([], 0)])
def test_not_null(spark, values, failures):
    rule = Q.Rule("m", "c", "not_null")
    assert outcome(spark, table(spark, "c", values), rule) == (failures, failures == 0)


@pytest.mark.parametrize("values, failures", [(["a", "b", None, None], 0), ([*"aaabbc", None, None], 2)])
def test_unique(spark, values, failures):
    rule = Q.Rule("m", "c", "unique")
    assert outcome(spark, table(spark, "c", values), rule) == (failures, failures == 0)


@pytest.mark.parametrize(
    "values, failures", [(["page_view", None], 0), (["page_view", "signup", "signup", None], 1)]
)
def test_accepted_values(spark, values, failures):
    rule = Q.Rule("m", "c", "accepted_values", Q.EVENT_TYPES)
    assert outcome(spark, table(spark, "c", values), rule) == (failures, failures == 0)


def test_relationships(spark):
    child = table(spark, "device_id", ["a", "b", "b", None])
    parent = table(spark, "device_id", ["a", "a"])
    rule = Q.Rule("fact", "device_id", "relationships", parent="dim")
    (row,) = Q.evaluate({"fact": child, "dim": parent}, [rule]).collect()
    assert (row.failures, row.passed) == (2, False)
    (row,) = Q.evaluate({"fact": child, "dim": child}, [rule]).collect()
    assert (row.failures, row.passed) == (0, True)


def test_suite_size():
    assert len(Q.RULES) == 12
    with pytest.raises(KeyError):
        Q.evaluate({}, Q.RULES)


def test_unknown_kind(spark):
    with pytest.raises(ValueError):
        Q.evaluate({"m": table(spark, "c", [])}, [Q.Rule("m", "c", "other")])
