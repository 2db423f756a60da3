from decimal import Decimal

import pytest

from drumlin.contract import STAGING
from drumlin.functions.payload import NULL
from drumlin.plans.staging import stage
from tests.helpers import AS_OF, raw


def staged(spark, *rows, **options):
    return stage(raw(spark, list(rows)), options.pop("as_of", AS_OF), **options)


def with_payload(spark, payload, **options):
    return staged(spark, ("e", "d", "t", "2024-02-01 00:00:00", payload), **options).first()


def test_columns(spark):
    df = staged(spark, ("e", "d", "t", "2024-02-01 00:00:00", "{}"))
    assert df.schema.simpleString() == STAGING.simpleString()


def test_time_bounds(spark):
    rows = [
        (str(n), "d", "t", moment, "{}")
        for n, moment in enumerate(
            [
                "2023-12-31 23:59:59.999999",
                "2024-01-01 00:00:00",
                "2024-06-01 00:00:00",
                "2024-06-01 00:00:00.000001",
            ]
        )
    ]
    assert sorted(r.event_id for r in staged(spark, *rows).collect()) == ["1", "2"]


def test_required_columns(spark):
    good = ("e", "d", "t", "2024-02-01 00:00:00", "{}")
    holes = [tuple(None if i == hole else v for i, v in enumerate(good)) for hole in range(4)]
    assert staged(spark, good, *holes).count() == 1


@pytest.mark.parametrize("payload", [None, "{}", '{"metric_value": null, "city": null}'])
def test_missing_keys(spark, payload):
    row = with_payload(spark, payload)
    assert (row.city, row.metric_value, row.duration_ms) == (None, None, None)


@pytest.mark.parametrize(
    "text, value",
    [
        ('"1.50"', "1.5"),
        ("1.50", "1.5"),
        ("12345678901234567890.123456789012345678", "12345678901234567890.123456789012345678"),
        ("1e2", "100"),
    ],
)
def test_metric_value(spark, text, value):
    assert with_payload(spark, '{"metric_value": %s}' % text).metric_value == Decimal(value)


@pytest.mark.parametrize("text, value", [('"1500"', 1500), ("1500", 1500), ("1500.0", 1500), ("-1", -1)])
def test_duration(spark, text, value):
    assert with_payload(spark, '{"duration_ms": %s}' % text).duration_ms == value


@pytest.mark.parametrize(
    "payload",
    [
        '{"metric_value": "abc"}',
        '{"metric_value": 123456789012345678901}',
        '{"duration_ms": 1500.5}',
        '{"duration_ms": 2147483648}',
        '{"duration_ms": "1500.0"}',
        '{"duration_ms": ""}',
    ],
)
def test_bad_numbers_stop_the_query(spark, payload):
    with pytest.raises(Exception, match="CAST|VARIANT|cast"):
        with_payload(spark, payload)
    row = with_payload(spark, payload, on_error=NULL)
    assert (row.metric_value, row.duration_ms) == (None, None)


def test_nested_value_is_its_json_text(spark):
    assert with_payload(spark, '{"device_model": {"a": [1]}}').device_model == '{"a":[1]}'
