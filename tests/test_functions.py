"""Unit tests of the column functions on literal rows."""

import math

import pytest
from pyspark.sql import functions as F

from kpiflow.functions import rules
from kpiflow.functions.channel import normalize_channel
from kpiflow.functions.intent import session_intent_score


def _one(spark, rows, schema, expr):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


@pytest.mark.parametrize(
    "referrer,channel,expected",
    [
        ("https://google.com", "social", "social"),  # non-empty channel wins
        ("https://facebook.com/ad", None, "social"),
        ("https://WWW.GOOGLE.com/search", None, "organic"),
        ("https://bing.com", "", "organic"),
        ("https://instagram.com/p", None, "social"),
        ("https://tiktok.com/x", "", "social"),
        ("https://partner.example.com", None, "affiliate"),
        (None, None, "direct"),
        ("", "", "direct"),
    ],
)
def test_normalize_channel(spark, referrer, channel, expected):
    got = _one(spark, [(referrer, channel)], "referrer string, channel string", normalize_channel("referrer", "channel"))
    assert got == [expected]


@pytest.mark.parametrize(
    "event_type,value,expected",
    [
        ("checkout_started", None, 0.9),
        ("checkout_started", 250.0, 1.0),
        ("page_view", 50.0, 0.25),
        ("search", 0.0, 0.25),
        ("add_to_cart", 1000.0, 0.95),
        (None, None, 0.1),
        ("unknown", 10.0, 0.12),
        ("product_view", float("nan"), 0.45),
    ],
)
def test_session_intent_score(spark, event_type, value, expected):
    got = _one(spark, [(event_type, value)], "event_type string, order_value double",
               session_intent_score("event_type", "order_value"))
    assert math.isclose(got[0], expected, abs_tol=1e-12)


def test_intent_grows_with_order_value(spark):
    rows = [("checkout_started", 250.0), ("checkout_started", None)]
    a, b = _one(spark, rows, "event_type string, order_value double", session_intent_score())
    assert a > b


def _flagged(spark, rows):
    schema = "event_id string, event_time string, session_id string, user_id string"
    from kpiflow.operators import ingest

    df = spark.createDataFrame(rows, schema).withColumn("mismatch_bits", F.lit(0).cast("long"))
    return ingest.cast_event_time(df)


def test_null_count_and_validity(spark):
    from kpiflow.operators import ingest
    from kpiflow.schemas import CLICKS

    t = "2024-01-01T00:00:00Z"
    df = _flagged(spark, [("e1", t, "s", "u"), (None, t, "s", "u"), ("e3", None, None, "u"), ("e4", t, "", "u")])
    out = ingest.add_quality_flags(df, CLICKS).collect()
    blank = ingest.add_quality_flags(df, CLICKS, blank_is_null=True).collect()
    assert [r.null_required_columns for r in out] == [0, 1, 2, 0]
    assert [r.is_record_valid for r in out] == [True, False, False, True]
    assert [r.is_record_valid for r in blank] == [True, False, False, False]


def test_missing_fields_lists_null_and_blank(spark):
    from kpiflow.operators import ingest
    from kpiflow.schemas import CLICKS

    df = _flagged(spark, [("a", "soon", "", None), ("a", "", "s", "u")])
    got = [list(r.m) for r in df.select(ingest.missing_fields(CLICKS, "bronze").alias("m")).collect()]
    assert got == [["event_time", "session_id", "user_id"], ["event_time"]]

def test_contract_violations_labels(spark):
    schema = ("order_id string, event_time string, session_id string, user_id string, status string, "
              "payment_method string, currency string, order_value double, items_count int, fraud_score double, "
              "shipping_country string, schema_version int, mismatched_fields array<string>")
    row = ("ord_1", "2024-13-01", "sess_1234", "usr_1234", "lost", "card", "EURO", -1.0, 0, 1.5, None, None,
           ["schema_version"])
    got = spark.createDataFrame([row], schema).select(rules.contract_violations("orders")).first()[0]
    assert got == [
        "schema_version:type", "event_time:format", "order_id:minLength", "status:enum", "currency:maxLength",
        "order_value:minimum", "items_count:minimum", "fraud_score:maximum",
    ]


def test_minute_bounds_and_partition_columns(spark):
    import datetime as dt

    from pyspark.sql import functions as F

    from kpiflow.functions.timecols import add_partition_columns, minute_end, minute_start

    df = spark.createDataFrame([(dt.datetime(2024, 1, 2, 23, 59, 59, 999999),)], "t timestamp")
    r = add_partition_columns(df, "t").select(
        minute_start(F.col("t")).alias("s"), minute_end(F.col("t")).alias("e"), "event_date", "event_hour", "event_minute"
    ).first()
    assert r.s == dt.datetime(2024, 1, 2, 23, 59) and r.e == dt.datetime(2024, 1, 3, 0, 0)
    assert (str(r.event_date), r.event_hour, r.event_minute) == ("2024-01-02", "23", "59")
