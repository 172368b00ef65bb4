"""Bronze routing on hand-made payloads."""

import datetime as dt

from pyspark.sql import functions as F

from kpiflow.operators import ingest
from kpiflow.schemas import CLICKS, ENVELOPE, ORDERS

T = dt.datetime(2024, 1, 1, 0, 0, 0)

GOOD = ('{"event_id":"evt_0000000001","event_time":"2024-01-01T00:00:01Z","event_type":"page_view",'
        '"session_id":"sess_0001","user_id":"usr_0001","page_url":"/","channel":"email","device_type":"mobile",'
        '"country_code":"US","schema_version":1}')


def _env(spark, values):
    return spark.createDataFrame([("k", v, T, 0, i) for i, v in enumerate(values)], ENVELOPE)


def test_routes(spark):
    values = [
        GOOD,
        GOOD[:-1],  # truncated
        "",  # blank
        "   ",
        None,
        "[1]",  # valid JSON, not an object
        "123",
        GOOD.replace('"evt_0000000001"', "null"),  # null id
        GOOD.replace("2024-01-01T00:00:01Z", "2024-13-01"),  # bad time (no error under ANSI)
        GOOD.replace('"schema_version":1', '"schema_version":"x"'),  # wrong type
    ]
    routed = ingest.routed(_env(spark, values), CLICKS).orderBy("kafka_offset")
    got = [r.route for r in routed.select("route").collect()]
    assert got == [
        "valid",
        "json_parse_failure",
        "json_parse_failure",
        "json_parse_failure",
        "json_parse_failure",
        "json_parse_failure",
        "json_parse_failure",
        "required_fields_missing",
        "required_fields_missing",
        "type_mismatch",
    ]
    good = routed.filter("route = 'valid'").first()
    assert good.event_time == dt.datetime(2024, 1, 1, 0, 0, 1) and good.schema_version == 1


def test_valid_plus_quarantine_is_raw(spark):
    values = [GOOD, GOOD[:-1], "", GOOD.replace('"evt_0000000001"', "null")]
    routed = ingest.routed(_env(spark, values), CLICKS)
    clock = F.lit(T).cast("timestamp")
    valid = ingest.valid_records(routed, CLICKS, clock)
    quarantine = ingest.quarantine_records(routed, CLICKS, clock)
    assert valid.count() + quarantine.count() == len(values)
    reasons = sorted(r.error_reason for r in quarantine.collect())
    assert reasons == ["json_parse_failure", "json_parse_failure", "required_fields_missing"]
    # Every quarantined row lands in a partition.
    assert quarantine.filter("event_date IS NULL OR event_hour IS NULL").count() == 0


def test_quarantine_union_of_both_topics(spark):
    c = ingest.quarantine_records(ingest.routed(_env(spark, [""]), CLICKS), CLICKS)
    o = ingest.quarantine_records(ingest.routed(_env(spark, ["{"]), ORDERS), ORDERS)
    both = ingest.quarantine_all([c, o])
    assert both.count() == 2 and {"event_id", "order_id", "error_reason"} <= set(both.columns)


def test_json_types_are_strict(spark):
    """A value of another JSON type is a mismatch, never silently converted; white space and repeated keys are no faults."""
    version = '"schema_version":1'
    values = [
        "\n\t " + GOOD,
        GOOD.replace(version, '"schema_version":"x",' + version),  # the last value counts
        GOOD.replace(version, '"schema_version":"1"'),
        GOOD.replace(version, '"schema_version":1.5'),
        GOOD.replace(version, '"schema_version":true'),
        GOOD.replace(version, '"schema_version":3000000000'),
        GOOD.replace('"evt_0000000001"', "17"),
        GOOD.replace('"usr_0001"', '{"a":1}'),
        GOOD.replace('"email"', "[]"),
        GOOD.replace(version, '"schema_version":null'),
    ]
    rows = ingest.routed(_env(spark, values), CLICKS).orderBy("kafka_offset").collect()
    assert [r.route for r in rows] == ["valid"] * 2 + ["type_mismatch"] * 7 + ["valid"]
    assert [r.schema_version for r in rows] == [1, 1, None, None, None, None, 1, 1, 1, None]
    assert rows[6].event_id is None and rows[7].user_id is None and rows[8].channel is None
    strict = ingest.routed(_env(spark, [*values, GOOD.replace("2024-01-01T00:00:01Z", "soon")]), CLICKS, "strict", True).orderBy("kafka_offset")
    assert [r.route for r in strict.collect()] == ["valid"] * 2 + ["type_mismatch"] * 7 + ["required_fields_missing", "type_mismatch"]
    names = strict.select(ingest.missing_fields(CLICKS, "strict").alias("m")).collect()
    assert [list(r.m) for r in names] == [[]] * 9 + [["schema_version"], []]


def test_contract_types_of_text_fields(spark):
    from kpiflow.functions import rules

    parsed = ingest.parse_payload(ingest.project_envelope(_env(spark, [GOOD.replace('"evt_0000000001"', "17").replace('"email"', "{}")])), CLICKS, field_list=True)
    assert list(parsed.select(rules.contract_violations("clickstream").alias("v")).first().v) == ["event_id:type", "channel:type"]
