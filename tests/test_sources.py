"""S3 JSON-lines scan, C3 table-or-empty, C4 column guard."""

import uuid

from pyspark.sql import functions as F

import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

from kpiflow.operators import ingest, serving
from kpiflow.schemas import CLICKS
from kpiflow.session import checkpoint_root
from kpiflow.sources.files import read_json_lines, table_or_empty


def test_json_lines_skip_blank_and_route(spark, tmp_path):
    good = ('{"event_id":"evt_0000000001","event_time":"2024-01-01T00:00:01Z","event_type":"search",'
            '"session_id":"sess_0001","user_id":"usr_0001","page_url":"/","channel":"email",'
            '"device_type":"mobile","country_code":"US","schema_version":1}')
    path = tmp_path / "clicks.jsonl"
    path.write_text("\n".join([good, "", "   ", good[:-1]]) + "\n")
    env = read_json_lines(spark, str(path))
    assert env.count() == 2
    routes = sorted(r.route for r in ingest.routed(env, CLICKS).collect())
    assert routes == ["json_parse_failure", "valid"]


def test_table_or_empty(spark):
    schema = StructType([StructField("window_end", LongType()), StructField("channel", StringType())])
    missing = f"{checkpoint_root(spark)}/missing-{uuid.uuid4().hex}"
    df = table_or_empty(spark, missing, schema)
    assert df.count() == 0 and df.schema == schema


def test_require_columns(spark):
    df = spark.createDataFrame([(1,)], "channel int")
    with pytest.raises(ValueError, match="gross_revenue"):
        serving.revenue_by_channel(df)


def test_cli_query_writes_parquet(spark, sf_small):
    from kpiflow.__main__ import main

    out = f"{checkpoint_root(spark)}/cli-{uuid.uuid4().hex[:8]}"
    assert main(["query", "channel_normalized", "--sf-dir", sf_small, "--out", out], spark=spark) == 0
    assert spark.read.parquet(out).count() == 6
    with pytest.raises(SystemExit):
        main(["query", "no_such_query", "--sf-dir", sf_small, "--out", out], spark=spark)


def test_high_watermark_marks_idle_minutes(spark):
    """O3 on a hand case: partition 0 gets offsets 0-1 at 00:00, partition 1
    offset 0 at 00:00 and 1 at 00:02; 00:01 is idle."""
    import datetime as dt

    from kpiflow.operators.ops import ARRIVAL_COLUMNS, high_watermark

    t = dt.datetime(2024, 1, 1)
    rows = [("orders", t, 0, 0), ("orders", t + dt.timedelta(seconds=5), 0, 1), ("orders", t, 1, 0),
            ("orders", t + dt.timedelta(minutes=2), 1, 1)]
    arr = spark.createDataFrame(rows, "source_name string, kafka_ingest_time timestamp, kafka_partition int, kafka_offset long")
    for c in ARRIVAL_COLUMNS:
        if c not in arr.columns:
            arr = arr.withColumn(c, F.lit(None).cast("string"))
    got = [(r.high_watermark, r.new_offsets, r.is_active)
           for r in high_watermark(arr).orderBy("snapshot_minute").collect()]
    assert got == [(3, 3, True), (3, 0, False), (4, 1, True)]


def test_json_texts_are_made_behind_the_shuffle_of_the_offsets(spark, sf_small):
    """The landing table's windows sort bare events; the JSON text of a row is never shuffled."""
    from kpiflow.sources import fixtures

    for profile in fixtures.PROFILES:
        plan = fixtures.envelope(fixtures.load_events(spark, sf_small), profile)._jdf.queryExecution().optimizedPlan().toString().splitlines()
        texts = [i for i, line in enumerate(plan) if "StructsToJson" in line or "to_json(" in line]
        windows = [i for i, line in enumerate(plan) if "Window [" in line]
        assert texts and windows and max(texts) < min(windows)
