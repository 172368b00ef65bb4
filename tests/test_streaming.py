"""Streaming: hand case, stream == batch, replay idempotence."""

import datetime as dt
import json
import os
import uuid

from pyspark.sql import functions as F

from kpiflow.operators import kpis
from kpiflow.plans import batch
from kpiflow.plans.catalog import PROFILE
from kpiflow.schemas import ENVELOPE
from kpiflow.session import checkpoint_root
from kpiflow.sources.fixtures import raw_stream_table
from kpiflow.streaming import jobs, replay
from kpiflow.streaming.sinks import append_sink

BASE = dt.datetime(2024, 1, 1, 0, 0, 0)


def _click(eid, minutes, session="sess_aaaa", user="usr_aaaa"):
    t = BASE + dt.timedelta(minutes=minutes)
    return json.dumps({"event_id": eid, "event_time": t.strftime("%Y-%m-%dT%H:%M:%SZ"), "event_type": "page_view",
                       "session_id": session, "user_id": user, "page_url": "/", "channel": "email",
                       "device_type": "mobile", "country_code": "US", "schema_version": 1}), t


def _order(oid, minutes, session="sess_aaaa", user="usr_aaaa"):
    t = BASE + dt.timedelta(minutes=minutes)
    return json.dumps({"order_id": oid, "event_time": t.strftime("%Y-%m-%dT%H:%M:%SZ"), "session_id": session,
                       "user_id": user, "status": "captured", "payment_method": "card", "currency": "USD",
                       "order_value": 10.0, "items_count": 1, "fraud_score": 0.1, "schema_version": 1}), t


def _write(spark, rows, path):
    spark.createDataFrame(rows, ENVELOPE).coalesce(1).write.mode("overwrite").parquet(path)


def test_hand_case_silver(spark):
    """FIXTURES.md section 3: e1 twice, e2 at 00:00, e3 00:01:50, e4 03:00, e5 06:00,
    e6 09:00; o1 00:05 (e1, e2), o2 03:05 (e4), o3 06:05 (no session), o4 09:05 (e6)."""
    root = f"{checkpoint_root(spark)}/test-hand-{uuid.uuid4().hex[:8]}"
    clicks = [_click("evt_000000001", 0), _click("evt_000000001", 0), _click("evt_000000002", 0),
              _click("evt_000000003", 1 + 50 / 60, session="sess_bbbb"), _click("evt_000000004", 180),
              _click("evt_000000005", 360, session="sess_cccc"), _click("evt_000000006", 540),
              _click("evt_sentinel_", 60 * 48, session="sess_zzzz")]
    orders = [_order("ord_000000001", 5), _order("ord_000000002", 185), _order("ord_000000003", 365, session="sess_none"),
              _order("ord_000000004", 545), _order("ord_sentinel_", 60 * 48, session="sess_zzzz")]
    _write(spark, [("k", v, t, 0, i) for i, (v, t) in enumerate(clicks)], f"{root}/in_clicks")
    _write(spark, [("k", v, t, 0, i) for i, (v, t) in enumerate(orders)], f"{root}/in_orders")
    paths = jobs.Paths(root)
    c_raw = spark.readStream.schema(ENVELOPE).parquet(f"{root}/in_clicks")
    o_raw = spark.readStream.schema(ENVELOPE).parquet(f"{root}/in_orders")
    jobs.supervise(spark, jobs.bronze_queries(c_raw, o_raw, paths, replay.AVAILABLE_NOW))
    from kpiflow.schemas import CLICKS, ORDERS
    from kpiflow.sources.files import read_table_stream

    bc = read_table_stream(spark, paths.table("bronze_clickstream"), replay.bronze_schema(spark, CLICKS))
    bo = read_table_stream(spark, paths.table("bronze_orders"), replay.bronze_schema(spark, ORDERS))
    silver = jobs.silver_stream(bc, bo)
    out = paths.table("silver")
    jobs.supervise(spark, [append_sink(silver, out, paths.checkpoint("silver"), None, replay.AVAILABLE_NOW)])
    got = {(r.event_id, r.order_id) for r in spark.read.parquet(out).filter("event_id <> 'evt_sentinel_'").collect()}
    assert got == {
        ("evt_000000001", "ord_000000001"),
        ("evt_000000002", "ord_000000001"),
        ("evt_000000003", None),
        ("evt_000000004", "ord_000000002"),
        ("evt_000000005", None),
        ("evt_000000006", "ord_000000004"),
    }


def _kpi_cols(df, distincts=True):
    cols = ["window_start", "channel", "device_type", "country_code", "events_total", "cart_adds",
            F.round("gross_revenue", 6).alias("r"), F.round("avg_session_intent", 6).alias("i")]
    if distincts:
        cols += ["sessions_total", "orders_total"]
    return df.select(*cols)


def test_final_path_equals_batch(spark, sf_small):
    """Every non-distinct column equal; HLL distincts within tolerance."""
    batch_kpis = kpis.realtime_kpis(batch.silver(batch.bronze(raw_stream_table(spark, sf_small, PROFILE))))
    final = replay.replay_final(spark, sf_small, PROFILE)
    assert _kpi_cols(final, False).exceptAll(_kpi_cols(batch_kpis, False)).count() == 0
    assert _kpi_cols(batch_kpis, False).exceptAll(_kpi_cols(final, False)).count() == 0
    keys = ["window_start", "channel", "device_type", "country_code"]
    both = final.alias("f").join(batch_kpis.alias("b"), keys)
    off = both.filter(
        (F.abs(F.col("f.sessions_total") - F.col("b.sessions_total")) > F.greatest(F.lit(1), 0.15 * F.col("b.sessions_total")))
        | (F.abs(F.col("f.orders_total") - F.col("b.orders_total")) > F.greatest(F.lit(1), 0.15 * F.col("b.orders_total")))
    )
    assert off.count() == 0


def test_live_path_spans_days(spark, sf_small):
    """Five days of the sparse profile, 720 slots, in one micro-batch: every KPI equals batch, and rows that come again change nothing."""
    from kpiflow.sources.fixtures import envelope_path

    env = f"{checkpoint_root(spark)}/test-days-{uuid.uuid4().hex[:8]}"
    spark.read.parquet(envelope_path(spark, sf_small, "sparse")).filter("timestamp < '2024-01-06'").write.partitionBy("source_name").parquet(env)
    batch_kpis = kpis.realtime_kpis(batch.silver(batch.bronze(spark.read.parquet(env))))
    ws = replay.replay_live(spark, env)
    live = replay.live_table(spark, ws, "realtime_kpis")
    assert live.select(F.to_date("window_start")).distinct().count() == 5
    assert _kpi_cols(live).exceptAll(_kpi_cols(batch_kpis)).count() == 0
    assert _kpi_cols(batch_kpis).exceptAll(_kpi_cols(live)).count() == 0

    tables = ("realtime_kpis", "campaign_sliding", "silver_session_attribution")
    first = {t: sorted(map(repr, replay.live_table(spark, ws, t).collect())) for t in tables}
    from kpiflow.schemas import CLICKS, ORDERS

    some = [spark.read.schema(replay.bronze_schema(spark, e)).parquet(ws.table(t)).orderBy("event_time").limit(10) for e, t in ((CLICKS, "bronze_clickstream"), (ORDERS, "bronze_orders"))]
    for batch_id in (0, 1):  # a micro-batch that runs again after a crash, and the same rows once more in a later one
        jobs.live_batch_writer(spark, ws)(jobs.id_ledger(*some), batch_id)
    for t, rows in first.items():
        assert rows == sorted(map(repr, replay.live_table(spark, ws, t).collect())), t
    # NULL campaign keys (direct traffic) do not multiply on replay.
    camp = replay.live_table(spark, ws, "campaign_sliding")
    keys = ["window_start", "campaign_id", "channel"]
    assert camp.filter("campaign_id IS NULL").count() > 0
    assert camp.count() == camp.select(*keys).distinct().count()


def test_late_rows_reach_live_gold(spark):
    """Five micro-batches in order of arrival; a click 110 minutes late and an order for an old click get into gold."""
    root = f"{checkpoint_root(spark)}/test-live-late-{uuid.uuid4().hex[:8]}"
    paths = jobs.Paths(root)
    clicks = [[_click("evt_000000001", 0)], [_click("evt_000000002", 60)], [_click("evt_000000003", 120)],
              [_click("evt_000000004", 10)], [_click("evt_000000005", 121)]]
    orders = [[_order("ord_000000001", 5)], [], [], [], [_order("ord_000000002", 30)]]
    for i, (c, o) in enumerate(zip(clicks, orders)):
        for name, rows in (("clicks", c), ("orders", o)):
            if rows:
                _write(spark, [("k", v, BASE + dt.timedelta(minutes=130 + i), 0, i) for v, _ in rows], f"{root}/in_{name}/part={i}")

    def raw(name):
        return spark.readStream.schema(ENVELOPE).option("maxFilesPerTrigger", "1").option("recursiveFileLookup", "true").parquet(f"{root}/in_{name}")

    jobs.supervise(spark, jobs.bronze_queries(raw("clicks"), raw("orders"), paths, replay.AVAILABLE_NOW, sinks=("valid",)))
    streams = replay._bronze_streams(spark, paths, 1)
    jobs.supervise(spark, [jobs.live_query(*streams, spark, paths, replay.AVAILABLE_NOW)])
    gold = replay.live_table(spark, paths, "realtime_kpis")
    got = {(r.window_start - BASE).seconds // 60: (r.events_total, r.orders_total) for r in gold.collect()}
    # the order at 00:05 belongs to the click at 00:00, the one at 00:30 to the clicks at 00:00 and 00:10
    assert got == {0: (2, 2), 10: (1, 1), 60: (1, 0), 120: (1, 0), 121: (1, 0)}


def test_streaming_drops_exactly_the_audited_late_rows(spark, sf_small):
    """Arrival-ordered micro-batches (one arrival hour per file): the stateful
    silver stream drops only clicks that the late-row audit flags, never an
    on-time one, and it does drop late ones (M6/M11). The audit compares with
    every earlier arrival; Spark filters late rows with the previous batch's
    watermark when operators are chained, so the audit is an upper bound."""
    from kpiflow.operators import ingest, ops
    from kpiflow.schemas import CLICKS
    from kpiflow.sources.fixtures import envelope_path

    root = f"{checkpoint_root(spark)}/test-late-{uuid.uuid4().hex[:8]}"
    env = spark.read.parquet(envelope_path(spark, sf_small, PROFILE))
    hour = F.date_trunc("hour", F.col("timestamp"))
    hours = sorted(r[0] for r in env.select(hour.alias("h")).distinct().collect())  # test-side chunking
    cols = ["key", "value", "timestamp", "partition", "offset"]
    for i, h in enumerate(hours):
        for src in ("clickstream", "orders"):
            chunk = env.filter((hour == F.lit(h)) & (F.col("source_name") == src)).select(*cols)
            chunk.coalesce(1).write.mode("overwrite").parquet(f"{root}/{src}/chunk={i:03d}")
    last = env.agg(F.max("timestamp").alias("t")).first()[0] + dt.timedelta(days=1)
    sentinel = [(_click("evt_sentinel_", 0, session="sess_zzzz")[0].replace("2024-01-01T00:00:00Z", last.strftime("%Y-%m-%dT%H:%M:%SZ")), last),]
    order = [(_order("ord_sentinel_", 0, session="sess_zzzz")[0].replace("2024-01-01T00:00:00Z", last.strftime("%Y-%m-%dT%H:%M:%SZ")), last)]
    _write(spark, [("k", v, t, 0, 0) for v, t in sentinel], f"{root}/clickstream/chunk=999")
    _write(spark, [("k", v, t, 0, 0) for v, t in order], f"{root}/orders/chunk=999")

    def stream(src):
        return (spark.readStream.schema(ENVELOPE).option("maxFilesPerTrigger", "1")
                .option("recursiveFileLookup", "true").parquet(f"{root}/{src}"))

    from kpiflow.schemas import ORDERS

    bc = ingest.valid_records(ingest.routed(stream("clickstream"), CLICKS), CLICKS)
    bo = ingest.valid_records(ingest.routed(stream("orders"), ORDERS), ORDERS)
    out = f"{root}/silver"
    q = append_sink(jobs.silver_stream(bc, bo), out, f"{root}/ckpt", None, replay.AVAILABLE_NOW)
    jobs.supervise(spark, [q])
    streamed = {r[0] for r in spark.read.parquet(out).select("event_id").distinct().collect()} - {"evt_sentinel_"}

    b = batch.bronze(raw_stream_table(spark, sf_small, PROFILE))
    batch_ids = {r[0] for r in batch.silver(b).select("event_id").distinct().collect()}
    audited = ops.flag_late_rows(b.clicks_routed).filter("is_late AND route = 'valid'")
    late_ids = {r[0] for r in audited.select("event_id").distinct().collect()}
    assert late_ids, "the fixture has late rows"
    dropped = batch_ids - streamed
    assert streamed <= batch_ids
    assert dropped, "late rows were dropped by the stream"
    assert dropped <= late_ids


def test_live_path_reads_touched_hours_only(spark, tmp_path):
    rows = [(i, BASE + dt.timedelta(minutes=7 * i)) for i in range(2000)]
    table = spark.createDataFrame(rows, "event_id int, event_time timestamp")
    table = table.withColumn("event_date", F.to_date("event_time")).withColumn("event_hour", F.date_format("event_time", "HH"))
    table.write.partitionBy(*jobs.PARTITIONS).parquet(str(tmp_path / "t"))
    slots = spark.createDataFrame([(BASE + dt.timedelta(hours=30),)], "slot timestamp").distinct().persist()
    found = jobs._in_slots(spark.read.parquet(str(tmp_path / "t")), slots, 10)
    assert "dynamicpruning" in found._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.event_id for r in found.collect()) == [i for i, t in rows if dt.timedelta(hours=30) <= t - BASE < dt.timedelta(hours=30, minutes=10)]


def test_progress_log(spark):
    import time

    from kpiflow.streaming.monitor import ProgressLog

    root = f"{checkpoint_root(spark)}/test-progress-{uuid.uuid4().hex[:8]}"
    _write(spark, [("k", "{}", BASE, 0, i) for i in range(3)], f"{root}/in")
    log = ProgressLog()
    spark.streams.addListener(log)
    try:
        src = spark.readStream.schema(ENVELOPE).parquet(f"{root}/in")
        jobs.supervise(spark, [append_sink(src, f"{root}/out", f"{root}/ckpt", None, replay.AVAILABLE_NOW, query_name="copy")])
        for _ in range(50):
            if any(r[3] for r in log.rows):
                break
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(log)
    rows = log.frame(spark).filter("input_rows > 0").collect()
    assert [(r["query"], r.input_rows) for r in rows] == [("copy", 3)] and not log.failures


def test_supervise_surfaces_a_failing_query(spark):
    """One failing query stops the wait with its error."""
    import pytest

    root = f"{checkpoint_root(spark)}/test-fail-{uuid.uuid4().hex[:8]}"
    _write(spark, [("k", "{}", BASE, 0, 0)], f"{root}/in")
    src = spark.readStream.schema(ENVELOPE).parquet(f"{root}/in")

    def boom(df, batch_id):
        raise ValueError("sink failure")

    bad = src.writeStream.foreachBatch(boom).option("checkpointLocation", f"{root}/ckpt").trigger(availableNow=True).start()
    with pytest.raises(RuntimeError, match="failed"):
        jobs.supervise(spark, [bad])


def test_job_entry_points_run_end_to_end(spark, sf_small):
    """start_bronze (envelope streams) then start_silver_gold (live + final)."""
    import pytest

    from kpiflow.sources.files import envelope_stream
    from kpiflow.sources.fixtures import envelope_path
    from kpiflow.streaming import apps

    env = envelope_path(spark, sf_small, PROFILE)
    paths = replay.workspace(spark, "apps")
    with pytest.raises(ValueError):
        apps.start_bronze(spark, paths)
    jobs.supervise(spark, apps.start_bronze(
        spark, paths, clicks_raw=envelope_stream(spark, env, "clickstream"),
        orders_raw=envelope_stream(spark, env, "orders"), trigger=replay.AVAILABLE_NOW))
    for table in ("bronze_clickstream", "bronze_orders", "quarantine", "quality_clickstream", "quality_orders"):
        assert spark.read.parquet(paths.table(table)).count() > 0, table
    jobs.supervise(spark, apps.start_silver_gold(spark, paths, live=True, final=True, trigger=replay.AVAILABLE_NOW))
    for table in ("silver_session_attribution", "realtime_kpis", "campaign_sliding", "quality_alerts", "drift_metrics",
                  "realtime_kpis_final"):
        assert spark.read.parquet(paths.table(table)).count() > 0, table


def test_dedupe_replay_hands_over_an_hour_at_a_time_in_several_files(spark, monkeypatch):
    """An hour is one micro-batch however many files it has; the landing table is written anew by all tasks, once."""
    root = f"{checkpoint_root(spark)}/test-dedupe-{uuid.uuid4().hex[:8]}"
    rows = []
    for i in range(3000):
        value, t = _click(f"evt_{i % 2500:09d}", (i % 2) * 60 + i % 50)
        rows.append((f"k{i}", value, t + dt.timedelta(minutes=120 if i >= 2500 else 0), 0, i, "clickstream"))
    df = spark.createDataFrame(rows, [*ENVELOPE.names, "source_name"])
    df = df.withColumn("partition", F.col("partition").cast("int")).repartition(8)
    df.write.partitionBy("source_name").parquet(f"{root}/landing")
    monkeypatch.setattr(replay, "workspace", lambda *_: jobs.Paths(root))
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.shuffle.partitions")}
    for k, v in zip(before, ("16k", "2")):
        spark.conf.set(k, v)
    try:
        out = replay.replay_dedupe(spark, f"{root}/landing")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sorted(r.event_id for r in out.select("event_id").collect()) == [f"evt_{i:09d}" for i in range(2500)]
    # ids that came again two hours later keep the row that arrived first
    assert out.filter(F.col("kafka_offset") >= 2500).count() == 0
    chunks = sorted(d for d in os.listdir(f"{root}/arrivals") if d.startswith("chunk="))
    files = [sum(f.endswith(".parquet") for f in os.listdir(f"{root}/arrivals/{c}")) for c in chunks]
    assert len(chunks) == 4 and max(files) > 1
    assert sorted(c for c in os.listdir(f"{root}/checkpoints/clean_clicks/commits") if c.isdigit()) == ["0", "1", "2", "3"]


def test_late_rows_parse_each_payload_once(spark, sf_small):
    """The audit reads its shuffled rows again, not the input."""
    from kpiflow.operators import ops
    from kpiflow.schemas import CLICKS, ORDERS

    env = raw_stream_table(spark, sf_small, PROFILE)
    late = ops.late_rows(ops.arrivals(*[batch.routed_topic(env, e) for e in (CLICKS, ORDERS)]))
    rows = {r.source_name: r.rows_checked for r in late.collect()}
    assert set(rows) == {"clickstream", "orders"} and min(rows.values()) > 0
    final = late._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("FileScan parquet") == 2 and "ReusedExchange" in final
