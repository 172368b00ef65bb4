"""Fixture counts (FIXTURES.md, sparse profile) and pipeline properties."""

import pytest
from pyspark.sql import functions as F

from kpiflow.operators import attribution, dedupe, drift, ingest, ops, quality
from kpiflow.plans import batch
from kpiflow.schemas import CLICKS
from kpiflow.sources.fixtures import raw_stream_table


@pytest.fixture(scope="module")
def sparse(spark, sf_small):
    return batch.bronze(raw_stream_table(spark, sf_small, "sparse"))


@pytest.fixture(scope="module")
def dense(spark, sf_small):
    return batch.bronze(raw_stream_table(spark, sf_small, "dense"))


def _routes(df):
    return {r.route: r["count"] for r in df.groupBy("route").count().collect()}


def test_fixture_route_counts(sparse):
    assert _routes(sparse.clicks_routed) == {
        "valid": 714, "json_parse_failure": 35, "required_fields_missing": 39, "type_mismatch": 23}
    assert _routes(sparse.orders_routed) == {
        "valid": 189, "json_parse_failure": 7, "required_fields_missing": 6, "type_mismatch": 7}


def test_fixture_silver_counts(sparse):
    s = batch.silver(sparse)
    assert s.count() == 701
    assert s.filter("order_id IS NOT NULL").count() == 9
    assert s.select(F.count_distinct("order_id")).first()[0] == 8
    rev = s.filter("order_status = 'captured'").agg(F.sum("order_value")).first()[0]
    assert round(rev, 2) == 324.97


def test_fixture_channel_mix(sparse):
    c = dedupe.clean_clicks(sparse.clicks)
    got = {r.channel_normalized: r["count"] for r in c.groupBy("channel_normalized").count().collect()}
    assert got == {"affiliate": 83, "direct": 73, "email": 76, "organic": 231, "paid_search": 135, "social": 103}


def test_late_rows_are_the_delayed_ones(sparse):
    a = ops.arrivals(sparse.clicks_routed, sparse.orders_routed)
    flagged = ops.flag_late_rows(a).filter("is_late")
    assert flagged.count() > 0
    # Every late row arrived at least 20 minutes after its event time.
    assert flagged.filter(F.col("kafka_ingest_time") < F.col("event_time") + F.expr("INTERVAL 20 MINUTES")).count() == 0


def test_valid_plus_quarantine_equals_raw(dense):
    raw = dense.clicks_routed.count() + dense.orders_routed.count()
    assert dense.clicks.count() + dense.orders.count() + dense.quarantine.count() == raw


def test_last_touch_revenue_equals_matched_order_revenue(dense):
    clicks, orders = dedupe.clean_clicks(dense.clicks), dedupe.clean_orders(dense.orders)
    lt = attribution.last_touch(clicks, orders)
    assert lt.count() == lt.select("order_id").distinct().count()
    matched = attribution.attribution_projection(attribution.interval_join(clicks, orders, "inner")).select(
        "order_id", "order_value").distinct()
    assert round(lt.agg(F.sum("order_value")).first()[0], 6) == round(matched.agg(F.sum("order_value")).first()[0], 6)


def test_bucketed_interval_join_equals_plain_range_join(dense):
    clicks, orders = dedupe.clean_clicks(dense.clicks), dedupe.clean_orders(dense.orders)
    fast = attribution.session_attribution(clicks, orders).select("event_id", "order_id")
    o = orders.select(F.col("session_id").alias("os"), F.col("user_id").alias("ou"),
                      F.col("event_time").alias("ot"), "order_id")
    cond = ((clicks.session_id == o.os) & (clicks.user_id == o.ou) & (o.ot >= clicks.event_time)
            & (o.ot <= clicks.event_time + F.expr("INTERVAL 45 MINUTES")))
    plain = clicks.join(o, cond, "left").select("event_id", "order_id")
    assert fast.exceptAll(plain).count() == 0 and plain.exceptAll(fast).count() == 0


def test_narrow_join_buckets_give_the_same_pairs(dense):
    from kpiflow.settings import Settings

    clicks, orders = dedupe.clean_clicks(dense.clicks), dedupe.clean_orders(dense.orders)
    wide = attribution.session_attribution(clicks, orders).select("event_id", "order_id")
    narrow = attribution.session_attribution(clicks, orders, Settings(join_bucket_minutes=7)).select(
        "event_id", "order_id")
    assert wide.exceptAll(narrow).count() == 0 and narrow.exceptAll(wide).count() == 0


def test_drift_ratios_sum_to_one(dense):
    d = drift.channel_drift(batch.silver(dense))
    sums = d.groupBy("window_start").agg(F.sum("observed_ratio").alias("s"))
    assert sums.filter(F.abs(F.col("s") - 1.0) > 1e-9).count() == 0


def test_duplicate_count_never_negative(dense):
    q = quality.quality_metrics(ingest.quality_input(dense.clicks_routed, CLICKS), "c", "event_id")
    assert q.filter("duplicate_count < 0").count() == 0
    assert q.filter("duplicate_count > 0").count() > 0  # replays are duplicates


def test_dedupe_plan_limits_groups_before_shuffle(dense):
    plan = dedupe.first_seen(dense.orders, "order_id")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_silver_columns_are_the_attribution_contract(dense):
    s = batch.silver(dense)
    assert s.columns == attribution.ATTRIBUTION_COLUMNS + ["event_date", "event_hour", "event_minute"]


def test_blank_ids_match_nothing(spark):
    """Clicks and orders without a session or user id are never paired, and such clicks stay as unmatched rows."""
    import datetime as dt

    from kpiflow.operators import attribution

    t = dt.datetime(2024, 1, 1)
    c_schema = ", ".join(f"{n} string" for n in attribution.CLICK_SIDE if n not in ("event_time", "channel")) + ", channel_normalized string, event_time timestamp"
    names = [f.split()[0] for f in c_schema.split(", ")]

    def click(i, s, u, m):
        row = {n: None for n in names} | {"event_id": f"e{i}", "session_id": s, "user_id": u, "event_type": "search", "event_time": t + dt.timedelta(minutes=m)}
        return tuple(row[n] for n in names)

    clicks = spark.createDataFrame([click(1, "s", "u", 0), click(2, "s", "u", 3), click(3, "", "u", 0), click(4, "s", "", 0), click(5, "", "", 44)], c_schema)
    o_schema = "order_id string, session_id string, user_id string, event_time timestamp, status string, order_value double, payment_method string"
    orders = spark.createDataFrame([("o1", "s", "u", t + dt.timedelta(minutes=3), "captured", 1.0, "card"), ("o2", "", "u", t + dt.timedelta(minutes=5), "captured", 1.0, "card"),
                                    ("o3", "", "", t + dt.timedelta(minutes=46), "captured", 1.0, "card"), ("o4", "s", "u", t + dt.timedelta(minutes=49), "captured", 1.0, "card")], o_schema)
    got = sorted((r.event_id, r.order_id or "") for r in attribution.session_attribution(clicks, orders).collect())
    assert got == [("e1", "o1"), ("e2", "o1"), ("e3", ""), ("e4", ""), ("e5", "")]
    assert sorted((r.order_id, r.event_id) for r in attribution.last_touch(clicks, orders).collect()) == [("o1", "e2")]


def test_resent_orders_with_another_status(spark):
    """The dedupe comes before the status filter, so the first arrival decides, or with ``latest`` the latest event time."""
    import datetime as dt

    t = dt.datetime(2024, 1, 1)
    rows = [  # order, status, event minute, arrival minute, offset
        ("o1", "authorized", 0, 1, 0), ("o1", "captured", 5, 6, 1), ("o2", "refunded", 0, 1, 2), ("o2", "captured", 3, 4, 3),
        ("o3", "captured", 9, 2, 4), ("o3", "declined", 1, 8, 5), ("o4", "captured", 0, 1, 6), ("o4", "refunded", 2, 3, 7),
    ]
    data = [(o, s, t + dt.timedelta(minutes=e), t + dt.timedelta(minutes=a), 0, f) for o, s, e, a, f in rows]
    orders = spark.createDataFrame(data, "order_id string, status string, event_time timestamp, kafka_ingest_time timestamp, kafka_partition int, kafka_offset bigint")
    got = {k: sorted((r.order_id, r.status) for r in dedupe.clean_orders(orders, k).collect()) for k in ("first", "latest")}
    assert got["first"] == [("o1", "authorized"), ("o3", "captured"), ("o4", "captured")]  # o2 began refunded
    assert got["latest"] == [("o1", "captured"), ("o2", "captured"), ("o3", "captured")]  # o4 ended refunded


def test_hot_sessions_get_narrow_buckets(spark):
    """A session with a third of all clicks: the same pairs, in pieces of a minute; the orders of others are copied as before."""
    from kpiflow.settings import Settings

    base = F.unix_seconds(F.lit("2024-01-01 00:00:00").cast("timestamp"))
    time = lambda step: F.timestamp_seconds(base + F.col("id") * step % 14_400)
    who = F.when(F.col("id") % 3 == 0, F.lit("sess_hot")).otherwise(F.concat(F.lit("sess_"), (F.col("id") % 50).cast("string")))
    common = lambda step: [time(step).alias("event_time"), who.alias("session_id"), F.lit("usr_a").alias("user_id")]
    clicks = spark.range(3000).select(F.concat(F.lit("e"), F.col("id").cast("string")).alias("event_id"), *common(37))
    clicks = clicks.unionByName(clicks.limit(1).withColumn("session_id", F.lit(None).cast("string")).withColumn("event_id", F.lit("none")))
    orders = spark.range(400).select(F.concat(F.lit("o"), F.col("id").cast("string")).alias("order_id"), *common(91), F.lit("captured").alias("status"), F.lit(1.0).alias("order_value"), F.lit("card").alias("payment_method"))
    pairs = lambda s: attribution.interval_join(clicks, orders, settings=s).select("event_id", "order_id")
    plain, hot = pairs(Settings()), pairs(Settings(join_hot_clicks=500))
    assert plain.count() == hot.count() > 5000 and plain.exceptAll(hot).count() == 0
    assert "BroadcastHashJoin" in hot._jdf.queryExecution().executedPlan().toString()
    c, o, width = attribution._bucket_widths(clicks, attribution._order_side(orders), Settings(join_hot_clicks=500))
    copies = {r.o_session_id: r.b for r in o.groupBy("o_session_id").agg(F.max(F.ceil(F.lit(45) / width)).alias("b")).collect()}
    assert copies.pop("sess_hot") == 45 and set(copies.values()) == {1}
    piece = c.groupBy("session_id", attribution._bucket("event_time", width)).count().filter("session_id = 'sess_hot'").agg(F.max("count")).first()[0]
    assert piece <= 10
