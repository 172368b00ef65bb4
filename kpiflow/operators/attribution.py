"""J1/J2 interval join and attribution projection, J3 unbounded per-click
match totals, J5 last-touch attribution.

Batch interval join: the equi-keys (session_id, user_id) are widened with a
time bucket of width B (default: the horizon H). An order at time t can only
match clicks in its own bucket or the ceil(H / B) buckets before it, so each
order is copied to those buckets and the join runs on
(session_id, user_id, bucket) plus the exact range condition. Every
(click, order) pair still meets exactly once, clicks are not duplicated (so
the left outer join stays exact), and a hot session is spread over its time
buckets instead of landing in one task with all its pairs.

Stream: the same range condition on watermarked inputs (state is evicted by
horizon + watermark); Spark requires append mode for the outer join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from kpiflow.functions.intent import session_intent_score
from kpiflow.functions.timecols import add_partition_columns
from kpiflow.settings import DEFAULT_SETTINGS, Settings

# The silver schema: what a row takes from its click (c) and its order (o), in column order. Renamed: the
# normalised channel. The intent score is computed from both.
CLICK_SIDE = "event_time event_id event_type session_id user_id product_id category campaign_id channel device_type country_code".split()
ORDER_SIDE = "order_id order_status order_value payment_method".split()
RENAMED = {"channel": "channel_normalized"}
ATTRIBUTION_COLUMNS = [*CLICK_SIDE, *ORDER_SIDE, "session_intent_score"]


def _bucket(ts_col: str, width_minutes: Column | int):
    return F.floor(F.unix_seconds(F.col(ts_col)) / (width_minutes * 60)).cast("long")


def _range_cond(horizon_minutes: int):
    return (F.col("o.o_time") >= F.col("c.event_time")) & (
        F.col("o.o_time") <= F.col("c.event_time") + F.expr(f"INTERVAL {horizon_minutes} MINUTES")
    )


def _order_side(orders: DataFrame) -> DataFrame:
    return orders.select(
        F.col("session_id").alias("o_session_id"),
        F.col("user_id").alias("o_user_id"),
        F.col("event_time").alias("o_time"),
        "order_id",
        F.col("status").alias("order_status"),
        "order_value",
        "payment_method",
    )


def interval_join(clicks: DataFrame, orders: DataFrame, how: str = "left", settings: Settings = DEFAULT_SETTINGS) -> DataFrame:
    """Clicks x orders, same (session, user), order time in [click, click + horizon].

    Many-to-many; ``how='left'`` keeps unmatched clicks with null order fields.
    A blank session or user id matches nothing.
    """
    h = settings.join_lookback_minutes
    o = _order_side(_with_ids(orders))
    if clicks.isStreaming or orders.isStreaming:
        cond = (
            (F.col("c.session_id") == F.col("o.o_session_id"))
            & (F.col("c.user_id") == F.col("o.o_user_id"))
            & _range_cond(h)
        )
        return clicks.alias("c").join(o.alias("o"), cond, "leftOuter" if how == "left" else how)
    clicks, o, width = _bucket_widths(clicks, o, settings)
    # a blank session or user matches nothing, and must not gather all such clicks under one key either
    blank = (F.col("session_id") == "") | (F.col("user_id") == "")
    c = clicks.withColumn("_jb", _bucket("event_time", width)).withColumn("_js", F.when(blank, F.concat(F.lit("?"), "event_id")).otherwise(F.col("session_id")))
    o = o.withColumn("_ob", _bucket("o_time", width)).withColumn(
        "_jb", F.explode(F.sequence(F.col("_ob") - F.ceil(F.lit(h) / width).cast("long"), F.col("_ob")))
    ).drop("_width")
    cond = (
        (F.col("c._js") == F.col("o.o_session_id"))
        & (F.col("c.user_id") == F.col("o.o_user_id"))
        & (F.col("c._jb") == F.col("o._jb"))
        & _range_cond(h)
    )
    return c.drop("_width").alias("c").join(o.alias("o"), cond, "left" if how == "left" else how).drop("_jb", "_ob", "_js")


def _bucket_widths(clicks: DataFrame, orders: DataFrame, settings: Settings) -> tuple[DataFrame, DataFrame, Column]:
    """Both sides with the bucket width of their session: hot sessions are cut into narrower pieces, so that one
    that holds a third of all clicks is spread over many tasks, and no other order is copied more often for it.

    A session is hot by its clicks alone, so both sides agree. Fewer than clicks / join_hot_clicks sessions are hot,
    and only their keys are broadcast.
    """
    if not settings.join_hot_clicks:
        return clicks, orders, F.lit(settings.join_bucket_minutes)
    many = clicks.groupBy(F.col("session_id").alias("_hs"), F.col("user_id").alias("_hu")).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > settings.join_hot_clicks)
    hot = F.broadcast(many.select("_hs", "_hu"))
    width = F.when(F.col("_hs").isNotNull(), F.lit(settings.join_hot_bucket_minutes)).otherwise(F.lit(settings.join_bucket_minutes)).alias("_width")

    def with_width(df: DataFrame, session: str, user: str) -> DataFrame:
        return df.join(hot, (F.col(session) == F.col("_hs")) & (F.col(user) == F.col("_hu")), "left").select(*df.columns, width)

    return with_width(clicks, "session_id", "user_id"), with_width(orders, "o_session_id", "o_user_id"), F.col("_width")


def attribution_projection(joined: DataFrame) -> DataFrame:
    """Silver ``session_attribution`` row (click time is the event time)."""
    taken = [F.col(f"{side}.{RENAMED.get(name, name)}").alias(name) for side, names in (("c", CLICK_SIDE), ("o", ORDER_SIDE)) for name in names]
    score = session_intent_score(F.col("c.event_type"), F.col("o.order_value")).alias("session_intent_score")
    return add_partition_columns(joined.select(*taken, score), "event_time")


def session_attribution(clean_clicks: DataFrame, clean_orders: DataFrame, settings: Settings = DEFAULT_SETTINGS) -> DataFrame:
    """J1 + J2 (all-touch: a click with n matching orders appears n times, D12)."""
    return attribution_projection(interval_join(clean_clicks, clean_orders, "left", settings))


def last_touch(clean_clicks: DataFrame, clean_orders: DataFrame, settings: Settings = DEFAULT_SETTINGS) -> DataFrame:
    """Each order credited to its latest preceding click of the same
    session within the horizon (ties: larger event_id). Revenue sums to the
    matched orders' revenue exactly once.

    No pairs are made: clicks and orders are put in one line by time, and an
    order takes the last click before it. Time buckets as wide as the horizon
    split a hot session; a click stands in its own bucket and the next.
    """
    h = settings.join_lookback_minutes
    horizon = F.expr(f"INTERVAL {h} MINUTES")
    taken = [RENAMED.get(name, name) for name in CLICK_SIDE]  # no payload: every click goes through the shuffle and the sort twice
    clicks, orders = _with_ids(clean_clicks).select(*taken), _order_side(_with_ids(clean_orders))
    c_row, o_row = F.struct(*clicks.columns), F.struct(*orders.columns)
    first = F.floor(F.unix_seconds("event_time") / (h * 60)).cast("long")
    line = clicks.select(
        F.col("session_id").alias("s"), F.col("user_id").alias("u"), F.explode(F.array(first, first + 1)).alias("b"),
        F.col("event_time").alias("t"), F.lit(0).alias("kind"), F.col("event_id").alias("id"), c_row.alias("c"), F.lit(None).cast(orders.select(o_row.alias("o")).schema[0].dataType).alias("o"),
    ).unionByName(orders.select(
        F.col("o_session_id").alias("s"), F.col("o_user_id").alias("u"), _bucket("o_time", h).alias("b"),
        F.col("o_time").alias("t"), F.lit(1).alias("kind"), F.lit(None).cast("string").alias("id"), F.lit(None).cast(clicks.select(c_row.alias("c")).schema[0].dataType).alias("c"), o_row.alias("o"),
    ))
    so_far = Window.partitionBy("s", "u", "b").orderBy("t", "kind", "id").rowsBetween(Window.unboundedPreceding, 0)
    touched = line.withColumn("c", F.last("c", ignorenulls=True).over(so_far)).filter("kind = 1 AND c IS NOT NULL")
    return attribution_projection(touched.filter(F.col("o.o_time") <= F.col("c.event_time") + horizon))


def _with_ids(df: DataFrame) -> DataFrame:
    """Rows whose session and user are known: a blank one says nothing about who it was."""
    return df.filter((F.col("session_id") != "") & (F.col("user_id") != ""))


def session_order_totals(clicks: DataFrame, orders: DataFrame) -> DataFrame:
    """Per click, the number of orders with the same (session, user) and
    their captured value sum, with no time bound. Orders are pre-aggregated
    per key first, so the join has no fan-out."""
    per_key = orders.groupBy("session_id", "user_id").agg(
        F.count(F.lit(1)).alias("matched_orders"),
        F.sum(F.when(F.col("status") == "captured", F.col("order_value")).otherwise(F.lit(0.0))).alias(
            "matched_captured_value"
        ),
    )
    return clicks.join(per_key, ["session_id", "user_id"], "left").select(
        clicks["*"],
        F.coalesce(F.col("matched_orders"), F.lit(0)).alias("matched_orders"),
        F.coalesce(F.col("matched_captured_value"), F.lit(0.0)).alias("matched_captured_value"),
    )
