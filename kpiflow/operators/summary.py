"""A8 run summary and Q2 offline alert row of the offline path.

Strict-profile validation (blank strings count as missing), no dedupe and no
status filter (finding D20). Conversion here is captured orders / distinct
sessions, unlike the streaming KPI's orders / sessions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiflow.functions.timecols import minute_end, minute_start
from kpiflow.operators.ingest import ROUTE_VALID
from kpiflow.operators.kpis import count_if, safe_ratio
from kpiflow.operators.quality import CRITICAL, NORMAL


def run_summary(clicks_routed: DataFrame, orders_routed: DataFrame, entity_name: str = "offline_demo") -> DataFrame:
    """One row: generated / valid / quarantined counts per source, captured
    orders and revenue, conversion, plus the Q2 alert fields at the latest
    valid click minute."""
    cols = ["source_name", "route", "session_id", "status", "order_value", "event_time"]
    c = clicks_routed.withColumn("status", F.lit(None).cast("string")).withColumn(
        "order_value", F.lit(None).cast("double")
    ).select(*cols)
    o = orders_routed.select(*cols)
    rows = c.unionByName(o)
    is_click = F.col("source_name") == "clickstream"
    is_valid = F.col("route") == ROUTE_VALID
    valid_click = is_click & is_valid
    captured = ~is_click & is_valid & (F.col("status") == "captured")
    agg = rows.agg(
        count_if(is_click).alias("clickstream_generated"),
        count_if(~is_click).alias("orders_generated"),
        count_if(valid_click).alias("clickstream_valid"),
        count_if(~is_click & is_valid).alias("orders_valid"),
        count_if(~is_valid).alias("quarantine_records"),
        count_if(captured).alias("captured_orders"),
        F.sum(F.when(captured, F.col("order_value"))).alias("_revenue"),
        F.count_distinct(F.when(valid_click, F.col("session_id"))).alias("_sessions"),
        F.max(F.when(valid_click, minute_start(F.col("event_time")))).alias("window_start"),
    )
    return agg.select(
        "clickstream_generated",
        "orders_generated",
        "clickstream_valid",
        "orders_valid",
        "quarantine_records",
        "captured_orders",
        F.round(F.coalesce(F.col("_revenue"), F.lit(0.0)), 2).alias("gross_revenue"),
        F.round(safe_ratio(F.col("captured_orders"), F.col("_sessions")), 4).alias("conversion_rate"),
        F.lit(entity_name).alias("entity_name"),
        "window_start",
        minute_end(F.col("window_start")).alias("window_end"),
        (F.col("clickstream_valid") + F.col("orders_valid")).alias("records_total"),
        F.col("quarantine_records").alias("invalid_records"),
        F.when(F.col("quarantine_records") > 0, F.lit(CRITICAL)).otherwise(F.lit(NORMAL)).alias("alert_level"),
    )
