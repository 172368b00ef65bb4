"""Serving queries over gold tables: G1 latest-window rollup, G2 revenue by
channel, G3 conversion trend, T1 top campaigns, T2/G4 latest alerts,
C4 column guard.

Top-k queries use ``orderBy(...).limit(k)``, which Spark plans as a
per-partition top-k followed by a k-row merge (TakeOrderedAndProject), so
nothing unbounded reaches one task or the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiflow.operators.kpis import exact_avg, safe_ratio


def require_columns(df: DataFrame, columns: list[str], what: str = "query") -> DataFrame:
    """C4: fail early with a clear message when a gold table lacks columns."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{what}: input lacks columns {missing}; has {df.columns}")
    return df


def latest_partition(gold: DataFrame) -> DataFrame:
    """The newest window partition of a stored gold table; only its files are opened.

    The bound is found from the partition values and reaches the scan as a
    partition filter.
    """
    parts = ["window_date", "window_hour", "window_slot"]
    newest = gold.select(F.max(F.concat_ws(" ", *parts))).scalar()
    return gold.filter(F.concat_ws(" ", *parts) == newest)


def latest_window_rollup(kpis: DataFrame) -> DataFrame:
    """G1: totals over the rows of the latest window_end.

    One pass: totals per window_end (one row per window, partially
    aggregated), then the top row by window_end (a per-partition top-1 and a
    1-row merge). The KPI input is computed once -- no self-join or
    max-then-join, whose two branches would each recompute it.
    """
    require_columns(kpis, ["window_end", "events_total", "orders_total", "gross_revenue", "sessions_total"], "G1")
    per_window = kpis.groupBy("window_end").agg(
        F.sum("events_total").cast("long").alias("events_total"),
        F.sum("orders_total").cast("long").alias("orders_total"),
        F.sum("gross_revenue").alias("gross_revenue"),
        F.sum("sessions_total").cast("long").alias("sessions_total"),
    )
    latest = per_window.orderBy(F.col("window_end").desc()).limit(1)
    return latest.select(
        "window_end",
        "events_total",
        "orders_total",
        "gross_revenue",
        "sessions_total",
        safe_ratio(F.col("orders_total"), F.col("sessions_total")).alias("conversion_rate"),
    )


def revenue_by_channel(kpis: DataFrame) -> DataFrame:
    """Total gross revenue per channel, highest first."""
    require_columns(kpis, ["channel", "gross_revenue"], "G2")
    return (
        kpis.groupBy("channel")
        .agg(F.sum("gross_revenue").alias("gross_revenue"))
        .orderBy(F.col("gross_revenue").desc(), F.col("channel").asc_nulls_first())
    )


def conversion_trend(kpis: DataFrame) -> DataFrame:
    """Unweighted mean conversion rate and revenue per window_start."""
    require_columns(kpis, ["window_start", "conversion_rate", "gross_revenue"], "G3")
    return (
        kpis.groupBy("window_start")
        .agg(
            exact_avg("conversion_rate", "decimal(30,15)").alias("conversion_rate"),
            exact_avg("gross_revenue", "decimal(30,10)").alias("gross_revenue"),
        )
        .orderBy("window_start")
    )


def top_campaigns(clicks: DataFrame, k: int = 10) -> DataFrame:
    """The k (campaign_id, channel) pairs with most clicks.

    Ties break on (campaign_id, channel), nulls first, so the result is
    deterministic (the reference keeps first-seen order).
    """
    return (
        clicks.groupBy("campaign_id", "channel")
        .agg(F.count(F.lit(1)).alias("campaign_events"))
        .orderBy(F.col("campaign_events").desc(), F.col("campaign_id").asc_nulls_first(), F.col("channel").asc_nulls_first())
        .limit(k)
    )


def latest_alerts(alerts: DataFrame, k: int = 25) -> DataFrame:
    """The k most recent alerts by window_end (fallback: first
    column), ties by entity_name."""
    sort_col = "window_end" if "window_end" in alerts.columns else alerts.columns[0]
    order = [F.col(sort_col).desc()]
    if "entity_name" in alerts.columns and sort_col != "entity_name":
        order.append(F.col("entity_name").asc())
    return alerts.orderBy(*order).limit(k)
