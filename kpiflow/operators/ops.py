"""Operations metrics over the bronze envelope: O1 throughput, O2 error rate,
O3 high-watermark snapshots, O4 ingest lag, M11 late-row audit.

Running values in arrival order are never computed by one window over a
whole topic: the late-row audit orders rows inside a second only and carries
maxima over seconds and minutes, and the high watermark runs over per-minute
aggregates of (topic, partition), which are small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kpiflow.operators.ingest import ROUTE_VALID
from kpiflow.operators.kpis import count_if, safe_ratio
from kpiflow.settings import DEFAULT_SETTINGS, Settings

ARRIVAL_COLUMNS = [
    "source_name",
    "kafka_ingest_time",
    "kafka_partition",
    "kafka_offset",
    "event_time",
    "route",
    "label",
]


def arrivals(clicks_routed: DataFrame, orders_routed: DataFrame) -> DataFrame:
    """Both topics' routed records in one frame; ``label`` is event_type for
    clicks and status for orders (null when the payload did not parse)."""
    c = clicks_routed.withColumn("label", F.col("event_type")).select(*ARRIVAL_COLUMNS)
    o = orders_routed.withColumn("label", F.col("status")).select(*ARRIVAL_COLUMNS)
    return c.unionByName(o)


def throughput(arr: DataFrame) -> DataFrame:
    """O1: records per source, arrival minute and event_type/status label."""
    agg = arr.groupBy("source_name", F.window("kafka_ingest_time", "1 minute").alias("window"), "label").agg(
        F.count(F.lit(1)).alias("records")
    )
    return agg.select(
        "source_name",
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "label",
        "records",
    )


def error_rate(arr: DataFrame, window: str = "5 minutes") -> DataFrame:
    """O2: quarantined / total per source per 5 arrival minutes."""
    agg = arr.groupBy("source_name", F.window("kafka_ingest_time", window).alias("window")).agg(
        F.count(F.lit(1)).alias("records_total"),
        count_if(F.col("route") != ROUTE_VALID).alias("quarantined"),
    )
    return agg.select(
        "source_name",
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "records_total",
        "quarantined",
        safe_ratio(F.col("quarantined"), F.col("records_total")).alias("error_rate"),
    )


def high_watermark(arr: DataFrame) -> DataFrame:
    """O3: per source and minute snapshot, the sum over partitions of
    (max offset + 1) seen by the end of that minute, and whether it grew
    since the previous minute's snapshot (every minute between the first and
    last arrival is a snapshot, idle ones included)."""
    minute = F.date_trunc("minute", F.col("kafka_ingest_time"))
    per_part = arr.groupBy("source_name", "kafka_partition", minute.alias("snapshot_minute")).agg(
        (F.max("kafka_offset") + 1).alias("hw")
    )
    by_part = Window.partitionBy("source_name", "kafka_partition").orderBy("snapshot_minute")
    deltas = per_part.withColumn("delta", F.col("hw") - F.coalesce(F.lag("hw").over(by_part), F.lit(0)))
    per_minute = deltas.groupBy("source_name", "snapshot_minute").agg(F.sum("delta").alias("delta"))
    # One row per source and minute with arrivals; the idle minutes up to the next one follow from it.
    by_src = Window.partitionBy("source_name").orderBy("snapshot_minute")
    until = F.coalesce(F.lead("snapshot_minute").over(by_src) - F.expr("INTERVAL 1 MINUTE"), F.col("snapshot_minute"))
    level = F.sum("delta").over(by_src.rowsBetween(Window.unboundedPreceding, 0))
    first = F.row_number().over(by_src) == 1
    runs = per_minute.select("source_name", "delta", level.alias("high_watermark"), first.alias("_first"),
                             F.sequence("snapshot_minute", until, F.expr("INTERVAL 1 MINUTE")).alias("_minutes"))
    minutes = runs.select("*", F.posexplode("_minutes").alias("_i", "snapshot_minute"))
    grown = F.when(F.col("_i") == 0, F.col("delta")).otherwise(F.lit(0))
    return minutes.select(
        "source_name", "snapshot_minute", F.col("high_watermark").cast("long").alias("high_watermark"),
        grown.cast("long").alias("new_offsets"), ((grown > 0) | (F.col("_first") & (F.col("_i") == 0))).alias("is_active"),
    )


def ingest_lag(arr: DataFrame) -> DataFrame:
    """Arrival minus event time (seconds) per source and event minute."""
    # Integer microseconds: the mean of an exact integer sum does not depend
    # on the order rows are added in.
    lag_us = F.unix_micros("kafka_ingest_time") - F.unix_micros("event_time")
    agg = arr.filter(F.col("event_time").isNotNull()).groupBy(
        "source_name", F.window("event_time", "1 minute").alias("window")
    ).agg(
        F.count(F.lit(1)).alias("records"),
        (F.avg(lag_us) / 1e6).alias("avg_lag_seconds"),
        (F.max(lag_us) / 1e6).alias("max_lag_seconds"),
        (F.min(lag_us) / 1e6).alias("min_lag_seconds"),
        # over whole seconds, so that the counted values stay few however many records a minute has
        F.percentile(F.floor(lag_us / 1_000_000), 0.95).alias("p95_lag_seconds"),
    )
    return agg.select(
        "source_name",
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "records",
        "avg_lag_seconds",
        "max_lag_seconds",
        "min_lag_seconds",
        "p95_lag_seconds",
    )


def flag_late_rows(arr: DataFrame, settings: Settings = DEFAULT_SETTINGS) -> DataFrame:
    """Mark rows whose event_time is more than the watermark delay behind
    the largest event_time that arrived earlier on the same source (arrival
    order: kafka_ingest_time, kafka_partition, kafka_offset). These are the
    rows a stateful streaming operator may drop as late (Spark may keep some
    of them: chained operators filter with the previous batch's watermark)."""
    order = ["kafka_ingest_time", "kafka_partition", "kafka_offset"]
    second, minute = F.date_trunc("second", "kafka_ingest_time"), F.date_trunc("minute", "_second")
    before = Window.unboundedPreceding, -1
    # inside a second: row by row; both uses below take the same columns of it, so the shuffled rows are read again, not the input
    in_second = Window.partitionBy("source_name", "_second").orderBy(*order)
    known = arr.filter(F.col("event_time").isNotNull()).withColumn("_second", second)
    known = known.filter(F.col("_second").isNotNull() & minute.isNotNull())  # what the joins ask for, on both sides alike
    local = known.withColumn("_here", F.max("event_time").over(in_second.rowsBetween(*before)))
    # up to the second: maxima of the seconds before it in its minute, and of the minutes before
    last = local.withColumn("_next", F.lead("_second").over(in_second)).filter("_next is null")  # knows the whole second
    seconds = last.select("source_name", "_second", F.greatest("_here", "event_time").alias("_m")).withColumn("_minute", minute)
    in_minute = Window.partitionBy("source_name", "_minute").orderBy("_second").rowsBetween(*before)
    minutes = seconds.groupBy("source_name", "_minute").agg(F.max("_m").alias("_mm"))
    earlier = Window.partitionBy("source_name").orderBy("_minute").rowsBetween(*before)
    carried = (
        seconds.withColumn("_in_minute", F.max("_m").over(in_minute))
        .join(minutes.select("source_name", "_minute", F.max("_mm").over(earlier).alias("_past")), ["source_name", "_minute"])
        .select("source_name", "_second", F.greatest("_in_minute", "_past").alias("_carried"))
    )
    scanned = local.join(carried, ["source_name", "_second"]).withColumn("max_event_time_before", F.greatest("_here", "_carried"))
    late = F.col("event_time") < F.col("max_event_time_before") - F.expr(f"INTERVAL {settings.watermark_delay}")
    return scanned.drop("_second", "_here", "_carried").withColumn("is_late", F.coalesce(late, F.lit(False)))


def late_rows(arr: DataFrame, settings: Settings = DEFAULT_SETTINGS) -> DataFrame:
    """M11 summary per source: rows with an event time, and how many were late."""
    narrow = arr.select("source_name", "kafka_ingest_time", "kafka_partition", "kafka_offset", "event_time")
    flagged = flag_late_rows(narrow, settings)
    return flagged.groupBy("source_name").agg(
        F.count(F.lit(1)).alias("rows_checked"),
        count_if(F.col("is_late")).alias("late_rows"),
    )
