"""Deduplication by business id.

Batch: deterministic first-seen row per id in arrival order
(kafka_ingest_time, kafka_partition, kafka_offset). ``row_number() == 1``
lets Catalyst insert a per-partition group limit before the shuffle
(WindowGroupLimit), so a hot id ships at most one row per map task.

Stream: ``dropDuplicatesWithinWatermark`` by default (finding D5: plain
``dropDuplicates`` on the id keeps its state forever). ``dedupe_forever`` chooses that
state on purpose: every id once seen stays in the state store (RocksDB), so an id
that comes again after any time is still dropped, as in batch, at the price of one key per id.
The watermark is then declared behind the dedupe, which itself drops no late row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kpiflow.settings import DEFAULT_SETTINGS, Settings

ARRIVAL_ORDER = ["kafka_ingest_time", "kafka_partition", "kafka_offset"]

# Fixed values that must equal the reference's: statuses kept by the silver layer.
KEPT_ORDER_STATUSES = ["authorized", "captured", "declined"]


def first_seen(df: DataFrame, id_col: str, keep: str = "first") -> DataFrame:
    """One row per ``id_col``: the first arrival (``keep='first'``) or the
    latest event time (``keep='latest'``, ties by arrival)."""
    if keep == "first":
        order = [F.col(c).asc() for c in ARRIVAL_ORDER]
    elif keep == "latest":
        order = [F.col("event_time").desc()] + [F.col(c).desc() for c in ARRIVAL_ORDER]
    else:
        raise ValueError(keep)
    w = Window.partitionBy(id_col).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def dedupe_stream(df: DataFrame, id_col: str, settings: Settings = DEFAULT_SETTINGS) -> DataFrame:
    """U1/U2 on a stream; rows of one id inside a micro-batch are taken for copies of one payload."""
    if settings.dedupe_forever:
        return df.dropDuplicates([id_col]).withWatermark("event_time", settings.watermark_delay)
    return df.withWatermark("event_time", settings.watermark_delay).dropDuplicatesWithinWatermark([id_col])


def dedupe(df: DataFrame, id_col: str, keep: str = "first", settings: Settings = DEFAULT_SETTINGS) -> DataFrame:
    return dedupe_stream(df, id_col, settings) if df.isStreaming else first_seen(df, id_col, keep)


def clean_clicks(bronze_clicks: DataFrame, settings: Settings = DEFAULT_SETTINGS) -> DataFrame:
    """U1 + P5: deduped clicks with ``channel_normalized``."""
    from kpiflow.functions.channel import normalize_channel

    return dedupe(bronze_clicks, "event_id", settings=settings).withColumn(
        "channel_normalized", normalize_channel("referrer", "channel")
    )


def clean_orders(bronze_orders: DataFrame, keep: str = "first", settings: Settings = DEFAULT_SETTINGS) -> DataFrame:
    """U2 then P9: dedupe happens before the status filter (finding D6)."""
    return dedupe(bronze_orders, "order_id", keep=keep, settings=settings).filter(
        F.col("status").isin(*KEPT_ORDER_STATUSES)
    )
