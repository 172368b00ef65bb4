"""Deployable streaming jobs: the bronze job and the silver/gold job.

``start_bronze`` reads both topics (Kafka by default, or any pair of envelope
streams) and starts the five bronze sinks. ``start_silver_gold`` reads the
bronze tables as streams, joins once, and runs the live gold path (exact,
late-corrected gold tables) and/or the final append KPI stream. Both return
the started queries; ``supervise`` waits on them and surfaces the first
failure. Triggers default to the configured processing time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from kpiflow.schemas import CLICKS, ORDERS
from kpiflow.session import ensure_utc
from kpiflow.settings import DEFAULT_SETTINGS, Settings
from kpiflow.sources.files import read_table_stream
from kpiflow.sources.kafka import KafkaSecurity, read_kafka_stream
from kpiflow.streaming.jobs import (
    Paths,
    bronze_queries,
    bronze_schema,
    final_kpis_stream,
    live_query,
    quarantine_schema,
    silver_stream,
    streaming_session_conf,
)
from kpiflow.streaming.sinks import append_sink

# Fixed values that must equal the reference's: default topic names
# (clickstream, then orders); both are parameters of start_bronze.
CLICKSTREAM_TOPIC = "ecommerce.clickstream.v1"
ORDERS_TOPIC = "ecommerce.orders.v1"


def start_bronze(
    spark: SparkSession,
    paths: Paths,
    bootstrap_servers: str | None = None,
    security: KafkaSecurity = KafkaSecurity(),
    clicks_raw: DataFrame | None = None,
    orders_raw: DataFrame | None = None,
    trigger: dict | None = None,
    settings: Settings = DEFAULT_SETTINGS,
    topics: tuple[str, str] = (CLICKSTREAM_TOPIC, ORDERS_TOPIC),
) -> list[StreamingQuery]:
    """Bronze job. Pass ``bootstrap_servers`` (and security options) to read
    Kafka, or ready envelope streams as ``clicks_raw`` / ``orders_raw``."""
    ensure_utc(spark)
    if clicks_raw is None or orders_raw is None:
        if not bootstrap_servers:
            raise ValueError("start_bronze needs bootstrap_servers or both envelope streams")
        clicks_raw = read_kafka_stream(spark, bootstrap_servers, topics[0], settings, security)
        orders_raw = read_kafka_stream(spark, bootstrap_servers, topics[1], settings, security)
    return bronze_queries(clicks_raw, orders_raw, paths, trigger, settings)


def start_silver_gold(
    spark: SparkSession,
    paths: Paths,
    bronze_paths: Paths | None = None,
    live: bool = True,
    final: bool = False,
    trigger: dict | None = None,
    settings: Settings = DEFAULT_SETTINGS,
) -> list[StreamingQuery]:
    """Silver/gold job over the bronze tables (``bronze_paths``, default ``paths``).

    ``live`` starts the path that keeps silver, KPI, campaign, alert and drift
    tables exact and corrected for late rows; ``final`` adds an append-only
    stream of KPIs (HLL distincts) whose rows never change once written, and
    which late rows do not reach.
    """
    ensure_utc(spark)
    streaming_session_conf(spark, settings)
    src = bronze_paths or paths
    queries: list[StreamingQuery] = []

    def bronze() -> tuple[DataFrame, DataFrame]:
        return (
            read_table_stream(spark, src.table("bronze_clickstream"), bronze_schema(spark, CLICKS)),
            read_table_stream(spark, src.table("bronze_orders"), bronze_schema(spark, ORDERS)),
        )

    if live:
        rejected = read_table_stream(spark, src.table("quarantine"), quarantine_schema(spark))
        queries.append(live_query(*bronze(), spark, paths, trigger, src, settings, rejected))
    if final:
        queries.append(
            append_sink(final_kpis_stream(silver_stream(*bronze(), settings), settings), paths.table("realtime_kpis_final"),
                        paths.checkpoint("realtime_kpis_final"), None, trigger, settings=settings)
        )
    return queries
