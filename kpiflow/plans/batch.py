"""Batch plans: the operators wired into bronze -> silver -> gold.

Each function takes the raw envelope (both topics, ``source_name`` column)
and returns a lazy DataFrame; nothing is collected. The streaming jobs in
``kpiflow.streaming`` reuse the same operators on streaming frames.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiflow.operators import attribution, dedupe, ingest
from kpiflow.schemas import CLICKS, ORDERS, Entity
from kpiflow.settings import DEFAULT_SETTINGS, Settings
from kpiflow.sources.fixtures import topic


def routed_topic(env: DataFrame, entity: Entity, profile: str = "bronze", blank_is_null: bool = False) -> DataFrame:
    return ingest.routed(topic(env, entity.source_name), entity, profile, blank_is_null)


@dataclass
class Bronze:
    clicks_routed: DataFrame
    orders_routed: DataFrame
    clock: Column | None = None

    @cached_property
    def clicks(self) -> DataFrame:
        return ingest.valid_records(self.clicks_routed, CLICKS, self.clock)

    @cached_property
    def orders(self) -> DataFrame:
        return ingest.valid_records(self.orders_routed, ORDERS, self.clock)

    @cached_property
    def quarantine(self) -> DataFrame:
        return ingest.quarantine_all(
            [
                ingest.quarantine_records(self.clicks_routed, CLICKS, self.clock),
                ingest.quarantine_records(self.orders_routed, ORDERS, self.clock),
            ]
        )


def bronze(env: DataFrame, clock: Column | None = None) -> Bronze:
    return Bronze(routed_topic(env, CLICKS), routed_topic(env, ORDERS), clock)


def silver(b: Bronze, settings: Settings = DEFAULT_SETTINGS, order_keep: str = "first") -> DataFrame:
    """session_attribution: deduped clicks x deduped, status-filtered orders."""
    return attribution.session_attribution(
        dedupe.clean_clicks(b.clicks, settings), dedupe.clean_orders(b.orders, order_keep, settings), settings
    )


def offline_inputs(env: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Strict-profile valid clicks and orders of the offline path (no dedupe,
    no status filter; blank strings count as missing)."""
    clicks = routed_topic(env, CLICKS, "strict", blank_is_null=True)
    orders = routed_topic(env, ORDERS, "strict", blank_is_null=True)
    return clicks, orders


def strict_valid(routed_df: DataFrame) -> DataFrame:
    return routed_df.filter(F.col("route") == ingest.ROUTE_VALID)
