"""Event contracts: Kafka envelope, clickstream and order payloads."""

from __future__ import annotations

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

ENVELOPE = StructType(
    [
        StructField("key", StringType()),
        StructField("value", StringType()),
        StructField("timestamp", TimestampType()),
        StructField("partition", IntegerType()),
        StructField("offset", LongType()),
    ]
)

CLICKSTREAM = StructType(
    [
        StructField("event_id", StringType()),
        StructField("event_time", StringType()),
        StructField("event_type", StringType()),
        StructField("session_id", StringType()),
        StructField("user_id", StringType()),
        StructField("anonymous_id", StringType()),
        StructField("page_url", StringType()),
        StructField("product_id", StringType()),
        StructField("category", StringType()),
        StructField("campaign_id", StringType()),
        StructField("channel", StringType()),
        StructField("device_type", StringType()),
        StructField("browser", StringType()),
        StructField("country_code", StringType()),
        StructField("referrer", StringType()),
        StructField("ip_hash", StringType()),
        StructField("schema_version", IntegerType()),
    ]
)

ORDER = StructType(
    [
        StructField("order_id", StringType()),
        StructField("event_time", StringType()),
        StructField("session_id", StringType()),
        StructField("user_id", StringType()),
        StructField("status", StringType()),
        StructField("payment_method", StringType()),
        StructField("currency", StringType()),
        StructField("order_value", DoubleType()),
        StructField("items_count", IntegerType()),
        StructField("fraud_score", DoubleType()),
        StructField("shipping_country", StringType()),
        StructField("schema_version", IntegerType()),
    ]
)


class Entity:
    """Static description of one event source."""

    def __init__(self, source_name: str, schema: StructType, id_col: str):
        self.source_name = source_name
        self.schema = schema
        self.id_col = id_col

    @property
    def fields(self) -> list[str]:
        return [f.name for f in self.schema.fields]

    @property
    def non_string_fields(self) -> list[str]:
        return [f.name for f in self.schema.fields if not isinstance(f.dataType, StringType)]


CLICKS = Entity("clickstream", CLICKSTREAM, "event_id")
ORDERS = Entity("orders", ORDER, "order_id")
