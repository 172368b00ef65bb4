"""S1 Kafka stream source and C1 security options.

The Kafka connector jar is not part of a plain PySpark install; the reader is
fully configured here and only ``load()`` needs the connector.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from kpiflow.settings import DEFAULT_SETTINGS, Settings

# Fixed values that must equal the reference's: SASL mechanism -> JAAS login module.
LOGIN_MODULES = {
    "SCRAM-SHA-256": "org.apache.kafka.common.security.scram.ScramLoginModule",
    "SCRAM-SHA-512": "org.apache.kafka.common.security.scram.ScramLoginModule",
    "PLAIN": "org.apache.kafka.common.security.plain.PlainLoginModule",
}


@dataclass(frozen=True)
class KafkaSecurity:
    """How to talk to the brokers; inconsistent settings cannot be constructed.

    Without a protocol, a user or password asks for SASL over plain text and
    neither asks for no security at all. SASL wants both user and password and
    a known mechanism; other protocols ignore them.
    """

    protocol: str = ""
    mechanism: str = "SCRAM-SHA-512"
    username: str | None = None
    password: str | None = field(default=None, repr=False)

    def __post_init__(self) -> None:
        implied = "SASL_PLAINTEXT" if self.username or self.password else "PLAINTEXT"
        object.__setattr__(self, "protocol", (self.protocol or implied).upper())
        object.__setattr__(self, "mechanism", self.mechanism.upper())
        if self.sasl:
            absent = [n for n in ("username", "password") if not getattr(self, n)]
            if absent:
                raise ValueError(f"{self.protocol} without {' and '.join(absent)}")
            if self.mechanism not in LOGIN_MODULES:
                raise ValueError(f"no login module for SASL mechanism {self.mechanism}")

    @property
    def sasl(self) -> bool:
        return self.protocol.startswith("SASL")

    def options(self, prefix: str = "kafka.") -> dict[str, str]:
        """Options of the Spark source. The credentials travel in the login line only."""
        found: dict[str, str] = {}
        if self.protocol != "PLAINTEXT":
            found["security.protocol"] = self.protocol
        if self.sasl:
            login = {"username": self.username, "password": self.password}
            quoted = " ".join(f'{k}="{v}"' for k, v in login.items())
            found["sasl.mechanism"] = self.mechanism
            found["sasl.jaas.config"] = f"{LOGIN_MODULES[self.mechanism]} required {quoted};"
        return {prefix + k: v for k, v in found.items()}


def kafka_reader_options(
    bootstrap_servers: str,
    topic: str,
    settings: Settings = DEFAULT_SETTINGS,
    security: KafkaSecurity = KafkaSecurity(),
) -> dict[str, str]:
    opts = {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": topic,
        "startingOffsets": settings.starting_offsets,
        "maxOffsetsPerTrigger": str(settings.max_offsets_per_trigger),
        "failOnDataLoss": str(settings.fail_on_data_loss).lower(),
    }
    return opts | security.options()


def read_kafka_stream(
    spark: SparkSession,
    bootstrap_servers: str,
    topic: str,
    settings: Settings = DEFAULT_SETTINGS,
    security: KafkaSecurity = KafkaSecurity(),
) -> DataFrame:
    """Streaming Kafka records (key, value, topic, partition, offset, timestamp, ...)."""
    return spark.readStream.format("kafka").options(**kafka_reader_options(bootstrap_servers, topic, settings, security)).load()
