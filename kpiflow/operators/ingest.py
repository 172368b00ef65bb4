"""Bronze: envelope projection, JSON parse, validation and 3-way routing.

P1 envelope projection, P2/P3 parse and flatten, P4 event-time cast,
V1/V2 quality flags, V3 routing, P7/P8 partition and ingest stamps,
X1/X2 quarantine unions.

Parsing happens once per payload: ``try_parse_json`` yields a Variant (NULL for
malformed text) and ``try_variant_get`` pulls the typed struct out of it with
per-field partial results. That separates the three failure kinds precisely
(finding D1): malformed or non-object JSON, a required field missing, and a
well-formed object carrying a wrong-typed value.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField

from kpiflow.functions import rules
from kpiflow.functions.timecols import add_partition_columns
from kpiflow.schemas import Entity
from kpiflow.session import ensure_utc

ROUTE_VALID = "valid"
JSON_PARSE_FAILURE = "json_parse_failure"
REQUIRED_FIELDS_MISSING = "required_fields_missing"
TYPE_MISMATCH = "type_mismatch"

KAFKA_COLS = ["kafka_key", "kafka_ingest_time", "kafka_partition", "kafka_offset"]


def project_envelope(raw: DataFrame) -> DataFrame:
    """Kafka record -> kafka_key, payload, kafka_ingest_time, kafka_partition, kafka_offset."""
    return raw.select(
        F.col("key").cast("string").alias("kafka_key"),
        F.col("value").cast("string").alias("payload"),
        F.col("timestamp").alias("kafka_ingest_time"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
    )


def _ddl(entity: Entity) -> str:
    return "struct<" + ",".join(f"`{f.name}` {f.dataType.simpleString()}" for f in entity.schema.fields) + ">"


def _fits(field: StructField, value: Column) -> Column:
    """Whether a JSON value (a Variant) has the JSON type of the field."""
    kind = F.schema_of_variant(value)
    if isinstance(field.dataType, StringType):
        return kind == "STRING"
    if isinstance(field.dataType, IntegerType):
        return (kind == "BIGINT") & F.try_variant_get(value, "$", "int").isNotNull()
    return kind.isin("BIGINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL")


def clean_shape(entity: Entity) -> str:
    """A pattern of ``schema_of_variant`` texts: an object that holds fields of the entity only, each with its own JSON type or null."""
    number = r"(?:BIGINT|DOUBLE|FLOAT|DECIMAL\(\d+,\d+\))"
    kinds = {f.name: "STRING" if isinstance(f.dataType, StringType) else "BIGINT" if isinstance(f.dataType, IntegerType) else number for f in entity.schema.fields}
    # the fields of a variant object come in the order of their names
    return "^OBJECT<" + "".join(rf"(?:{name}: (?:{kinds[name]}|VOID)(?:, |>$))?" for name in sorted(kinds)) + "$"


def parse_payload(env: DataFrame, entity: Entity, field_list: bool = False) -> DataFrame:
    """Typed payload fields next to the payload and kafka_* lineage.

    Adds ``parse_failed`` (null, blank, malformed or no JSON object),
    ``mismatch_bits`` (bit i: field i of the schema is present with a value of
    another JSON type; the field then reads as NULL) and ``type_mismatch`` (any
    bit). Of a key that comes twice in an object the last value counts.
    ``field_list=True`` also adds ``mismatched_fields`` (names, for contract reports).
    ``event_time`` stays the raw string here; see :func:`cast_event_time`.

    All parse outputs are produced by one single-row ``inline`` generator over
    the Variant. Filters on derived columns (the route) cannot be pushed below
    a Generate, so the optimizer cannot copy the parse into every predicate:
    each payload is parsed exactly once. Field types are looked at one by one only in objects
    whose shape as a whole is not the clean one.
    """
    ensure_utc(env.sparkSession)
    with_variant = env.withColumn("_v", F.expr("try_parse_json(payload)")).withColumn("_shape", F.schema_of_variant("_v"))
    parse_failed = ~F.coalesce(F.col("_shape").startswith("OBJECT"), F.lit(False))
    clean = F.col("_shape").rlike(clean_shape(entity))
    for f in entity.schema.fields:
        if isinstance(f.dataType, IntegerType):  # the shape does not tell the size of a number
            clean = clean & (~F.col("_shape").contains(f"{f.name}: BIGINT") | F.try_variant_get("_v", f"$.{f.name}", "int").isNotNull())
    bits = F.lit(0).cast("long")
    for i, f in enumerate(entity.schema.fields):
        value = F.variant_get("_v", f"$.{f.name}", "variant")
        given = value.isNotNull() & ~F.is_variant_null(value)
        bits = bits.bitwiseOR(F.when(given & ~_fits(f, value), F.lit(1 << i)).otherwise(F.lit(0)).cast("long"))
    outputs = [
        parse_failed.alias("parse_failed"),
        F.expr(f"try_variant_get(_v, '$', '{_ddl(entity)}')").alias("_j"),
        F.when(parse_failed | clean, F.lit(0).cast("long")).otherwise(bits).alias("mismatch_bits"),
    ]
    parsed = with_variant.select("payload", *KAFKA_COLS, F.inline(F.array(F.struct(*outputs))))
    fields = [F.when(~mismatched(entity, n), F.col(f"_j.{n}")).alias(n) for n in entity.fields]
    names = F.array_compact(F.array(*[F.when(mismatched(entity, n), F.lit(n)) for n in entity.fields]))
    return parsed.select(
        *fields, "payload", *KAFKA_COLS, "parse_failed", "mismatch_bits", (F.col("mismatch_bits") != 0).alias("type_mismatch"),
        *([names.alias("mismatched_fields")] if field_list else []),
    )


def mismatched(entity: Entity, name: str) -> Column:
    """Whether the field came with a value of another JSON type."""
    return F.col("mismatch_bits").bitwiseAND(F.lit(1 << entity.fields.index(name)).cast("long")) != 0


def cast_event_time(df: DataFrame) -> DataFrame:
    """ISO-8601 string -> timestamp; a bad string becomes NULL, not an error.

    ``event_time_given`` remembers that there was a text.
    """
    given = F.coalesce(F.col("event_time") != "", F.lit(False))
    return df.withColumn("event_time_given", given).withColumn("event_time", F.expr("try_to_timestamp(event_time)"))


def missing(entity: Entity, name: str, profile: str, blank_is_null: bool) -> Column:
    """Whether a required field is missing: null (or blank), and not merely of a wrong JSON type.

    The bronze profile looks at the parsed columns, so a time that cannot be
    read is missing there; the other profiles look at what the payload holds.
    """
    if name == "event_time" and profile != "bronze":
        absent = ~F.col("event_time_given")
    else:
        absent = rules.is_missing(F.col(name), blank_is_null)
    return absent & ~mismatched(entity, name)


def missing_fields(entity: Entity, profile: str, blank_is_null: bool = True) -> Column:
    """V5: names of the required fields that are missing."""
    required = rules.REQUIRED[entity.source_name][profile]
    return F.array_compact(F.array(*[F.when(missing(entity, c, profile, blank_is_null), F.lit(c)) for c in required]))


def add_quality_flags(df: DataFrame, entity: Entity, profile: str = "bronze", blank_is_null: bool = False) -> DataFrame:
    """V1/V2: null_required_columns and is_record_valid (nothing missing, and a usable id)."""
    required = rules.REQUIRED[entity.source_name][profile]
    count = reduce(lambda a, b: a + b, [missing(entity, c, profile, blank_is_null).cast("int") for c in required])
    return df.withColumn("null_required_columns", count).withColumn(
        "is_record_valid", F.col(entity.id_col).isNotNull() & (F.col("null_required_columns") == 0))


def route_column() -> Column:
    """V3: one route label per record.

    A value of the wrong type, or a time that is there but cannot be read, is a
    type mismatch unless a required field is missing.
    """
    unreadable = F.col("event_time_given") & F.col("event_time").isNull()
    return (
        F.when(F.col("parse_failed"), F.lit(JSON_PARSE_FAILURE))
        .when(F.col("null_required_columns") > 0, F.lit(REQUIRED_FIELDS_MISSING))
        .when(F.col("type_mismatch") | unreadable, F.lit(TYPE_MISMATCH))
        .otherwise(F.lit(ROUTE_VALID))
    )


def routed(raw: DataFrame, entity: Entity, profile: str = "bronze", blank_is_null: bool = False) -> DataFrame:
    """Every envelope record of one topic, parsed, flagged and labelled with ``route``."""
    parsed = cast_event_time(parse_payload(project_envelope(raw), entity))
    flagged = add_quality_flags(parsed, entity, profile, blank_is_null)
    return flagged.withColumn("route", route_column()).withColumn("source_name", F.lit(entity.source_name))


def _stamp(df: DataFrame, clock: Column | None) -> DataFrame:
    """Ingest stamp; tests pass a fixed clock column."""
    return df.withColumn("ingest_time", clock if clock is not None else F.current_timestamp())


def valid_records(routed_df: DataFrame, entity: Entity, clock: Column | None = None) -> DataFrame:
    """Bronze valid table: payload fields, lineage, flags, stamps, partitions."""
    out = routed_df.filter(F.col("route") == ROUTE_VALID).select(
        *entity.fields, "payload", *KAFKA_COLS, "null_required_columns", "is_record_valid", "source_name"
    )
    return add_partition_columns(_stamp(out, clock), "event_time")


def quality_input(routed_df: DataFrame, entity: Entity) -> DataFrame:
    """Rows the bronze quality metric sees: everything that parsed."""
    return routed_df.filter(~F.col("parse_failed")).select(
        *entity.fields, *KAFKA_COLS, "null_required_columns", "is_record_valid", "source_name"
    )


def quarantine_records(routed_df: DataFrame, entity: Entity, clock: Column | None = None) -> DataFrame:
    """Parse failures and rejected rows of one topic in one schema (X1), from one scan and parse.

    Partition columns come from the event time when there is one, else the
    arrival time (finding D16), so every quarantined row lands in a partition.
    """
    rejected = routed_df.filter(F.col("route") != ROUTE_VALID)
    # a payload that did not parse has no flags
    flags = [F.when(F.col("route") != JSON_PARSE_FAILURE, F.col(c)).alias(c) for c in ("null_required_columns", "is_record_valid")]
    both = rejected.select("payload", *KAFKA_COLS, "source_name", F.col("route").alias("error_reason"), *entity.fields, *flags)
    part_ts = F.coalesce(F.col("event_time"), F.col("kafka_ingest_time"))
    return add_partition_columns(_stamp(both, clock), part_ts)


def quarantine_all(parts: list[DataFrame]) -> DataFrame:
    """Quarantine of all topics in one frame (missing columns null-filled)."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out
