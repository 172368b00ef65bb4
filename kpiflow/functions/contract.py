"""V4: JSON contracts (draft-07 schema documents) compiled to Column rules.

A document describes one flat object: ``properties`` with ``type`` (one JSON type, or a
union with null), ``enum``, ``minLength``, ``maxLength``, ``minimum``, ``maximum`` and ``format`` (date-time), and
``required``. Everything a compiled contract checks runs as native expressions on the parsed
columns. A keyword that the compiler does not know is an error, never a rule that silently
does not hold; so is a type that the entity's column does not have.
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, IntegerType, StringType

from kpiflow.functions.rules import Contract, Rule
from kpiflow.schemas import Entity

#: Keywords that say nothing about a value.
NOTES = {"$schema", "$id", "$comment", "title", "description", "default", "examples"}
BOUNDS = ["enum", "minLength", "maxLength", "minimum", "maximum"]
COLUMN_OF: dict[str, type[DataType]] = {"string": StringType, "integer": IntegerType, "number": DoubleType}


def _unknown(where: str, keywords: set[str]) -> None:
    if keywords:
        raise ValueError(f"{where}: not supported: {', '.join(sorted(keywords))}")


def _field(entity: Entity, name: str, spec: dict) -> tuple[bool, bool, list[Rule]]:
    """(may be null, is a time, value rules) of one property."""
    _unknown(name, set(spec) - NOTES - {"type", "format", *BOUNDS})
    kinds = [spec["type"]] if isinstance(spec.get("type"), str) else list(spec.get("type", []))
    kind = [k for k in kinds if k != "null"]
    if len(kind) != 1 or kind[0] not in COLUMN_OF:
        raise ValueError(f"{name}: one of {', '.join(COLUMN_OF)} (and null) is expected as type, not {spec.get('type')}")
    if name not in entity.fields or not isinstance(entity.schema[name].dataType, COLUMN_OF[kind[0]]):
        raise ValueError(f"{name}: {entity.source_name} has no column of JSON type {kind[0]} of that name")
    if spec.get("format", "date-time") != "date-time":
        raise ValueError(f"{name}: format {spec['format']} is not supported")
    text = {"minLength", "maxLength", "format"} & set(spec)
    number = {"minimum", "maximum"} & set(spec)
    if (text and kind[0] != "string") or (number and kind[0] == "string"):
        raise ValueError(f"{name}: {', '.join(sorted(text | number))} does not go with {kind[0]}")
    rules = [Rule(name, b, [v for v in spec[b] if v is not None] if b == "enum" else spec[b]) for b in BOUNDS if b in spec]
    return "null" in kinds, "format" in spec, rules


def compile_contract(document: dict, entity: Entity) -> Contract:
    """The contract of a schema document; rules come in the order of its properties."""
    _unknown("document", set(document) - NOTES - {"type", "properties", "required", "additionalProperties"})
    if document.get("type", "object") != "object" or document.get("additionalProperties", True) is not True:
        raise ValueError("a contract describes an object that may have further fields")
    required = list(document.get("required", []))
    if missing := [r for r in required if r not in document["properties"]]:
        raise ValueError(f"required but not described: {', '.join(missing)}")
    formats, rules = [], []
    for name, spec in document["properties"].items():
        nullable, is_time, own = _field(entity, name, spec)
        if nullable and name in required:
            raise ValueError(f"{name}: a required field that may be null cannot be told from a missing one")
        formats += [name] * is_time
        rules += own
    return Contract(required, formats, rules)


def load_contract(spark: SparkSession, path: str, entity: Entity) -> Contract:
    """The contract of a schema file at any path that Spark reads."""
    text = spark.read.text(path, wholetext=True).select(F.col("value")).first()
    if text is None:
        raise ValueError(f"{path} is empty")
    return compile_contract(json.loads(text[0]), entity)
