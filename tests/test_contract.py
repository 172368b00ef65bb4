"""Contracts compiled from schema documents."""

import json

import pytest
from pyspark.sql import functions as F

from kpiflow.functions import rules
from kpiflow.functions.contract import compile_contract, load_contract
from kpiflow.operators import ingest
from kpiflow.schemas import CLICKS, ENVELOPE, ORDERS

KIND = {"string": "string", "int": "integer", "double": "number"}


def document(entity):
    """The contract in force as a schema document."""
    contract = rules.contract_of(entity.source_name)
    properties = {f.name: {"type": KIND[f.dataType.simpleString()]} for f in entity.schema.fields}
    for name, spec in properties.items():
        if name not in contract.required:
            spec["type"] = [spec["type"], "null"]
        if name in contract.formats:
            spec["format"] = "date-time"
    for r in contract.rules:
        properties[r.field][r.kind] = r.arg
    return {"$schema": "http://json-schema.org/draft-07/schema#", "title": entity.source_name, "type": "object", "required": contract.required, "properties": properties}


@pytest.mark.parametrize("entity", [CLICKS, ORDERS], ids=lambda e: e.source_name)
def test_documents_give_the_rules_in_force(spark, entity, tmp_path):
    path = tmp_path / "contract.json"
    path.write_text(json.dumps(document(entity), indent=2))
    got, want = load_contract(spark, str(path), entity), rules.contract_of(entity.source_name)
    assert got.required == want.required and got.formats == want.formats
    assert sorted(map(str, got.rules)) == sorted(map(str, want.rules))


def test_a_compiled_contract_finds_violations(spark):
    contract = compile_contract({
        "type": "object", "required": ["event_id", "event_time"],
        "properties": {"event_id": {"type": "string", "minLength": 3}, "event_time": {"type": "string", "format": "date-time"},
                       "channel": {"type": ["string", "null"], "enum": ["email", None]}, "schema_version": {"type": "integer", "minimum": 2, "maximum": 3}}}, CLICKS)
    rows = ['{"event_id":"abc","event_time":"2024-01-01T00:00:00Z","channel":null,"schema_version":2}',
            '{"event_id":"ab","event_time":"soon","channel":"tv","schema_version":4}', '{"event_time":"2024-01-01T00:00:00Z","schema_version":"2"}']
    env = spark.createDataFrame([("k", v, None, 0, i) for i, v in enumerate(rows)], ENVELOPE)
    parsed = ingest.parse_payload(ingest.project_envelope(env), CLICKS, field_list=True)
    found = {r.kafka_offset: list(r.v) for r in parsed.select("kafka_offset", rules.contract_violations(contract).alias("v")).collect()}
    assert found == {0: [], 1: ["event_time:format", "event_id:minLength", "channel:enum", "schema_version:maximum"], 2: ["event_id:required", "schema_version:type"]}


@pytest.mark.parametrize("change", [
    {"pattern": "^a"}, {"type": "array"}, {"type": "integer"}, {"type": ["string", "integer"]}, {"format": "email"}, {"minimum": 1}, {"type": ["string", "null"]}])
def test_what_cannot_be_checked_is_an_error(change):
    doc = {"type": "object", "required": ["event_id"], "properties": {"event_id": {"type": "string", **change}}}
    with pytest.raises(ValueError):
        compile_contract(doc, CLICKS)


@pytest.mark.parametrize("change", [{"oneOf": []}, {"type": "array"}, {"additionalProperties": False}, {"required": ["other"]}, {"properties": {"other": {"type": "string"}}}])
def test_unknown_documents_are_errors(change):
    with pytest.raises(ValueError):
        compile_contract({"type": "object", "properties": {"event_id": {"type": "string"}}, **change}, CLICKS)


def test_null_rows(spark):
    contract = rules.contract_of("orders")
    env = spark.createDataFrame([("k", None, None, 0, 0)], ENVELOPE)
    parsed = ingest.parse_payload(ingest.project_envelope(env), ORDERS, field_list=True)
    assert parsed.select(F.size(rules.contract_violations(contract))).first()[0] == len(contract.required)
