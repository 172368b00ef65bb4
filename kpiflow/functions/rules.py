"""V1/V2/V4/V5: validation rules compiled to Column expressions.

Required-field sets differ between the reference's code paths (finding D3),
so they are named profiles. No per-row Python: each rule is a boolean Column
and violations are gathered with ``array_compact(array(when(...)))``.
"""

from __future__ import annotations

from dataclasses import dataclass
from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's: required-field profiles.
REQUIRED = {
    "clickstream": {
        "bronze": ["event_id", "event_time", "session_id", "user_id"],
        "strict": [
            "event_id", "event_time", "event_type", "session_id", "user_id",
            "page_url", "channel", "device_type", "country_code", "schema_version",
        ],
    },
    "orders": {
        "bronze": ["order_id", "event_time", "session_id", "user_id"],
        "strict": [
            "order_id", "event_time", "session_id", "user_id", "status", "payment_method",
            "currency", "order_value", "items_count", "fraud_score", "schema_version",
        ],
        "contract": [
            "order_id", "event_time", "session_id", "user_id", "status", "payment_method",
            "currency", "order_value", "schema_version",
        ],
    },
}

REQUIRED["clickstream"]["contract"] = REQUIRED["clickstream"]["strict"]

# Fixed values that must equal the reference's JSON contracts (enums and bounds).
CLICK_EVENT_TYPES = ["page_view", "product_view", "add_to_cart", "checkout_started", "search", "ad_click"]
CHANNELS = ["organic", "paid_search", "social", "email", "affiliate", "direct"]
DEVICE_TYPES = ["mobile", "desktop", "tablet"]
ORDER_STATUSES = ["authorized", "captured", "declined", "refunded"]
PAYMENT_METHODS = ["card", "wallet", "upi", "paypal"]


@dataclass(frozen=True)
class Rule:
    field: str
    kind: str  # enum | minLength | maxLength | minimum | maximum
    arg: object

    def broken(self) -> Column:
        c = F.col(self.field)
        if self.kind == "enum":
            return ~c.isin(*self.arg)
        if self.kind == "minLength":
            return F.length(c) < self.arg
        if self.kind == "maxLength":
            return F.length(c) > self.arg
        if self.kind == "minimum":
            return c < self.arg
        if self.kind == "maximum":
            return c > self.arg
        raise ValueError(self.kind)

    @property
    def label(self) -> str:
        return f"{self.field}:{self.kind}"


CONTRACT_RULES = {
    "clickstream": [
        Rule("event_id", "minLength", 10),
        Rule("event_type", "enum", CLICK_EVENT_TYPES),
        Rule("session_id", "minLength", 8),
        Rule("user_id", "minLength", 8),
        Rule("channel", "enum", CHANNELS),
        Rule("device_type", "enum", DEVICE_TYPES),
        Rule("country_code", "minLength", 2),
        Rule("country_code", "maxLength", 2),
        Rule("schema_version", "minimum", 1),
    ],
    "orders": [
        Rule("order_id", "minLength", 10),
        Rule("session_id", "minLength", 8),
        Rule("user_id", "minLength", 8),
        Rule("status", "enum", ORDER_STATUSES),
        Rule("payment_method", "enum", PAYMENT_METHODS),
        Rule("currency", "minLength", 3),
        Rule("currency", "maxLength", 3),
        Rule("order_value", "minimum", 0),
        Rule("items_count", "minimum", 1),
        Rule("fraud_score", "minimum", 0),
        Rule("fraud_score", "maximum", 1),
        Rule("shipping_country", "minLength", 2),
        Rule("shipping_country", "maxLength", 2),
        Rule("schema_version", "minimum", 1),
    ],
}


@dataclass(frozen=True)
class Contract:
    """What a contract checks: fields that must be there, times that must be readable, rules on values."""

    required: list[str]
    formats: list[str]
    rules: list[Rule]


def contract_of(source_name: str) -> Contract:
    """The contract in force; ``kpiflow.functions.contract`` compiles others from schema documents."""
    return Contract(REQUIRED[source_name]["contract"], ["event_time"], CONTRACT_RULES[source_name])


def is_missing(c: Column, blank_is_null: bool) -> Column:
    return (c.isNull() | (c.cast("string") == "")) if blank_is_null else c.isNull()


def contract_violations(contract: Contract | str) -> Column:
    """V4: ``field:rule`` labels of broken draft-07 rules, on a parsed frame
    whose ``event_time`` is still the raw string.

    Order: ``field:required`` (contract order), ``field:type`` (wrong JSON
    type, from ``mismatched_fields``), ``field:format``, then the value
    rules. Value rules only fire on non-null values, so nullable fields pass
    when null. A source name stands for its contract in force.
    """
    if isinstance(contract, str):
        contract = contract_of(contract)
    required = [
        F.when(F.col(c).isNull() & ~F.array_contains(F.col("mismatched_fields"), c), F.lit(f"{c}:required"))
        for c in contract.required
    ]
    types = F.transform(F.col("mismatched_fields"), lambda x: F.concat(x, F.lit(":type")))
    formats = [F.when(F.col(c).isNotNull() & F.expr(f"try_to_timestamp(`{c}`)").isNull(), F.lit(f"{c}:format")) for c in contract.formats]
    rules_ = [F.when(F.col(r.field).isNotNull() & r.broken(), F.lit(r.label)) for r in contract.rules]
    return F.array_compact(F.concat(F.array(*required), types, F.array(*formats, *rules_)))
