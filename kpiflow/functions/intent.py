"""Session intent score as a native expression (no UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's: base intent per event type,
# other/null types 0.10; order value adds min(value / 500, 0.20), capped at 1.
INTENT_BASE = {
    "page_view": 0.15,
    "search": 0.25,
    "product_view": 0.45,
    "add_to_cart": 0.75,
    "checkout_started": 0.9,
}
INTENT_OTHER = 0.1
ORDER_VALUE_DIVISOR = 500.0
ORDER_BONUS_CAP = 0.2


def intent_base(event_type: Column | str = "event_type") -> Column:
    et = F.col(event_type) if isinstance(event_type, str) else event_type
    expr = None
    for name, score in INTENT_BASE.items():
        expr = F.when(et == name, F.lit(score)) if expr is None else expr.when(et == name, F.lit(score))
    return expr.otherwise(F.lit(INTENT_OTHER))


def session_intent_score(event_type: Column | str = "event_type", order_value: Column | str = "order_value") -> Column:
    """base(event_type), plus the order bonus when order_value is non-null and non-zero.

    NaN order values are treated as null (finding D19).
    """
    ov = F.col(order_value) if isinstance(order_value, str) else order_value
    base = intent_base(event_type)
    bonus = F.least(ov / F.lit(ORDER_VALUE_DIVISOR), F.lit(ORDER_BONUS_CAP))
    has_value = ov.isNotNull() & ~F.isnan(ov) & (ov != 0)
    return F.when(has_value, F.least(F.lit(1.0), base + bonus)).otherwise(base)
