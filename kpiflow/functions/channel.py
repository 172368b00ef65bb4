"""P5: marketing channel normalisation as a native expression (no UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's: referrer substrings per channel.
SEARCH_REFERRERS = ["google", "bing"]
SOCIAL_REFERRERS = ["facebook", "instagram", "tiktok"]


def _contains_any(text: Column, needles: list[str]) -> Column:
    cond = None
    for n in needles:
        c = text.contains(n)
        cond = c if cond is None else (cond | c)
    return cond


def normalize_channel(referrer: Column | str = "referrer", channel: Column | str = "channel") -> Column:
    """Non-empty channel wins; else derive it from the referrer (case-insensitive).

    No referrer (null or empty) -> direct; google/bing -> organic;
    facebook/instagram/tiktok -> social; anything else -> affiliate.
    """
    ref = F.col(referrer) if isinstance(referrer, str) else referrer
    ch = F.col(channel) if isinstance(channel, str) else channel
    low = F.lower(ref)
    return (
        F.when(ch.isNotNull() & (ch != ""), ch)
        .when(ref.isNull() | (ref == ""), F.lit("direct"))
        .when(_contains_any(low, SEARCH_REFERRERS), F.lit("organic"))
        .when(_contains_any(low, SOCIAL_REFERRERS), F.lit("social"))
        .otherwise(F.lit("affiliate"))
    )
