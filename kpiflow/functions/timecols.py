"""Partition columns and minute bounds of an event time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def add_partition_columns(df: DataFrame, ts_col: str | Column = "event_time", with_minute: bool = True) -> DataFrame:
    """event_date (date), event_hour ('HH'), event_minute ('mm') of ``ts_col`` in UTC."""
    ts = F.col(ts_col) if isinstance(ts_col, str) else ts_col
    out = df.withColumn("event_date", F.to_date(ts)).withColumn("event_hour", F.date_format(ts, "HH"))
    if with_minute:
        out = out.withColumn("event_minute", F.date_format(ts, "mm"))
    return out


def minute_start(ts: Column) -> Column:
    return F.date_trunc("minute", ts)


def minute_end(ts: Column) -> Column:
    return F.date_trunc("minute", ts) + F.expr("INTERVAL 1 MINUTE")
