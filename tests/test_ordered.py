"""The range-partitioned ordered scan equals plain whole-group windows
(brute force) on a skewed input: one hot group, many equal timestamps."""

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from kpiflow.plans.ordered import ordered_scan


def test_ordered_scan_matches_whole_group_windows(spark):
    base = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(3000):
        group = "hot" if i % 10 else f"g{i % 7}"  # 90 % of the rows in one group
        ts = base + dt.timedelta(seconds=(i * 7919) % 600 // 5)  # many ties per timestamp
        rows.append((group, ts, i, float((i * 31) % 997)))
    df = spark.createDataFrame(rows, "g string, ts timestamp, seq long, v double")
    got = ordered_scan(df, ["g"], ["ts", "seq"], max_col="v", ranges=16).select("g", "seq", "_pos", "_max_before")
    w = Window.partitionBy("g").orderBy("ts", "seq")
    want = df.select(
        "g", "seq",
        (F.row_number().over(w) - 1).alias("_pos"),
        F.max("v").over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("_max_before"),
    )
    assert got.count() == len(rows)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_ordered_scan_on_empty_input(spark):
    df = spark.createDataFrame([], "g string, ts timestamp, seq long, v double")
    assert ordered_scan(df, ["g"], ["ts", "seq"], max_col="v").count() == 0
