"""Ordered scans (running position / running max) without a hot task.

A running value over a whole group in some order (Kafka offsets per topic
partition, the largest event time that arrived earlier on a topic) cannot
be a window over the whole group: that puts the group in one task. Here the
leading order column (a timestamp) is cut into ``ranges`` quantile ranges
(``approxQuantile``: a distributed sketch; only the cut points reach the
driver), so even a group holding a third of all rows, or one burst minute,
is split into balanced contiguous ranges. The range id is a pure function of
the row (JVM-side ``Bucketizer``), so a recomputed stage gets the same ids.
Each (group, range) computes its local running value with a window whose
partition is that piece only; a per-(group, range) summary -- at most
groups x ranges rows -- gives every piece the value carried in from the
ranges before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ordered_scan(
    df: DataFrame,
    group_cols: list[str],
    order_cols: list[str],
    max_col: str | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """Add ``_pos`` (0-based position inside the group in ``order_cols``
    order) and, with ``max_col``, ``_max_before`` (largest ``max_col`` of the
    earlier rows of the group; NULL for the first)."""
    from pyspark.ml.feature import Bucketizer

    spark = df.sparkSession
    n = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = df.withColumn("_k", F.unix_micros(F.col(order_cols[0])).cast("double"))
    probs = [i / n for i in range(1, n)]
    cuts = sorted(set(keyed.approxQuantile("_k", probs, min(0.001, 0.1 / n)))) if probs else []
    inner = [c for c in cuts if c == c] or [0.0]  # Bucketizer needs >= 3 splits (empty input)
    splits = [float("-inf")] + inner + [float("inf")]
    ranged = Bucketizer(splits=splits, inputCol="_k", outputCol="_rp", handleInvalid="keep").transform(keyed)
    ranged = ranged.withColumn("_rp", F.col("_rp").cast("int")).drop("_k")
    in_range = Window.partitionBy(*group_cols, "_rp").orderBy(*order_cols)
    local = ranged.withColumn("_lpos", F.row_number().over(in_range) - 1)
    if max_col:
        local = local.withColumn(
            "_lmax_before", F.max(max_col).over(in_range.rowsBetween(Window.unboundedPreceding, -1))
        )
    # Per-(group, range) totals straight from the ranged rows: a partially
    # aggregated groupBy, independent of the window stage above.
    aggs = [F.count(F.lit(1)).alias("_c")] + ([F.max(max_col).alias("_m")] if max_col else [])
    summary = ranged.groupBy(*group_cols, "_rp").agg(*aggs)
    earlier = Window.partitionBy(*group_cols).orderBy("_rp").rowsBetween(Window.unboundedPreceding, -1)
    carried: list[Column] = [F.coalesce(F.sum("_c").over(earlier), F.lit(0)).alias("_base")]
    if max_col:
        carried.append(F.max("_m").over(earlier).alias("_carry_max"))
    summary = summary.select(*group_cols, "_rp", *carried)
    out = local.join(summary, group_cols + ["_rp"]).withColumn("_pos", F.col("_base") + F.col("_lpos"))
    drop = ["_rp", "_lpos", "_base"]
    if max_col:
        out = out.withColumn("_max_before", F.greatest(F.col("_carry_max"), F.col("_lmax_before")))
        drop += ["_lmax_before", "_carry_max"]
    return out.drop(*drop)
