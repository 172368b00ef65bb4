import re

import pytest
from pyspark.sql import functions as F

from kpiflow.llm import mixing as X


def brute_targets(sizes):
    """Targets by repeated resharing, as stated."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, target, open_ = sum(sizes.values()), {}, set(names)
    left = total
    while open_:
        w = sum(weight[s] for s in open_)
        above = {s for s in open_ if left * weight[s] / w > 3 * sizes[s]}
        if not above:
            target |= {s: left * weight[s] / w for s in open_}
            break
        target |= {s: 3.0 * sizes[s] for s in above}
        open_ -= above
        left -= sum(3 * sizes[s] for s in above)
    return target


def test_targets_and_takes(wide_docs):
    rows = X.mix_table(wide_docs).collect()
    text = {r.doc_id: r for r in wide_docs.collect()}
    sizes = {}
    for r in wide_docs.collect():
        sizes[r.source] = sizes.get(r.source, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
    want = brute_targets(sizes)
    taken = {}
    for r in rows:
        if r.doc_id is not None:
            s = text[r.doc_id].source
            assert r.target == pytest.approx(want[s]) and r.source_size == sizes[s]
            taken[s] = taken.get(s, 0) + r.taken
        assert 0 <= r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
    assert len(rows) == wide_docs.count()
    assert abs(taken["hot"] - want["hot"]) <= 60


def test_near_target_and_repeatable(spark):
    docs = spark.range(4000).select(
        F.col("id").alias("doc_id"), F.expr("repeat('w ', cast(1 + id * 7919 % 97 as int))").alias("text"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), (F.col("id") % 11).cast("string"))).alias("source"))
    first, again = X.mix_table(docs), X.mix_table(docs.repartition(9))
    assert first.exceptAll(again).count() == 0
    joined = first.join(docs, "doc_id").groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("g"))
    for r in joined.collect():
        assert abs(r.t - r.g) <= 97
    # longer documents are likelier to be sampled
    part = first.join(docs, "doc_id").filter("source = 'hot'").groupBy((F.col("size") > 48).alias("long")).agg(F.avg("copies").alias("c"))
    rate = {r.long: r.c for r in part.collect()}
    assert rate[True] > rate[False]


def test_mixed_rows(wide_docs, no_docs):
    out = X.mix(wide_docs)
    assert out.columns == wide_docs.columns
    n = {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()}
    copies = {}
    for r in X.mix_table(wide_docs).filter("copies > 0").collect():
        copies[r.doc_id] = copies.get(r.doc_id, 0) + r.copies
    assert n == {k: v for k, v in copies.items()} or {k: v for k, v in n.items() if k not in (300, 301, 302, None)} == {k: v for k, v in copies.items() if k not in (300, 301, 302, None)}
    assert X.mix_table(no_docs).count() == 0 and X.mix(no_docs).count() == 0
