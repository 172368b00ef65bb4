from pyspark.sql import functions as F

from kpiflow.llm import sharding as S


def check(sharded, n):
    per = sharded.groupBy("shard").agg(F.count(F.lit(1)).alias("n"), F.max("slot").alias("m"), F.countDistinct("slot").alias("d")).collect()
    assert all(r.m == r.n - 1 and r.d == r.n and 0 <= r.shard < n for r in per)
    return per


def test_bytes_are_even_under_skew(spark):
    rows = spark.range(6000).select(
        F.col("id").alias("doc_id"), F.expr("repeat('x', cast(20 + id % 37 as int))").alias("text"), F.lit("en").alias("lang"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), (F.col("id") % 5).cast("string"))).alias("source"))
    for n in (16, 5):
        out = S.kd_shard(rows, n)
        check(out, n)
        size = [r.b for r in out.groupBy("shard").agg(F.sum(F.length("text") + 1).alias("b")).collect()]
        assert len(size) == n and max(size) <= 1.02 * sum(size) / n and min(size) >= 0.98 * sum(size) / n
        assert out.count() == 6000 and out.select("doc_id").distinct().count() == 6000
    again = S.kd_shard(rows.repartition(7), 16).select("doc_id", "shard", "slot")
    assert again.exceptAll(S.kd_shard(rows, 16).select("doc_id", "shard", "slot")).count() == 0


def test_cuts_follow_the_tree(spark, odd_docs):
    """Every leaf is the set of rows that its cuts describe, recomputed row by row."""
    docs = odd_docs.filter("doc_id is not null").dropDuplicates(["doc_id"])
    levels, shard_of = S.kd_tree(docs, 6)
    size = S.byte_size(F.col("text"))
    dims = S.default_dims(size)
    rows = docs.select("doc_id", S.unit_hash(F.col("doc_id"), seed=S.SEED).alias("u"), *[c.alias(n) for n, c in dims.items()]).collect()
    want = {}
    for r in rows:
        node = 1
        for cuts in levels:
            cut = {c.node: c for c in cuts}.get(node)
            if cut:
                node = 2 * node + (0 if r[cut.dim] < cut.value or (r[cut.dim] == cut.value and r.u < cut.at) else 1)
        want[r.doc_id] = shard_of[node]
    assert {r.doc_id: r.shard for r in S.kd_shard(docs, 6).collect()} == want


def test_cuts_of_few_nodes_are_not_broadcast(wide_docs, monkeypatch):
    """The tree stands in expressions; the one broadcast left has the slots' offsets. More nodes than LITERALS give the same shards."""
    out = S.kd_shard(wide_docs, 16)
    assert out._jdf.queryExecution().executedPlan().toString().count("BroadcastExchange") <= 1
    few = {(r.doc_id, r.shard, r.slot) for r in out.select("doc_id", "shard", "slot").collect()}
    monkeypatch.setattr(S, "LITERALS", 1)
    assert {(r.doc_id, r.shard, r.slot) for r in S.kd_shard(wide_docs, 16).select("doc_id", "shard", "slot").collect()} == few


def test_odd_tables(wide_docs, no_docs):
    out = S.kd_shard(wide_docs, 4)
    assert out.columns == [*wide_docs.columns, "shard", "slot"] and out.count() == wide_docs.count()
    check(out, 4)
    digest = S.shard_digest(wide_docs)
    assert digest.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    assert {r.doc_id: (r.size, r.text_crc32) for r in digest.collect()}[300] == (1, 0)
    assert S.shard_digest(no_docs).count() == 0
    by_bytes = S.kd_shard(wide_docs, None, target_bytes=100_000)
    assert by_bytes.select("shard").distinct().count() >= 3


def test_written_shards(spark, odd_docs, tmp_path):
    S.write_shards(S.kd_shard(odd_docs, 3), str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == odd_docs.count()
