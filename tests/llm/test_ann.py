import numpy as np
import pytest
from pyspark.sql import functions as F

from kpiflow.llm import ann

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def table(spark, n=900, dim=8, copies=300):
    draw = np.random.default_rng(3)
    centres = draw.normal(size=(6, dim))
    rows = [(i, [float(np.float32(x)) for x in centres[i % 6] + 0.4 * draw.normal(size=dim)], i % 6) for i in range(n)]
    rows += [(n + i, rows[5][1], 0) for i in range(copies)]  # a common vector
    return spark.createDataFrame(rows, SCHEMA), rows


def brute(rows, k):
    rows = [(i, np.array(v, dtype=float)) for i, v, _ in rows]
    m = np.array([v for _, v in rows])
    out = {}
    for i, q in rows:
        if i % 20 == 0:
            s = ann.dot(m, q)
            best = sorted(((-x, j) for x, (j, _) in zip(s, rows) if j != i))[:k]
            out[i] = [(j, -x) for x, j in best]
    return out


@pytest.mark.parametrize("factor", [1.0, ann.FACTOR])
def test_against_brute_force(spark, factor):
    df, rows = table(spark)
    want = brute(rows, 20)
    got = {}
    for r in ann.search(df, F.col("vec_id") % 20 == 0, factor=factor, shard_rows=400).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(got[r.query_id])
    if factor == 1.0:
        assert got == want
    else:
        hits = sum(len({a for a, _ in got[q]} & {a for a, _ in want[q]}) for q in want)
        assert hits >= 0.9 * 20 * len(want)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 1), (20, [0.0, 2.0], 1), (1, None, 1), (2, [], 1), (3, [0.0, 0.0], 1), (4, [nan, 1.0], 1), (5, [inf, 1.0], 1),
            (6, [1.0, None], 1), (None, [1.0, 1.0], 1), (7, [1.0], 1), (8, [1.0, 1.0, 1.0], 1), (40, [0.0, 0.0], 1), (9, [1.0, 0.0], 1), (9, [1.0, 0.0], 1)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("v", F.lit("own")).withColumn("shard", F.lit(1))
    got = {}
    for r in ann.search(df, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert got == {0: [(1, 7, 1.0), (2, 8, 1.0), (3, 9, 1.0), (4, 20, 0.0)], 20: [(1, 8, 2.0), (2, 0, 0.0), (3, 7, 0.0), (4, 9, 0.0)]}
    assert ann.search(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_tree_skips_points():
    draw = np.random.default_rng(1)
    points = np.concatenate([c + 0.05 * draw.normal(size=(400, 4)) for c in 5 * draw.normal(size=(8, 4))])
    tree = ann.VantageTree(points)
    queries = points[::100]
    exact = tree.search(queries, 10)
    for q, rows in zip(queries, exact):
        d = ((points - q) ** 2).sum(axis=1)
        assert set(np.argsort(d, kind="stable")[:10]) <= set(rows) or np.sort(d)[:10].max() == pytest.approx(np.sort(d[rows])[:10].max())
        assert len(rows) < len(points) / 2


@pytest.mark.parametrize("kind", ["one very long", "log-normal", "one huge"])
def test_lengths_that_differ(spark, kind):
    draw = np.random.default_rng(5)
    points = draw.normal(size=(1200, 16))
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    if kind == "log-normal":
        points *= np.exp(draw.normal(size=(1200, 1)))
    else:
        points[7] *= 10 if kind == "one very long" else 1e9
    rows = [(i, [float(np.float32(x)) for x in v], 0) for i, v in enumerate(points)]
    want = {q: [v for v, _ in found] for q, found in brute(rows, 20).items()}
    got = {}
    for r in ann.search(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 20 == 0, shard_rows=600).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert got == want
