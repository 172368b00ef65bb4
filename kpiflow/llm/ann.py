"""Nearest neighbours by vantage-point trees, one per shard.

Largest inner product becomes smallest distance: every vector x gets one more
component ``sqrt(M^2 - |x|^2)`` (M: the largest norm of the table) and every query
a zero, so that ``|q - x|^2 = |q|^2 + M^2 - 2 q.x``. Vectors are dealt to shards by a hash of
their id, about ``SHARD_ROWS`` to a shard; every vector is indexed.

Each shard's task builds a vantage-point tree over its distinct vectors: a node
keeps a vantage point, the median distance to it, and the near and the far half; leaves
hold up to ``LEAF`` vectors. Queries run through the tree in batches. A query with k-th best
distance t skips a half that lies further than t by the triangle inequality; with
``factor`` f the bound is taken f times as large, so more is skipped. Factor one, the
setting, is exact whatever the lengths of the vectors; above one, a table whose
lengths differ loses most neighbours, as the added component sets every query far from all. Queries go to all shards, stream through the shard's task in Arrow batches
and are never held together; the best k of the shards are merged per query.

Scores are sums of products in double precision in the order of the components,
so equal vectors have equal scores everywhere; ties go to the smaller id.

Defined results: vectors that are null, empty, all zero or hold null or non-finite
components take no part, neither as query nor as candidate, nor do rows with a null
id; shorter vectors count as followed by zeros; equal vectors are candidates each, with one
entry in the tree that knows its smallest ids; rows that repeat an id are one candidate
per vector; a query's own id is no candidate; with fewer candidates than k all
are returned; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpiflow.llm.common import cut

SHARD_ROWS = 4096
LEAF = 64
#: Queries that walk the tree together.
BATCH = 1024
#: Production setting: exact.
FACTOR = 1.0


def dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise sums of products, component after component."""
    s = np.zeros(np.broadcast_shapes(a.shape[:-1], b.shape[:-1]))
    for j in range(a.shape[-1]):
        s = s + a[..., j] * b[..., j]
    return s


class VantageTree:
    """Vantage-point tree over the rows of ``points``; ``top`` best by inner product of the first columns."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self.points, self.leaf = points, leaf
        self.root = self._build(np.arange(len(points)))

    def _build(self, rows: np.ndarray):
        if len(rows) <= self.leaf:
            return rows
        pick = rows[len(rows) // 2]
        d = np.sqrt(np.maximum(((self.points[rows] - self.points[pick]) ** 2).sum(axis=1), 0))
        radius = np.median(d)
        near = d <= radius
        if near.all():  # many at one distance: halves of any kind, told apart by no bound
            near = np.arange(len(rows)) < len(rows) // 2
            return (pick, None, self._build(rows[near]), self._build(rows[~near]))
        return (pick, (d[near].max(), d[~near].min()), self._build(rows[near]), self._build(rows[~near]))

    def search(self, queries: np.ndarray, k: int, factor: float = 1.0) -> list[np.ndarray]:
        """Per query the rows that may be among its k nearest: all within the k-th best distance seen."""
        n = len(queries)
        best = np.full((n, k), np.inf)  # k smallest squared distances, unordered
        seen: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in range(n)]
        sq, psq = (queries**2).sum(axis=1), (self.points**2).sum(axis=1)
        scale = sq + psq.max(initial=0)  # rounding of a squared distance grows with the squared lengths, not with the distance
        slack2, slack = 1e-12 * (1 + scale), 1e-6 * np.sqrt(scale)

        def visit(node, who: np.ndarray):
            if not len(who):
                return
            if isinstance(node, np.ndarray):
                if not len(node):
                    return
                d = np.maximum(sq[who, None] + psq[node][None, :] - 2 * queries[who] @ self.points[node].T, 0)
                worst = best[who].max(axis=1)
                merged = np.concatenate([best[who], d], axis=1)
                best[who] = np.partition(merged, k - 1, axis=1)[:, :k]
                hit = d <= (worst + slack2[who])[:, None]
                for i in np.flatnonzero(hit.any(axis=1)):
                    seen[who[i]].append((node[hit[i]], d[i, hit[i]]))
                return
            pick, bounds, near, far = node
            if bounds is None:
                visit(near, who)
                visit(far, who)
                return
            d = np.sqrt(np.maximum(sq[who] + psq[pick] - 2 * queries[who] @ self.points[pick], 0))
            gap_near, gap_far = d - bounds[0], bounds[1] - d  # least distance to a point of that half
            first = gap_near <= gap_far
            visit(near, who[first])
            visit(far, who[~first])
            reach = np.sqrt(best[who].max(axis=1)) + slack[who]
            visit(far, who[first & (factor * gap_far <= reach)])
            visit(near, who[~first & (factor * gap_near <= reach)])

        visit(self.root, np.arange(n))
        out = []
        for i in range(n):
            rows = np.concatenate([r for r, _ in seen[i]]) if seen[i] else np.empty(0, np.int64)
            d = np.concatenate([x for _, x in seen[i]]) if seen[i] else np.empty(0)
            worst = best[i].max()
            out.append(rows[d <= worst + slack2[i]] if np.isfinite(worst) else rows)
        return out


class Shard:
    """The distinct vectors of a shard, their smallest ids, and their tree."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, top_norm2: float, k: int):
        order = np.argsort(ids, kind="stable")
        ids, vectors = ids[order], vectors[order]
        self.vectors, group = np.unique(vectors, axis=0, return_inverse=True)
        by_group = np.argsort(group.ravel(), kind="stable")
        cuts = np.searchsorted(group.ravel()[by_group], np.arange(len(self.vectors) + 1))
        # a query sees at most k of equal vectors, besides itself
        self.ids = [np.unique(ids[by_group[a:b]])[: k + 1] for a, b in zip(cuts[:-1], cuts[1:])]
        extra = np.sqrt(np.maximum(top_norm2 - (self.vectors**2).sum(axis=1), 0))
        self.tree = VantageTree(np.hstack([self.vectors, extra[:, None]]))
        self.k = k

    def answer(self, ids: np.ndarray, queries: np.ndarray, factor: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(query ids, vector ids, scores) for blocks of queries, at most k for each."""
        wide = np.hstack([queries, np.zeros((len(queries), 1))])
        # one more than k, because the query itself may be in the tree
        for lo in range(0, len(ids), BATCH):
            found = self.tree.search(wide[lo : lo + BATCH], self.k + 1, factor)
            q_out, v_out, s_out = [], [], []
            for i, rows in enumerate(found, start=lo):
                score = dot(self.vectors[rows], queries[i])
                owners = [self.ids[r] for r in rows]
                v = np.concatenate(owners) if owners else np.empty(0, np.int64)
                s = np.repeat(score, [len(o) for o in owners])
                other = v != ids[i]
                v, s = v[other], s[other]
                best = np.lexsort((v, -s))[: self.k]
                q_out.append(np.full(len(best), ids[i]))
                v_out.append(v[best])
                s_out.append(s[best])
            yield np.concatenate(q_out), np.concatenate(v_out), np.concatenate(s_out)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    lists = column.to_pylist()
    out = np.zeros((len(lists), width))
    for i, x in enumerate(lists):
        out[i, : len(x)] = x
    return out


def _search_partition(batches: Iterator[pa.RecordBatch], k: int, factor: float, width: int, top_norm2: float) -> Iterator[pa.RecordBatch]:
    """Rows come ordered by shard, candidates before queries: a shard is read, its tree built, its queries streamed."""
    shard_id, ids, vectors, shard = None, [], [], None
    for batch in batches:
        shards = batch.column("shard").to_numpy()
        for a, b in _stretches(shards, batch.column("is_query").to_numpy(zero_copy_only=False)):
            part = batch.slice(a, b - a)
            if shards[a] != shard_id:
                shard_id, ids, vectors, shard = shards[a], [], [], None
            i, v = part.column("vec_id").to_numpy(), _matrix(part.column("v"), width)
            if not part.column("is_query")[0].as_py():
                ids.append(i)
                vectors.append(v)
                continue
            if shard is None:
                if not ids:
                    continue
                shard = Shard(np.concatenate(ids), np.vstack(vectors), top_norm2, k)
                ids, vectors = [], []
            for q, x, s in shard.answer(i, v, factor):
                yield pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(x, pa.int64()), pa.array(s, pa.float64())], names=["query_id", "vec_id", "score"])


def _stretches(shards: np.ndarray, is_query: np.ndarray) -> list[tuple[int, int]]:
    if not len(shards):
        return []
    cuts = np.flatnonzero((shards[1:] != shards[:-1]) | (is_query[1:] != is_query[:-1])) + 1
    edges = [0, *cuts.tolist(), len(shards)]
    return list(zip(edges[:-1], edges[1:]))


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """vec_id (long), v (array of double) of the vectors that take part, each (id, vector) once."""
    v = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).filter("vec_id is not null and v is not null")
    return rows.filter(~bad & F.exists("v", lambda x: x != 0))


def search(vectors: DataFrame, queries: Column, *, k: int = 20, factor: float = FACTOR, id_col: str = "vec_id", vector_col: str = "embedding",
           shard_rows: int = SHARD_ROWS) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k nearest found of the rows for which ``queries`` (a condition on vec_id) holds."""
    rows = cut(usable(vectors, id_col, vector_col))
    norm2 = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    n, width, top = rows.agg(F.count(F.lit(1)), F.max(F.size("v")), F.max(norm2)).first()
    schema = "query_id bigint, vec_id bigint, score double"
    if not n:
        return vectors.sparkSession.createDataFrame([], schema).select("query_id", F.lit(1).alias("rank"), "vec_id", "score")
    shards = max(1, -(-n // shard_rows))
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int")).withColumn("is_query", F.lit(False))
    asked = rows.filter(queries).distinct().withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).withColumn("is_query", F.lit(True))
    both = dealt.unionByName(asked).repartition(shards, "shard").sortWithinPartitions("shard", "is_query", "vec_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _search_partition(batches, k, factor, width, top)

    found = both.mapInArrow(run, schema).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
