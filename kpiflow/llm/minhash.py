"""Near-duplicate documents by HyperMinHash.

Words are maximal runs of non-blank characters with A-Z lower-cased; a document's
set is its distinct five-word shingles (all words as one shingle, if fewer). Two
documents are linked when ``100 * |A & B| >= 85 * |A | B|``; groups are the
connected components of the links.

1. One pass gives each document its set size, a 128-bit digest of its word sequence
   and a HyperMinHash sketch: ``BUCKETS`` buckets, each holding the smallest hash of
   its shingles as 6 bits of leading zeros and 10 bits of mantissa. Empty buckets
   copy a bucket drawn by a fixed probe sequence.
2. Documents of one word sequence are one node (copies meet by digest, in a grouped
   minimum), so groups of copies cost nothing below.
3. Bands of ``BAND`` registers: nodes that agree on a band share a bucket. In each
   bucket every node is paired with the smallest one only. Pairs pass the set
   sizes (exact), then the Jaccard estimate of the sketches, corrected for
   registers that agree by chance, with a margin of ``MARGIN`` standard errors, then the
   full sets.
4. Where a bucket still holds several components, its nodes outside the largest one
   are compared with all nodes of the bucket, in blocks of ``BLOCK`` by ``BLOCK``: a pair only in the
   first band that it shares, by its estimate first and then on full sets inside the
   task, which returns no more links than nodes. Every pair that
   shares a band is thus in one component or compared, without pairs being
   listed. At 32 bands of 5 a pair at 0.85 shares none with probability 7e-9.

Defined results: null, empty or blank text has 0 shingles and is linked with nothing;
rows that repeat are one group; a doc_id with several texts links through each of
them; a null doc_id is reported with the smallest other id of its group, if any;
an empty table gives an empty result. Only the id and text columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiflow.llm.common import cut
from kpiflow.llm.components import connected_components

SHINGLE = 5
BUCKETS, BAND = 160, 5
MANTISSA = 10
MARGIN = 5.0
BLOCK = 512
#: Tasks that the join of one bucket with its head is dealt to.
SALT = 8
#: Link when SHARE[0] * intersection >= SHARE[1] * union.
SHARE = (100, 85)

_STEPS = np.array([xxhash.xxh3_64_intdigest(b"place %d" % i) | 1 for i in range(SHINGLE)], dtype=np.uint64)
_PROBES = np.array([[xxhash.xxh3_64_intdigest(b"probe %d %d" % (b, j)) % BUCKETS for j in range(64)] for b in range(BUCKETS)])
_EMPTY = np.uint64(2**64 - 1)


class _WordHashes(dict):
    """Hash of each word; forgets everything when it holds too many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


def shingle_set(words: list[bytes], hashes: dict) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles."""
    n = len(words)
    if n == 0:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(hashes.__getitem__, words), dtype=np.uint64, count=n)
    width = min(n, SHINGLE)
    h = np.full(n - width + 1, width, np.uint64)
    for j in range(width):
        h += w[j : n - width + 1 + j] * _STEPS[j]
    return np.unique(_mix(h))


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """HyperMinHash registers, one row of BUCKETS uint16 per set (none of them empty)."""
    n = len(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    h = np.concatenate(sets) if n else np.empty(0, np.uint64)
    low = np.full(n * BUCKETS, _EMPTY)
    np.minimum.at(low, owner * BUCKETS + (h % np.uint64(BUCKETS)).astype(np.int64), _mix(h + np.uint64(0x9E3779B97F4A7C15)))
    low = low.reshape(n, BUCKETS)
    full = low != _EMPTY
    done, out = full.copy(), low.copy()
    for j in range(_PROBES.shape[1]):
        if done.all():
            break
        take = ~done & full[:, _PROBES[:, j]]
        out = np.where(take, low[:, _PROBES[:, j]], out)
        done |= take
    for step in range(1, BUCKETS):  # whatever no probe has met: the next full bucket
        if done.all():
            break
        take = ~done & np.roll(full, -step, axis=1)
        out = np.where(take, np.roll(low, -step, axis=1), out)
        done |= take
    zeros = np.zeros(out.shape, np.uint64)  # leading zeros of the minimum
    rest = out.copy()
    for bit in (32, 16, 8, 4, 2, 1):
        small = rest < (np.uint64(1) << np.uint64(64 - bit))
        zeros += np.where(small, np.uint64(bit), np.uint64(0))
        rest = np.where(small, rest << np.uint64(bit), rest)
    mantissa = (rest << np.uint64(1)) >> np.uint64(64 - MANTISSA)
    return ((zeros << np.uint64(MANTISSA)) | mantissa).astype(np.uint16)


def jaccard_estimate(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Share of equal registers, corrected for chance.

    Two unrelated minima fall into one register value with probability
    ``0.7213 * 2**-MANTISSA * n m / (n + m)**2``: their density times the mean
    relative width ``1 / (2 ln 2)`` of a value.
    """
    n, m = n.astype(float), m.astype(float)
    chance = 0.5 / np.log(2) * 2.0**-MANTISSA * n * m / (n + m) ** 2
    return ((a == b).mean(axis=1) - chance) / (1 - chance)


def estimate_floor(n: np.ndarray, m: np.ndarray, margin: float = MARGIN) -> np.ndarray:
    """The estimate below which a pair is not at the link threshold, by ``margin`` standard errors."""
    t = SHARE[1] / SHARE[0]
    drawn = BUCKETS * (1 - np.exp(-np.minimum(n, m) / BUCKETS))
    return t - margin * np.sqrt(t * (1 - t) / drawn)


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = _WordHashes()
    for batch in batches:
        for lo in range(0, batch.num_rows, 1000):
            part = batch.slice(lo, 1000)
            sizes, nodes, sets = [], [], []
            for text in part.column("text"):
                words = words_of(text.as_py())
                s = shingle_set(words, hashes)
                sizes.append(len(s))
                nodes.append(hashlib.blake2b(b" ".join(words), digest_size=16).digest() if words else None)
                if words:
                    sets.append(s)
            sketch = iter(registers(sets))
            sketched = [next(sketch).tobytes() if x is not None else None for x in nodes]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("text_key"), pa.array(sizes, pa.int64()), pa.array(nodes, pa.binary()), pa.array(sketched, pa.binary())],
                names=["doc_id", "text_key", "n_shingles", "node", "sketch"],
            )


def sketches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_key, n_shingles, node (digest of the word sequence), sketch; null node without words."""
    rows = docs.select(F.col(id_col).alias("doc_id"), text_key(F.col(text_col)).alias("text_key"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_sketch, f"doc_id {kind}, text_key binary, n_shingles bigint, node binary, sketch binary")


def text_key(text: Column) -> Column:
    """Tells apart different texts under one doc_id."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def bands(nodes: DataFrame) -> DataFrame:
    """(bucket, band, node, n) for every band of every node."""
    width = 2 * BAND
    keys = [F.xxhash64(F.lit(i), F.substring(F.col("sketch"), i * width + 1, width)) for i in range(BUCKETS // BAND)]
    return nodes.select("node", "n", F.posexplode(F.array(*keys)).alias("band", "bucket"))


def _estimated(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        if len(pdf):
            a = np.frombuffer(b"".join(pdf["sa"]), np.uint16).reshape(len(pdf), BUCKETS)
            b = np.frombuffer(b"".join(pdf["sb"]), np.uint16).reshape(len(pdf), BUCKETS)
            n, m = pdf["na"].to_numpy(), pdf["nb"].to_numpy()
            pdf = pdf[jaccard_estimate(a, b, n, m) >= estimate_floor(n, m)]
        yield pdf[["a", "b"]]


def _linked(inter: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    return SHARE[0] * inter >= SHARE[1] * (n + m - inter)


def _verified(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    hashes, last, mine = _WordHashes(), None, None
    for pdf in batches:
        keep = []
        for a, ta, tb in zip(pdf["a"], pdf["ta"], pdf["tb"]):
            if a != last:  # rows come ordered by a
                last, mine = a, shingle_set(words_of(ta), hashes)
            other = shingle_set(words_of(tb), hashes)
            inter = len(np.intersect1d(mine, other, assume_unique=True))
            keep.append(bool(_linked(inter, len(mine), len(other))))
        yield pdf.loc[keep, ["a", "b"]]


def _block_links(pdf: pd.DataFrame) -> pd.DataFrame:
    """Links between the probes and the rest of a block that join its components; a spanning forest of them.

    A pair is compared in its first common band only, and of two probes once.
    """
    hashes = _WordHashes()
    pdf = pdf.drop_duplicates(["node", "probe"])
    band, nodes, label = int(pdf["band"].iloc[0]), pdf["node"].tolist(), pdf["label"].tolist()
    probe, outside, size = pdf["probe"].to_numpy(), pdf["outside"].to_numpy(), pdf["n"].to_numpy()
    rest, probes = np.flatnonzero(~probe), np.flatnonzero(probe)
    if not len(rest) or not len(probes):
        return pd.DataFrame({"a": [], "b": []})
    regs = np.frombuffer(b"".join(pdf["sketch"]), np.uint16).reshape(len(pdf), BUCKETS)
    earlier = (_mix(regs.reshape(len(pdf), -1, BAND) + np.uint64(1)) * _STEPS[:BAND]).sum(axis=2)[:, :band]
    rank = pd.Series(nodes).rank(method="dense").to_numpy()
    rest_regs, rest_earlier = regs[rest], earlier[rest]
    least, most = SHARE[1] * np.maximum.outer(size[probes], size[rest]), SHARE[0] * np.minimum.outer(size[probes], size[rest])
    fits = most >= least
    sets: dict[int, np.ndarray] = {}
    texts = pdf["text"].tolist()
    root = {x: x for x in label}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    def full(i: int) -> np.ndarray:
        if i not in sets:
            sets[i] = shingle_set(words_of(texts[i]), hashes)
        return sets[i]

    a, b = [], []
    for k, p in enumerate(probes):
        open_ = fits[k] & ~(outside[rest] & (rank[rest] <= rank[p]))
        open_[open_] = ~(rest_earlier[open_] == earlier[p]).any(axis=1)
        near = np.flatnonzero(open_)
        if len(near):
            n = np.full(len(near), size[p])
            near = near[jaccard_estimate(rest_regs[near], regs[p][None, :], size[rest[near]], n) >= estimate_floor(size[rest[near]], n)]
        mine = find(label[p])
        for q in rest[near]:
            if (other := find(label[q])) == mine:
                continue
            inter = len(np.intersect1d(full(p), full(q), assume_unique=True))
            if _linked(inter, size[p], size[q]):
                root[mine] = other
                mine = other
                a.append(nodes[p])
                b.append(nodes[q])
    return pd.DataFrame({"a": a, "b": b})


def near_components(nodes: DataFrame, fetch: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(node, component) of all nodes that are linked with another.

    ``nodes``: node, n, sketch, one row each; ``fetch`` turns a table of nodes into (node, text), one row each.
    """
    banded = bands(nodes)
    heads = banded.groupBy("bucket").agg(F.min(F.struct("node", "n")).alias("head"), F.count(F.lit(1)).alias("m")).filter("m > 1")
    heads = cut(heads.select("bucket", F.col("head.node").alias("a"), F.col("head.n").alias("na"), "m"))
    salted = heads.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    shared = cut(banded.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALT)).cast("int")).join(salted, ["bucket", "salt"]).select("bucket", "band", "node", "n", "a", "na", "m"))
    close = F.lit(SHARE[0]) * F.least("na", "n") >= F.lit(SHARE[1]) * F.greatest("na", "n")
    pairs = shared.filter("node <> a").filter(close).select("a", F.col("node").alias("b")).distinct()
    side = lambda c: nodes.select(F.col("node").alias(c), F.col("n").alias(f"n{c}"), F.col("sketch").alias(f"s{c}"))
    pairs = cut(pairs.join(side("a"), "a").join(side("b"), "b").mapInPandas(_estimated, "a binary, b binary"))
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).unionByName(shared.filter("m > 2").select("node")).distinct()
    texts = cut(fetch(wanted))
    side = lambda c: texts.select(F.col("node").alias(c), F.col("text").alias(f"t{c}"))
    both = pairs.join(side("b"), "b").join(side("a"), "a").sortWithinPartitions("a")
    links = cut(both.mapInPandas(_verified, "a binary, b binary"))
    labels = cut(connected_components(links))

    # buckets that still hold several components
    left = cut(shared.filter("m > 2").join(labels, "node", "left").select("bucket", "band", "node", "n", F.coalesce("component", "node").alias("label")))
    by_label = left.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("c"))
    open_ = by_label.groupBy("bucket").agg(F.sum("c").alias("m"), F.max(F.struct("c", "label")).alias("top"), F.count(F.lit(1)).alias("k")).filter("k > 1")
    open_ = cut(open_.select("bucket", F.col("top.label").alias("top"), F.ceil(F.col("m") / BLOCK).alias("rows"), F.ceil((F.col("m") - F.col("top.c")) / BLOCK).alias("cols")))
    open_ = open_.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    h = F.xxhash64("node")
    left = left.withColumn("salt", F.pmod(h, F.lit(SALT)).cast("int")).join(open_, ["bucket", "salt"]).withColumn("outside", F.col("label") != F.col("top"))
    upto = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), F.col(c) - 1))
    own = ["bucket", "band", "node", "n", "label", "outside"]
    rest = left.select(*own, F.lit(False).alias("probe"), F.pmod(h, F.col("rows")).alias("i"), upto("cols").alias("j"))
    probes = left.filter("outside").select(*own, F.lit(True).alias("probe"), upto("rows").alias("i"), F.pmod(h, F.col("cols")).alias("j"))
    block = rest.unionByName(probes).join(texts.join(nodes.select("node", "sketch"), "node"), "node")
    more = block.groupBy("bucket", "i", "j").applyInPandas(_block_links, "a binary, b binary")
    more = cut(more.distinct())
    known = labels.select(F.col("node").alias("a"), F.col("component").alias("b"))
    return connected_components(known.unionByName(more))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, text_key, n_shingles, component_id, kept."""
    info = cut(sketches(docs, id_col, text_col))
    worded = info.filter("node is not null")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("at")
    nodes = cut(worded.groupBy("node").agg(first, F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch")))

    def fetch(wanted: DataFrame) -> DataFrame:
        at = nodes.join(wanted, "node").select("node", F.col("at.doc_id").alias("_id"), F.col("at.text_key").alias("_key"))
        text = docs.select(F.col(id_col).alias("_i"), text_key(F.col(text_col)).alias("_k"), F.col(text_col).alias("text"))
        found = text.join(at, F.col("_i").eqNullSafe(F.col("_id")) & (F.col("_k") == F.col("_key")))
        return found.select("node", "text").dropDuplicates(["node"])

    groups = near_components(nodes.select("node", "n", "sketch"), fetch)
    of = nodes.join(groups, "node", "left").select("node", F.coalesce("component", "node").alias("group"), F.col("at.doc_id").alias("first_id"))
    smallest = of.groupBy("group").agg(F.min("first_id").alias("component_id"))
    of = cut(of.join(smallest, "group").select("node", "component_id"))
    linked = worded.join(of, "node").select("doc_id", "text_key", "n_shingles", "component_id")
    alone = info.filter("node is null").select("doc_id", "text_key", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stand for their group; of rows that repeat id and text, one stays.

    Rows without words all stay. The table of what goes has id and text digest only.
    """
    found = cut(near_duplicates(docs, id_col, text_col))
    again = found.filter("kept and n_shingles > 0").groupBy("doc_id", "text_key").agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
    marked = found.filter("not kept").select("doc_id", "text_key", F.lit(True).alias("_gone")).distinct().unionByName(
        again.select("doc_id", "text_key", F.lit(False).alias("_gone")))
    marked = cut(marked.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), "_gone"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), F.col(id_col).alias("_i"), text_key(F.col(text_col)).alias("_k"))
    rows = rows.join(marked, F.col("_i").eqNullSafe(F.col("_id")) & (F.col("_k") == F.col("_key")), "left")
    once = rows.filter("not _gone").dropDuplicates(["_i", "_k"])
    return rows.filter("_gone is null").unionByName(once).select("_doc.*")
