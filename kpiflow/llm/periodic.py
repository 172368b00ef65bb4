"""Periodic runs of words by an online sparse diagonal DP.

A run of period q is a stretch of consecutive words in which words q apart are equal,
which no neighbouring word extends, at least ``least`` words and ``2 * q`` long, with no
smaller period. Reading the words from left to right, every earlier occurrence of the
current one at lag q lengthens the match on diagonal q by one; a diagonal that the
current word does not continue has ended, and if its match is long enough it emits
its run at once. Only the open diagonals are held.

Two things keep the DP sparse, and neither loses a run:

* A run of period q matches over at least ``max(q, least - q)`` words on its diagonal. So the
  unit that looks for earlier occurrences is not a single word but the seed that ends there:
  the last ``s`` words, with seeds of ``s = least / 2`` words for lags below ``least`` and,
  level by level, seeds of ``least, 2 * least, ...`` words for lags from their own length
  up to twice that. Seeds are named by doubling (pairs of names of half the length), so
  equal names mean equal words. Places whose seed has no earlier occurrence at such
  a lag are skipped, without leaving numpy.
* Inside a known run of period p a seed of ``2 * p`` words or more meets itself at multiples of p
  only, on diagonals that begin and end with that run. They are skipped as well, so a
  text of one repeated word costs no more than any other.

A text's words and seeds are held in one task; time grows with n log n.

Defined results: null or empty text has no words and no run; rows that repeat are treated
alike; an empty table gives an empty result; other columns pass through, whatever
their names.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kpiflow.llm.common import WORD

LEAST = 12


def _names(left: np.ndarray, right: np.ndarray, width: int) -> np.ndarray:
    """Names of the joined seeds that end at each place: ``left`` ends ``width`` words before ``right``; -1 before the first."""
    out = np.full(len(right), -1, np.int64)
    whole = (right[width:] >= 0) & (left[: len(left) - width] >= 0)
    pair = left[: len(left) - width][whole] * (len(right) + 1) + right[width:][whole]
    out[width:][whole] = np.unique(pair, return_inverse=True)[1]
    return out


def _candidates(seed: np.ndarray, size: int, low: int, high: int, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(places that may have an earlier occurrence at a lag in [low, high); all places by seed; where each place stands there)."""
    at = np.flatnonzero(seed >= 0)
    by_seed = at[np.argsort(seed[at], kind="stable")]
    same = np.concatenate(([False], seed[by_seed[1:]] == seed[by_seed[:-1]])) if len(by_seed) else np.empty(0, bool)
    lag = np.zeros(len(by_seed), np.int64)
    lag[1:] = by_seed[1:] - by_seed[:-1]
    same &= lag < high
    # inside a run, occurrences before it must still be within reach
    same &= (inside[by_seed] < 0) | (by_seed - high < inside[by_seed] + size - 2)
    rank = np.empty(len(seed), np.int64)
    rank[by_seed] = np.arange(len(by_seed))
    return np.sort(by_seed[same]), by_seed, rank


def _level(seed: np.ndarray, size: int, low: int, high: int, least: int, runs: dict) -> None:
    """The DP over one level of seeds; adds (start, end): period to ``runs``, end exclusive."""
    inside = np.full(len(seed), -1, np.int64)  # where a seed lies in a run of at most half its length, the run's start
    for (start, end), p in runs.items():
        if 2 * p <= size <= end - start:
            inside[start + size - 1 : end] = start
    places, by_seed, rank = _candidates(seed, size, low, high, inside)
    if not len(places):
        return
    first = np.searchsorted(seed[by_seed], seed[places], "left")  # where the occurrences of the seed begin
    by_seed_list = by_seed.tolist()
    active: dict[int, int] = {}
    last = -2

    def end_at(ended: dict[int, int], end: int) -> None:
        for q in sorted(ended):
            match = ended[q] + size - 1
            start = end - match - q
            if match >= q and match + q >= least:
                p = runs.get((start, end))
                if p is None or q % p:
                    runs[(start, end)] = q

    for i, lo, r, s in zip(places.tolist(), first.tolist(), rank[places].tolist(), inside[places].tolist()):
        if i != last + 1 and active:
            end_at(active, last + 1)
            active = {}
        nearest = i - low if s < 0 else min(i - low, s + size - 2)
        k = bisect_left(by_seed_list, nearest + 1, lo, r) - 1
        now = {}
        while k >= lo and i - by_seed_list[k] < high:
            q = i - by_seed_list[k]
            now[q] = active.pop(q, 0) + 1
            k -= 1
        if active:
            end_at(active, i)
        active, last = now, i
    if active:
        end_at(active, last + 1)


def word_runs(words: list, least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start and then period."""
    n = len(words)
    if n < least:
        return []
    known: dict = {}
    name = np.fromiter(map(known.setdefault, words, count()), np.int64, n)
    if len(known) == n:
        return []
    runs: dict[tuple[int, int], int] = {}
    # the first seeds, of least // 2 words, from names of powers of two
    half, powers, width = max(1, least // 2), {1: name}, 1
    while 2 * width <= half:
        powers[2 * width] = _names(powers[width], powers[width], width)
        width *= 2
    seed, size = powers[width], width
    while size < half:
        step = max(w for w in powers if w <= half - size)
        seed, size = _names(seed, powers[step], step), size + step
    low = 1
    while low <= n // 2:
        if len(np.unique(seed[seed >= 0])) == int((seed >= 0).sum()):
            break  # no seed comes twice, so no longer one does
        _level(seed, size, low, max(2 * size, low + 1), least, runs)
        low = 2 * size
        seed, size = _names(seed, seed, size), 2 * size
    return sorted((start, end - start, q) for (start, end), q in runs.items())


def kept_words(words: list, runs: list[tuple[int, int, int]]) -> list:
    """The words that no run repeats: of each run, its first period stays."""
    if not runs:
        return words
    edge = np.zeros(len(words) + 1, np.int64)
    for start, length, q in runs:
        edge[start + q] += 1
        edge[start + length] -= 1
    return [w for w, covered in zip(words, np.cumsum(edge)[:-1].tolist()) if not covered]


_FOUND = T.StructType([
    T.StructField("runs", T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")]))),
    T.StructField("collapsed", T.StringType()),
])


def _found(text: str | None, least: int) -> dict:
    words = (text or "").encode().split()  # bytes split at blanks, tabs, newlines, VT, FF and CR alone
    runs = word_runs(words, least)
    return {"runs": [{"start": s, "length": n, "period": q} for s, n, q in runs], "collapsed": b" ".join(kept_words(words, runs)).decode()}


def with_runs(docs: DataFrame, text: Column, least: int = LEAST) -> DataFrame:
    """``docs`` as a struct ``doc`` beside ``runs`` (start, length, period; by start) and ``collapsed``, the text without repetitions, words joined by blanks."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), text.alias("text"))
    schema = T.StructType([rows.schema["doc"], *_FOUND.fields])
    kind = pa.struct([
        ("runs", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))), ("collapsed", pa.string())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                found = pa.array([_found(t.as_py(), least) for t in part.column("text")], kind)
                yield pa.RecordBatch.from_arrays([part.column("doc"), found.field("runs"), found.field("collapsed")], names=["doc", "runs", "collapsed"])

    return rows.mapInArrow(scan, schema)


def collapse_runs(docs: DataFrame, text_col: str = "text", least: int = LEAST) -> DataFrame:
    """``docs`` with every run cut to its first period; texts without a run stay as they are."""
    found = with_runs(docs, F.col(f"`{text_col}`"), least)
    text = F.when(F.size("runs") > 0, F.col("collapsed")).otherwise(F.col("doc")[text_col])
    return found.select(*[text.alias(c) if c == text_col else F.col("doc")[c].alias(c) for c in docs.columns])


def planted_text(doc_id: Column, text: Column) -> Column:
    """The text of the query's contract: of every tenth document (by checksum of the id), the words from a place on repeat with a period."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")
    words = F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1))
    one = F.lit(1).cast("long")

    def repeated(w: Column) -> Column:
        n = F.size(w).cast("long")
        a = F.pmod(g, n)
        p = one + F.floor((n - a) / (F.lit(3) + g % 8)).cast("long")
        at = F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.when(i < a, i).otherwise(a + (i - a) % p).cast("int"))
        return F.array_join(F.transform(at, lambda i: F.get(w, i)), " ")

    # the words are made once, as the one element of an array
    planted = F.element_at(F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, repeated(w)).otherwise(F.lit(""))), 1)
    return F.when(h % 10 == 0, planted).otherwise(text)


def run_digest(docs: DataFrame, text: Column, id_col: str = "doc_id", least: int = LEAST) -> DataFrame:
    """Per row: doc_id, n_runs; start, length, period and exponent_milli of the longest run (ties: first, then smallest period); digests of all runs and of the collapsed text."""
    found = with_runs(docs.select(F.col(f"`{id_col}`").alias("doc_id"), text.alias("text")).select("doc_id", "text"), F.col("text"), least)
    top = F.element_at(F.array_sort(F.transform("runs", lambda r: F.struct((-r["length"]).alias("rest"), r["start"].alias("start"), r["period"].alias("period")))), 1)
    found = found.select(F.col("doc.doc_id").alias("doc_id"), "runs", "collapsed", F.when(F.size("runs") > 0, top).alias("top"))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("top.start").alias("start"), (-F.col("top.rest")).alias("length"), F.col("top.period").alias("period"),
        F.floor(-F.col("top.rest") * 1000 / F.col("top.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
