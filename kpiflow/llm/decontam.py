"""Benchmark decontamination: BM25 retrieval by block-max WAND, then overlap checks.

Index. Benchmark items are split in question and answer: what follows the last line that starts with ``A:`` or
``Answer:`` is the answer; without such a line all of the item is question. A posting holds an item's BM25 impact
for a question term divided by the item's own full score, so one threshold, ``THRESHOLD``, means the same share of
an item everywhere. Where the heaviest words that a contained question may lack weigh more, the item's own threshold
is what is left without them (its impacts are scaled to it), so retrieval loses no contained item, whatever
the other items are. Items are laid out in blocks of ``BLOCK``; each term keeps its largest impact per
block. Document frequencies and the mean length are counted over all items with
Spark; the index is cut in pieces of about ``PIECE_WORDS`` words. Pieces are taken one after the other: each
is built on the driver, broadcast, and given back once its hits are written, so no more than one
is held at a time, however large the benchmark.

Queries. Every passage of every document: windows of 128 words that start every 64 words for questions of up to
64 words, of twice the length and step for each class of questions up to twice as long. So each run of words as long as
a question lies whole in a window, and other items have no say in it. For a batch of windows
 - the sum of the terms' largest impacts drops windows that can reach nothing,
 - the sum of block maxima drops blocks that can hold no item above the threshold,
 - items of the blocks that are left get their full score.
All items at or above the threshold are retrieved; there is no top-k.

Verification. An item is contained when the window has at least ``OVERLAP`` of the
question's distinct five-word shingles, and the document that share of the answer's distinct words.

Words are runs of letters and digits, lower-cased. Defined results: null or empty
texts and items match nothing; an item with fewer than five question words counts
as one shingle; rows that repeat give one hit; null ids are kept as null; empty
tables give no hits. Only id and text columns are read; other columns pass through
``decontaminate`` and may have any name.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiflow.llm.common import cut
from kpiflow.llm.minhash import text_key

K1, B = 1.2, 0.75
THRESHOLD = 0.5
OVERLAP = 0.8
SHINGLE = 5
BLOCK = 16
PIECE_WORDS = 2_000_000
#: Windows scored together.
BATCH = 512

_WORD = re.compile(r"[^\W_]+")
_ANSWER = re.compile(r"\n[^\S\n]*(?:a|answer)[^\S\n]*:", re.I)


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def question_answer(text: str | None) -> tuple[list[str], list[str]]:
    text = (text or "").strip()
    marked = list(_ANSWER.finditer(text))
    at = marked[-1].start() if marked else 0
    question, answer = (words_of(text[:at]), words_of(text[at:])) if at > 0 else (words_of(text), [])
    return (question, answer) if question else (answer, [])


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        parts = [question_answer(x.as_py()) for x in batch.column("text")]
        yield pa.RecordBatch.from_arrays(
            [batch.column("item_id"), pa.array([q for q, _ in parts], pa.list_(pa.string())), pa.array([a for _, a in parts], pa.list_(pa.string()))],
            names=["item_id", "question", "answer"],
        )


def _shingles(tids: np.ndarray, width: int) -> np.ndarray:
    """64-bit codes of the shingles of ``width`` terms; a term outside the index (-1) makes codes that match nothing."""
    n = len(tids)
    if not 0 < width <= n:
        return np.empty(0, np.uint64)
    code = np.full(n - width + 1, width, np.uint64)
    bad = np.zeros(n - width + 1, bool)
    for j in range(width):
        t = tids[j : n - width + 1 + j]
        bad |= t < 0
        code = (code ^ t.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        code ^= code >> np.uint64(29)
    return code[~bad]


@dataclass
class Index:
    """One piece of the inverted index, in arrays."""

    vocab: dict[str, int]
    start: np.ndarray  # postings of term t: start[t] to start[t + 1]
    item: np.ndarray
    impact: np.ndarray
    block_start: np.ndarray  # block maxima of term t
    block: np.ndarray
    block_max: np.ndarray
    top: np.ndarray  # largest impact of each term
    questions: list[tuple[int, np.ndarray]]  # words of a shingle, and the shingles
    answers: list[np.ndarray]
    n_blocks: int
    window: int
    level: np.ndarray  # the share of an item's full score that counts as THRESHOLD


def half_window(n_words: int) -> int:
    """Step of the windows for questions of so many words: 64, or the next power of two."""
    return max(64, 1 << (n_words - 1).bit_length())


def build_index(questions: list[list[str]], answers: list[list[str]], df: dict[str, int], n_items: int, mean_length: float) -> Index:
    """The index of items whose questions share a window length."""
    vocab: dict[str, int] = {}
    rows = []
    for i, words in enumerate(questions):
        counts: dict[int, int] = {}
        for w in words:
            t = vocab.setdefault(w, len(vocab))
            counts[t] = counts.get(t, 0) + 1
        rows += [(t, i, c, len(words)) for t, c in counts.items()]
    r = np.array(rows, dtype=np.int64).reshape(-1, 4)
    by_term = np.array([df[w] for w in vocab], dtype=float)
    idf = np.log1p((n_items - by_term + 0.5) / (by_term + 0.5))
    t, i, tf, length = r[:, 0], r[:, 1], r[:, 2].astype(float), r[:, 3]
    impact = idf[t] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / max(mean_length, 1e-9)))
    own = np.bincount(i, impact, minlength=len(questions))
    impact = impact / np.maximum(own[i], 1e-12)
    level = np.full(len(questions), THRESHOLD)
    heavy = np.lexsort((-impact, i))
    bounds = np.searchsorted(i[heavy], np.arange(len(questions) + 1))
    for k, words in enumerate(questions):
        # each word that is missing costs a shingle at least
        shingles = len({tuple(words[j : j + SHINGLE]) for j in range(max(1, len(words) - SHINGLE + 1))})
        lacking = impact[heavy[bounds[k] : bounds[k + 1]]][: int((1 - OVERLAP) * shingles + 1e-9)].sum()
        level[k] = max(min(THRESHOLD, 1 - lacking), 1e-6)
    impact = impact * (THRESHOLD / level[i])
    order = np.lexsort((i, t))
    t, i, impact = t[order], i[order], impact[order]
    start = np.searchsorted(t, np.arange(len(vocab) + 1))
    first = np.flatnonzero(np.r_[True, (t[1:] != t[:-1]) | (i[1:] // BLOCK != i[:-1] // BLOCK)]) if len(t) else np.empty(0, np.int64)
    block_max = np.maximum.reduceat(impact, first) if len(first) else np.empty(0)
    top = np.maximum.reduceat(impact, start[:-1]) if len(vocab) else np.empty(0)
    for w in (w for words in answers for w in words):
        vocab.setdefault(w, len(vocab))  # words of answers alone have no postings
    ends = lambda x: np.r_[x, np.full(len(vocab) + 1 - len(x), x[-1])]
    top = np.r_[top, np.zeros(len(vocab) - len(top))]
    ids = lambda words: np.array([vocab[w] for w in words], dtype=np.int64)
    return Index(
        vocab, ends(start), i, impact, ends(np.searchsorted(t[first], np.arange(len(start)))), i[first] // BLOCK, block_max, top,
        [(w, np.unique(_shingles(ids(q), w))) for q in questions for w in (min(len(q), SHINGLE),)], [np.unique(ids(a)) for a in answers],
        -(-len(questions) // BLOCK), 2 * max([64, *(half_window(len(q)) for q in questions)]), level,
    )


def _runs(start: np.ndarray, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of all entries of the terms' lists, and how many each term has."""
    lo, n = start[terms], start[terms + 1] - start[terms]
    return np.repeat(lo - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum()), n


def retrieve(index: Index, window: np.ndarray, term: np.ndarray, n_windows: int, threshold: float) -> list[tuple[int, int, float]]:
    """(window, item, score) of all items at or above the threshold; (window, term) are the distinct terms of each window."""
    slack = threshold - 1e-9
    alive = np.bincount(window, index.top[term], minlength=n_windows) >= slack
    keep = alive[window]
    window, term = window[keep], term[keep]
    if not len(term):
        return []
    at, n = _runs(index.block_start, term)
    key = np.repeat(window, n) * index.n_blocks + index.block[at]
    bound = np.bincount(key, index.block_max[at], minlength=n_windows * index.n_blocks)
    hot = bound >= slack
    keep = hot.reshape(n_windows, -1).any(axis=1)[window]
    window, term = window[keep], term[keep]
    if not len(term):
        return []
    at, n = _runs(index.start, term)
    owner, item = np.repeat(window, n), index.item[at]
    keep = hot[owner * index.n_blocks + item // BLOCK]
    key, where = np.unique(owner[keep] * len(index.questions) + item[keep], return_inverse=True)
    score = np.bincount(where, index.impact[at][keep], minlength=len(key))
    good = score >= slack
    return [(int(k) // len(index.questions), int(k) % len(index.questions), float(s)) for k, s in zip(key[good], score[good])]


def _windows(tids: np.ndarray, size: int) -> list[tuple[int, int]]:
    step = size // 2
    return [(s, min(s + size, len(tids))) for s in range(0, max(1, len(tids) - step), step)]


def search(index: Index, texts: list[list[str]], threshold: float = THRESHOLD, overlap: float = OVERLAP) -> Iterator[tuple[int, int, float, float, float]]:
    """(text, item, score, question overlap, answer overlap) of every contained item, once per window."""
    get = index.vocab.get
    spans: list[tuple[int, np.ndarray, np.ndarray]] = []
    pairs: list[tuple[np.ndarray, np.ndarray]] = []

    def flush():
        if spans:
            w, t = (np.concatenate([p[k] for p in pairs]) for k in (0, 1))
            for win, item, score in retrieve(index, w, t, len(spans), threshold):
                text, tids, every = spans[win]
                (width, q), a = index.questions[item], index.answers[item]
                in_q = np.isin(q, _shingles(tids, width)).mean() if len(q) else 0.0
                if in_q < overlap:
                    continue
                in_a = np.isin(a, every).mean() if len(a) else 1.0
                if in_a >= overlap:
                    yield text, item, score * float(index.level[item]) / THRESHOLD, float(in_q), float(in_a)
        spans.clear()
        pairs.clear()

    for k, words in enumerate(texts):
        tids = np.fromiter((get(w, -1) for w in words), np.int64, len(words))
        for lo, hi in _windows(tids, index.window):
            part = tids[lo:hi]
            terms = np.unique(part)
            terms = terms[terms >= 0]
            pairs.append((np.full(len(terms), len(spans)), terms))
            spans.append((k, part, tids))
            if len(spans) >= BATCH:
                yield from flush()
    yield from flush()


def hits(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
         item_text_col: str = "text", threshold: float = THRESHOLD, overlap: float = OVERLAP, piece_words: int = PIECE_WORDS) -> DataFrame:
    """One row per document and benchmark item that it contains.

    doc_id, text_key, item_id, score (BM25 share of the item), question_overlap, answer_overlap; the best window of each.
    """
    spark = docs.sparkSession
    item_kind = items.schema[item_col].dataType.simpleString()
    parsed = items.select(F.col(item_col).alias("item_id"), F.col(item_text_col).alias("text")).mapInArrow(
        _parse, f"item_id {item_kind}, question array<string>, answer array<string>")
    parsed = cut(parsed.withColumn("words", F.size("question") + F.size("answer")).filter("words > 0").distinct())
    n_items, all_words, question_words = parsed.agg(
        F.count(F.lit(1)), F.coalesce(F.sum("words"), F.lit(0)), F.coalesce(F.sum(F.size("question")), F.lit(0))).first()
    df = parsed.select(F.explode(F.array_distinct("question")).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    pieces = max(1, -(-all_words // piece_words))
    parsed = parsed.withColumn("piece", F.pmod(F.xxhash64("item_id", "question"), F.lit(pieces)))
    doc_kind = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {doc_kind}, text_key binary, item_id {item_kind}, score double, question_overlap double, answer_overlap double"
    found = []
    for p in range(pieces if n_items else 0):
        mine = parsed.filter(F.col("piece") == p)
        rows = mine.select("item_id", "question", "answer").toArrow()  # about piece_words words
        terms = mine.select(F.explode("question").alias("word")).distinct().join(df, "word").toPandas()
        of = dict(zip(terms["word"], terms["df"]))
        by_window: dict[int, list[int]] = {}
        for i, q in enumerate(rows.column("question").to_pylist()):
            by_window.setdefault(half_window(len(q)), []).append(i)
        indexes = []
        for places in by_window.values():
            part = rows.take(places)
            index = build_index(part.column("question").to_pylist(), part.column("answer").to_pylist(), of, n_items, question_words / n_items)
            indexes.append((index, pa.array(part.column("item_id").to_pylist(), rows.schema.field("item_id").type)))
        shared = spark.sparkContext.broadcast(indexes)

        def scan(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = batch.column("text").to_pylist()
                words = [words_of(t) for t in texts]
                for index, ids in shared.value:
                    out = list(search(index, words, threshold, overlap))
                    keys = {k: hashlib.md5((texts[k] or "").encode()).digest() for k, *_ in out}
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("doc_id").take(pa.array([x[0] for x in out], pa.int64())), pa.array([keys[x[0]] for x in out], pa.binary()),
                         ids.take(pa.array([x[1] for x in out], pa.int64())), *[pa.array([x[c] for x in out], pa.float64()) for c in (2, 3, 4)]],
                        names=["doc_id", "text_key", "item_id", "score", "question_overlap", "answer_overlap"],
                    )

        piece = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(scan, schema)
        if pieces > 1:  # the hits are written, and the piece is given back, before the next is built
            piece = cut(piece)
            shared.unpersist()
        found.append(piece)
    if not found:
        return spark.createDataFrame([], schema)
    whole = found[0]
    for f in found[1:]:
        whole = whole.unionByName(f)
    return whole.groupBy("doc_id", "text_key", "item_id").agg(*[F.max(c).alias(c) for c in ("score", "question_overlap", "answer_overlap")])


def decontaminate(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that contain no benchmark item."""
    bad = cut(hits(docs, items, id_col=id_col, text_col=text_col, **options).select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).distinct())
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), F.col(id_col).alias("_i"), text_key(F.col(text_col)).alias("_k"))
    return rows.join(bad, F.col("_i").eqNullSafe(F.col("_id")) & (F.col("_k") == F.col("_key")), "left_anti").select("_doc.*")
