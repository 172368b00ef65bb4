import hashlib
import random
import zlib

import pytest

from pyspark.sql import functions as F

from kpiflow.llm import periodic as P


def brute_runs(w, least):
    """Every maximal stretch for every period, kept where no smaller period holds over all of it."""
    n, out = len(w), []
    for q in range(1, n // 2 + 1):
        i = q
        while i < n:
            if w[i] != w[i - q]:
                i += 1
                continue
            j = i
            while j < n and w[j] == w[j - q]:
                j += 1
            s = i - q
            if j - s >= max(least, 2 * q) and all(any(w[x] != w[x - p] for x in range(s + p, j)) for p in range(1, q)):
                out.append((s, j - s, q))
            i = j
    return sorted(out)


def brute_kept(w, runs):
    return [x for i, x in enumerate(w) if not any(s + q <= i < s + n for s, n, q in runs)]


def some_words(rng):
    n = rng.randint(0, 130)
    w = [b"%d" % rng.randrange(rng.choice([1, 2, 3, 5, 40])) for _ in range(n)]
    for _ in range(rng.randint(0, 4)):
        if n > 4:
            a = rng.randrange(n)
            p, e = rng.randint(1, min(n - a, 40)), rng.randint(a, n)
            for i in range(a, e):
                w[i] = w[a + (i - a) % p]
    return w


def test_runs_against_brute_force():
    rng = random.Random(13)
    for _ in range(1500):
        w, least = some_words(rng), rng.choice([2, 3, 7, 12, 12, 12, 13, 20])
        runs = P.word_runs(w, least)
        assert runs == brute_runs(w, least)
        assert P.kept_words(w, runs) == brute_kept(w, runs)


def test_long_periodic_words():
    assert P.word_runs([b"a"] * 200_000) == [(0, 200_000, 1)]
    assert P.word_runs([b"%d" % (i % 7001) for i in range(40_000)]) == [(0, 40_000, 7001)]
    assert P.word_runs([b"b" if i % 100 else b"a" for i in range(10_000)])[0] == (0, 10_000, 100)


def test_query_against_brute_force(spark, odd_docs):
    extra = [(i, " ".join(f"w{(i * 31 + k * k) % 17}" for k in range(5 + i % 60)), "en", "a", 0) for i in range(1000, 1150)]
    docs = odd_docs.filter("doc_id is null or doc_id <> 500 and doc_id <> 502").unionByName(spark.createDataFrame(extra, odd_docs.schema))
    got = {}
    for r in P.run_digest(docs, P.planted_text(F.col("doc_id"), F.col("text"))).collect():
        got.setdefault(r.doc_id, []).append(tuple(r)[1:])
    want, planted = {}, 0
    for r in docs.collect():
        w = (r.text or "").encode().split()
        if r.doc_id is not None and w and zlib.crc32(str(r.doc_id).encode()) % 10 == 0:
            planted += 1
            n, g = len(w), zlib.crc32(str(r.doc_id).encode()) // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        runs = brute_runs(w, 12)
        top = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=None)
        digest = hashlib.sha256("".join("%d,%d,%d\n" % x for x in runs).encode()).hexdigest()
        kept = hashlib.sha256(b" ".join(brute_kept(w, runs))).hexdigest()
        row = (len(runs), *((*top, 1000 * top[1] // top[2]) if top else (None,) * 4), digest, kept)
        want.setdefault(r.doc_id, []).append(row)
    assert planted >= 10
    order = lambda rows: sorted(rows, key=str)
    assert {k: order(v) for k, v in got.items()} == {k: order(v) for k, v in want.items()}


def test_odd_tables(spark, wide_docs, no_docs):
    wide = wide_docs.withColumns({c: F.lit(1) for c in ("doc", "runs", "collapsed", "top")})
    out = P.collapse_runs(wide)
    assert out.columns == wide.columns and out.count() == wide.count()
    assert {r.doc_id: r.text for r in out.collect()}[500] == "long"
    same = out.filter("doc_id < 300").select("doc_id", "text").exceptAll(wide.filter("doc_id < 300").select("doc_id", "text"))
    assert same.count() == 0
    assert P.run_digest(no_docs, F.col("text")).count() == 0
    null = P.run_digest(wide.filter("doc_id = 300"), F.col("text")).first()
    assert (null.n_runs, null.start, null.exponent_milli) == (0, None, None)
    assert null.collapsed_sha256 == null.runs_sha256 == hashlib.sha256(b"").hexdigest()


@pytest.mark.parametrize("space", ["\x0b", "\x0c", "\r\n", "\t", "  "])
def test_words_split_at_these_alone(spark, space):
    words = ["a\x85b", "c d", "e\x1cf"] * 4
    row = P.with_runs(spark.createDataFrame([(1, space.join(words))], "doc_id long, text string"), F.col("text")).first()
    assert [tuple(r) for r in row.runs] == [(0, 12, 3)] and row.collapsed == " ".join(words[:3])
