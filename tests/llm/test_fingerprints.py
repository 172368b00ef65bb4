import hashlib
import re

from pyspark.sql import functions as F

from kpiflow.llm import fingerprints as P
from tests.llm.conftest import prose


def paragraphs(text):
    found = re.findall(r"[^\n]{200,}?[.!?](?=[ \t\n\x0b\f\r])|[^\n]+", text or "")
    return {x for x in (p.strip(" \t\r") for p in found) if x}


def edited(text, following):
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def share(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def documents(n=300):
    rows = []
    for i in range(n):
        lines = [prose(i * 1000 + k, 4 + (i * k) % 60) for k in range(i % 23)]
        rows.append((i * 7, "\n".join(lines), "en", "a", 0))
    rows.append((5, "\n".join(prose(77 * k, 8) for k in range(1500)), "en", "a", 0))  # many paragraphs
    rows.append((6, ". ".join(prose(91 * k, 30) for k in range(400)), "en", "a", 0))  # one line
    return rows


def test_against_sets(spark, odd_docs):
    """Likeness of two sketches is that of the paragraph sets, whatever the size of the difference."""
    docs = spark.createDataFrame(documents(), odd_docs.schema).unionByName(odd_docs.dropDuplicates(["doc_id", "text"]))
    got = P.fingerprint_digest(docs.repartition(6)).collect()
    text = lambda r: r.text or ""
    order = F.struct(F.col("doc_id").isNotNull(), "doc_id", F.shiftrightunsigned(F.xxhash64(F.coalesce("text", F.lit(""))), 1))
    rows = [r for r in docs.withColumn("o", order).orderBy("o").collect()]
    want = []
    for r, following in zip(rows, rows[1:] + rows[:1]):
        a, e = text(r), edited(text(r), text(following))
        want.append((r.doc_id, len(a), hashlib.sha256(e.encode()).hexdigest(), share(paragraphs(a), paragraphs(e)), share(paragraphs(a), paragraphs(text(following)))))
    key = lambda r: (str(r[0]), *r[1:3])
    mine = sorted(((r.doc_id, r.n_chars, r.edited_sha256, r.near_edited, r.near_next) for r in got), key=key)
    want.sort(key=key)
    assert [r[:3] for r in mine] == [r[:3] for r in want]
    assert all(abs(x - y) < 1e-12 for m, w in zip(mine, want) for x, y in zip(m[3:], w[3:]))
    prints = {}
    for r in got:
        prints.setdefault(r.fingerprint, set()).add(r.doc_id)
        assert len(r.fingerprint) == len(r.edited_fingerprint) == 3 * P.THIRD * 16 * 4 // 3
    assert {100 + i for i in range(30)} <= next(v for v in prints.values() if 100 in v)


def test_differing_digests_are_recovered(spark):
    rows = [(k, [i for i in range(k, 3 * k)], [i for i in range(2 * k, 5 * k)]) for k in (0, 1, 2, 5, 40, 3000)]
    pairs = spark.createDataFrame(rows, "key long, a array<long>, b array<long>")
    hashed = pairs.select("key", *[F.transform(c, lambda d: F.xxhash64(d)).alias(c) for c in ("a", "b")])
    found = {}
    for r in P.recovered(hashed).collect():
        mine = found.setdefault(r.key, ([], []))
        mine[0].extend(r.removed)
        mine[1].extend(r.added)
    for r in hashed.collect():
        a, b = set(r.a), set(r.b)
        assert sorted(found[r.key][0]) == sorted(a - b) and sorted(found[r.key][1]) == sorted(b - a)


def test_next_row_with_many_equal_ids(spark):
    """A third of the rows have no id, another third one id; every row still follows exactly one."""
    rows = [(None if i % 3 == 0 else 42 if i % 3 == 1 else i - 300, f"text {i}") for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = P.with_next(docs).collect()
    follows = {r.text: r.next_text for r in got}
    assert len(got) == 900 and sorted(follows.values()) == sorted(t for _, t in rows)
    by_text = {t: i for i, t in rows}
    place = lambda t: (by_text[t] is not None, by_text[t] or 0)
    assert sum(place(a) > place(b) for a, b in follows.items()) == 1


def test_odd_tables(spark, wide_docs, no_docs):
    out = P.fingerprint_digest(wide_docs.withColumn("text_", F.lit(1)))
    assert out.columns == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    assert out.count() == wide_docs.count()
    assert P.fingerprint_digest(no_docs).count() == 0
    one = P.fingerprint_digest(wide_docs.filter("doc_id = 0")).first()
    assert one.near_next == 1.0
    empty = P.fingerprint_digest(wide_docs.filter("doc_id in (300, 301)")).collect()
    assert [(r.n_chars, r.near_edited, r.near_next) for r in empty] == [(0, 1.0, 1.0)] * 2 and empty[0].fingerprint == empty[1].fingerprint
