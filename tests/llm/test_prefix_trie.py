import hashlib
import random
import zlib

import pytest

from kpiflow.llm import prefix_trie as P

CONV = "conv_id bigint, turn bigint, role string, text string"
SMALL = ["a b", "c", "", "d e f"]


def table_of(seed, n=400, depth=6):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-50, 3 * n), n):
        for k in range(rng.randint(1, depth)):
            rows.append((c, k if rng.random() > 0.05 else None, rng.choice(["user", "user", "bot", None]), rng.choice(SMALL)))
    for c in range(5000, 5300):  # a large group of one conversation, some of which go on
        rows += [(c, 0, "user", "hello there"), (c, 1, "bot", "hi"), *([(c, 2, "user", f"x{c % 3}")] if c % 7 == 0 else [])]
    rows += [(None, 0, "user", "lost"), (9000, None, None, None), (9001, 0, "user", "a b"), (9001, 0, "user", "a b")]
    return rows


def brute(seqs):
    """Nodes of {conv_id: [(key, words)]} by plain dictionaries."""
    members = {}
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members.setdefault(tuple(s[:d]), []).append(c)
    kids = {}
    for p in members:
        if p:
            kids.setdefault(p[:-1], []).append(p)
    out = []

    def below(p):
        leaves, saved = (0 if p in kids else 1), (len(members[p]) - 1) * (p[-1][1] if p else 0)
        for q in kids.get(p, []):
            x, s = below(q)
            leaves, saved = leaves + x, saved + s
        ends = ",".join(map(str, sorted(c for c in members[p] if len(seqs[c]) == len(p))))
        out.append((min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]), len(kids.get(p, [])), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
        return leaves, saved

    if seqs:
        below(())
    return sorted(out, key=str)


def turns_of(rows):
    own = {}
    key = lambda r, t: hashlib.md5(f"{len(r)}:{r}{t}".encode()).digest()
    for c, k, r, t in rows:
        if c is not None:
            own.setdefault(c, []).append(((k is not None, k or 0, r or "", key(r or "", t or "")), len((t or "").encode().split())))
    return {c: [(x[0][3], x[1]) for x in sorted(v)] for c, v in own.items()}


def rebuilt(own):
    out = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        out[c] = own.get(base, [])[:h] + v[h:]
    return out


@pytest.mark.parametrize("seed, parts", [(1, 1), (2, 8), (3, 40), (4, 300)])
def test_against_dictionaries(spark, seed, parts):
    rows = table_of(seed)
    seqs = P.sequences(spark.createDataFrame(rows, CONV).repartition(5))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        got = P.trie_nodes(P.branched(seqs), part_turns=-(-2000 // parts))
        assert sorted(map(tuple, got.collect()), key=str) == brute(rebuilt(turns_of(rows)))
        if seed == 2:
            plain = P.trie_nodes(seqs, part_turns=50)
            assert sorted(map(tuple, plain.collect()), key=str) == brute(turns_of(rows))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_forest_of_equal_and_nested_sequences():
    f = P.forest([1, 1, 2, 3, 2], [0, 1, 1, 2, 0])
    live = [v for v in range(len(f["depth"])) if f["up"][v] != -2]
    assert sorted((f["depth"][v], f["lo"][v], f["hi"][v], f["ends"][v]) for v in live) == [(0, 0, 4, 0), (1, 0, 3, 2), (2, 2, 3, 1), (2, 4, 4, 1), (3, 3, 3, 1)]
    assert P.forest([], [])["depth"] == []
    assert P.forest([0, 0], [0, 0])["ends"][0] == 2


def test_common_turns():
    a = b"".join(bytes([i]) * 16 for i in range(9))
    for n in range(10):
        assert P.common_turns(a, a[: 16 * n] + b"\xff" * 32) == n
        assert P.common_turns(a[: 16 * n], a) == n


def test_odd_tables(spark):
    none = P.trie_nodes(P.branched(P.sequences(spark.createDataFrame([], CONV))))
    assert none.count() == 0
    one = spark.createDataFrame([(7, 3, None, None, "own")], CONV + ", node string")
    got = sorted(map(tuple, P.trie_nodes(P.sequences(one)).collect()))
    assert [r[:7] for r in got] == [(7, 0, None, 1, 1, 1, 0), (7, 1, 7, 1, 0, 1, 0)]
    lone = spark.createDataFrame([(None, 0, "user", "x")], CONV)
    assert P.trie_nodes(P.sequences(lone)).count() == 0
    long_turn = spark.createDataFrame([(1, 0, "user", "w " * 200_000), (2, 0, "user", "w " * 200_000)] + [(3, i, "u", "x") for i in range(3000)], CONV)
    top = P.trie_nodes(P.sequences(long_turn)).filter("depth <= 1").orderBy("depth", "conv_id").collect()
    assert [tuple(r)[:7] for r in top] == [(1, 0, None, 3, 2, 2, 200_000), (1, 1, 1, 2, 0, 1, 200_000), (3, 1, 1, 1, 1, 1, 0)]
