import hashlib

import numpy as np
import pytest

from kpiflow.llm import minhash as M
from tests.llm.conftest import prose


def brute(rows):
    """component of each distinct (doc_id, text), from all pairs of full shingle sets."""
    sets = {}
    for i, text in rows:
        w = (text or "").encode().lower().split()
        sets[i, text] = frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()
    names = list(sets)
    root = {x: x for x in names}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, a in enumerate(names):
        for b in names[:k]:
            inter = len(sets[a] & sets[b])
            if sets[a] and 100 * inter >= 85 * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    out = {}
    for x in names:
        ids = [y[0] for y in names if find(y) == find(x) and y[0] is not None]
        out[x] = (len(sets[x]), min(ids) if sets[x] and ids else x[0])
    return out


def near_family(n):
    """Texts cut differently from one base: many links, many pairs just under the threshold."""
    base = prose(77, 120).split()
    draw = np.random.default_rng(4)
    out = []
    for _ in range(n):
        w = list(base)
        for at in draw.integers(0, len(w), draw.integers(0, 5)):
            w[at] = f"v{draw.integers(0, 10**6)}"
        out.append(" ".join(w))
    return out


def test_against_all_pairs(spark, wide_docs):
    rows = [(r.doc_id, r.text) for r in wide_docs.collect()] + [(1000 + i, t) for i, t in enumerate(near_family(60))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = brute(rows)
    got = M.near_duplicates(docs)
    by = {(r.doc_id, bytes(r.text_key)): r for r in got.collect()}


    assert got.count() == len(rows)
    for (i, text), (n, component) in want.items():
        r = by[i, hashlib.md5((text or "").encode()).digest()]
        assert (r.n_shingles, r.component_id, r.kept) == (n, component, i == component)


def test_drop_keeps_one_of_each_group(spark, wide_docs):
    left = M.drop_near_duplicates(wide_docs)
    assert left.columns == wide_docs.columns
    ids = [r.doc_id for r in left.collect()]
    assert ids.count(400) == 1 and ids.count(7) == 1 and not set(ids) & set(range(100, 130))
    assert len(set(ids) & set(range(200, 205))) <= 1 and {300, 301, 302, 303, 500, 501, 502} <= set(ids)
    assert left.filter("`_doc` = 'own _doc'").count() == len(ids)


def test_empty_table(no_docs):
    assert M.near_duplicates(no_docs).count() == 0
    assert M.drop_near_duplicates(no_docs).count() == 0


@pytest.mark.parametrize("share", [0.5, 0.85, 0.95])
def test_estimate(share):
    draw = np.random.default_rng(1)
    n = 2000
    both = draw.integers(0, 2**63, int(n * share), dtype=np.uint64)
    sets = []
    for _ in range(2):
        own = draw.integers(0, 2**63, (n - len(both)) // 2, dtype=np.uint64)
        sets.append(np.unique(np.concatenate([both, own])))
    r = M.registers(sets)
    size = np.array([len(sets[0])]), np.array([len(sets[1])])
    true = len(both) / (n - (n - len(both)) % 2)
    assert abs(M.jaccard_estimate(r[:1], r[1:], *size)[0] - true) < 0.16
    assert (M.jaccard_estimate(r[:1], r[1:], *size) >= M.estimate_floor(*size))[0] or share < 0.85


def test_small_sets_share_bands():
    """Sets of few shingles at the threshold still meet in a band."""
    draw = np.random.default_rng(2)
    for _ in range(50):
        a = np.unique(draw.integers(0, 2**63, 7, dtype=np.uint64))
        b = np.unique(np.append(a, draw.integers(0, 2**63, dtype=np.uint64)))
        r = M.registers([a, b]).reshape(2, -1, M.BAND)
        assert (r[0] == r[1]).all(axis=1).any()
