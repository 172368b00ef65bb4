import random
from collections import Counter

from pyspark.sql import functions as F

from kpiflow.llm import lines as L
from tests.llm.conftest import prose


def levenshtein(a, b):
    prev = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        cur = [i]
        for j, y in enumerate(b, 1):
            cur.append(min(prev[j] + 1, cur[-1] + 1, prev[j - 1] + (x != y)))
        prev = cur
    return prev[-1]


def fixture(spark, wide_docs):
    base = "all the rights are kept by the people who made this page and by nobody else in the whole wide world of the web".split()
    rows = []
    for i in range(60):
        w = list(base)
        w[i % len(w)] = w[i % len(w)] + ("s" if i % 2 else "x")
        rows.append((1000 + i, "\n".join([" ".join(w), f"own line {i} of this text", "", "Copyright 2020, all rights.", "COPYRIGHT 2020 all rights"])))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    return docs.unionByName(wide_docs.select("doc_id", "text"))


def linked_pairs(names):
    """All pairs of lines with the edit similarity; nothing else is asked of them."""
    names = sorted(names, key=len)
    for k, b in enumerate(names):
        for a in reversed(names[:k]):
            most = int(len(b) * (1 - L.SIMILARITY) + 1e-9)
            if len(b) - len(a) > most:
                break
            if sum((Counter(a) - Counter(b)).values()) <= most and levenshtein(a, b) <= most:
                yield a, b


def brute(docs):
    rows = L.line_rows(docs).distinct().collect()
    rows.sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.line_no, bytes(r.text_key)))
    root = {r.norm: r.norm for r in rows if r.norm}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in linked_pairs(root):
        root[find(a)] = find(b)
    seen, gone = set(), {}
    for r in rows:
        if r.norm:
            g = find(r.norm)
            if g in seen:
                gone.setdefault((r.doc_id, bytes(r.text_key)), []).append(r.line_no)
            seen.add(g)
    return gone


def test_against_all_pairs(spark, wide_docs, monkeypatch):
    docs = fixture(spark, wide_docs)
    want = brute(docs)
    assert len(want) > 60
    for block in (L.BLOCK, 4):  # the second way deals most buckets to several tasks
        monkeypatch.setattr(L, "BLOCK", block)
        got = {(r.doc_id, bytes(r.text_key)): list(r.removed) for r in L.removed_lines(docs).collect()}
        assert got == want


def variants(rng, line):
    """The line with a letter, a word or a twentieth of its letters changed, a word put in or left out."""
    w, letters = line.split(), "abcdefghijklmnopqrstuvwxyz"
    i, at = rng.randrange(len(w)), rng.randrange(len(line))
    yield line[:at] + rng.choice(letters) + line[at + 1 :]
    yield " ".join([*w[:i], prose(rng.randrange(10**6), 1), *w[i + 1 :]])
    yield " ".join([*w[:i], prose(rng.randrange(10**6), 1), *w[i:]])
    yield " ".join([*w[:i], *w[i + 1 :]])
    yield "".join(rng.choice(letters) if rng.random() < 0.05 and c != " " else c for c in line)


def test_recall_against_all_pairs_of_edit_similarity(spark):
    """Whatever the edits and lengths: at least 0.9 of all similar pairs share a group, and no group holds lines that no links connect."""
    rng = random.Random(4)
    every = []
    for k in range(130):
        line = " ".join(f"{x}{rng.choice(['', 'en', 'ly', 'ing', 'o'])}" for x in prose(k * 17, rng.choice([5, 8, 12, 20, 30, 45, 60])).split())
        every += [line, *variants(rng, line)]
    docs = spark.createDataFrame([(i, x) for i, x in enumerate(every)], "doc_id long, text string")
    lines, groups = L.line_groups(docs)
    found = {r.text: r.group for r in lines.join(groups, "key").join(docs, "doc_id").select("text", "group").collect()}
    norm = {r.text: r.norm for r in docs.withColumn("norm", L.normalised(F.col("text"))).collect()}
    group = {norm[t]: g for t, g in found.items()}
    pairs = list(linked_pairs(set(norm.values()) - {""}))
    assert len(pairs) > 700
    by_length = {}
    for a, b in pairs:
        by_length.setdefault(min(len(a.split()) // 15, 3), []).append(group[a] == group[b])
    recall = sum(map(sum, by_length.values())) / len(pairs)
    print({k: round(sum(v) / len(v), 3) for k, v in sorted(by_length.items())}, round(recall, 3))
    assert recall >= 0.93 and all(sum(v) >= 0.9 * len(v) for v in by_length.values())
    root = {x: x for x in group}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        root[find(a)] = find(b)
    same = {}
    for x, g in group.items():
        same.setdefault(g, set()).add(find(x))
    assert all(len(v) == 1 for v in same.values())


def test_simhash_is_the_majority(spark):
    rows = [("a b c",), (" ".join(f"w{i}" for i in range(500)),), (" ".join(f"w{i % 7}" for i in range(40_000)),)]
    df = spark.createDataFrame(rows, "norm string")
    sigs = {(r.norm, r.piece): r.sig for r in L.with_simhash(df, ["norm"]).collect()}
    assert len(sigs) == 4
    for r in df.select("norm", F.transform(F.split("norm", " "), lambda x: F.xxhash64(x)).alias("h")).collect():
        for piece, lo in enumerate(range(0, len(r.h), 32_767)):
            part = [x & (2**64 - 1) for x in r.h[lo : lo + 32_767]]
            want = sum(1 << b for b in range(64) if sum(x >> b & 1 for x in part) > len(part) // 2)
            assert sigs[r.norm, piece] & (2**64 - 1) == want


def test_texts_keep_the_rest(spark, wide_docs, no_docs):
    out = L.drop_repeated_lines(wide_docs)
    assert out.columns == wide_docs.columns and out.count() == wide_docs.count()
    text = {r.doc_id: r.text for r in out.collect()}
    assert text[100] == "" and text[7] is not None and text[300] is None and text[302] == " \n\t "
    digest = L.line_digest(wide_docs)
    assert digest.count() == wide_docs.count()
    assert {r.doc_id: (r.n_lines, r.n_removed, r.removed) for r in digest.collect()}[100] == (1, 1, "0")
    assert L.line_digest(no_docs).count() == 0


def test_no_link_is_lost_where_edits_reach_every_block(spark):
    """A tenth of the characters changed evenly or at random, spaces as well: every similar pair shares a group."""
    rng = random.Random(9)
    letters = "abcdefghijklmnopqrstuvwxyzéä "
    every = ["nine left", "nineleft", "ten of them", "tenofthem x"]
    for k in range(60):
        line = made_line(rng, rng.choice([12, 25, 33, 60, 89, 90, 99, 140, 300, 520]))
        every.append(line)
        most = len(line) // 10
        for step in (10, 0, -1, 1):
            at = range(rng.randrange(10), len(line), 10) if step == 10 else sorted(rng.sample(range(len(line)), most))
            chars = list(line)
            for i in list(at)[:most]:
                chars[i] = rng.choice(letters) if step in (10, 0) or rng.random() < 0.4 else "" if step < 0 else chars[i] + rng.choice(letters)
            every.append("".join(chars))
    docs = spark.createDataFrame([(i, x) for i, x in enumerate(every)], "doc_id long, text string")
    lines, groups = L.line_groups(docs)
    rows = lines.join(groups, "key").join(docs, "doc_id").select(L.normalised(F.col("text")).alias("norm"), "group").collect()
    group = {r.norm: r.group for r in rows}
    pairs = list(linked_pairs(set(group)))
    assert len(pairs) > 150
    assert [(a, b) for a, b in pairs if group[a] != group[b]] == []


def test_places_are_not_shuffled(spark):
    """Step 4 shuffles texts, a few rows per line, and no row per character; a class and stretch looked up in shares gives the same pairs."""
    rng = random.Random(3)
    rows = [(2 * i + j, made_line(rng, 120) if j == 0 else None) for i in range(40) for j in range(2)]
    rows = [(i, t or rows[i - 1][1].replace("e", "a", 3)) for i, t in rows]
    labelled = spark.createDataFrame([(i, t, len(t), i) for i, t in rows], "node long, t string, n int, label long")
    with L._by_some_keys(spark):
        met = L._candidates(labelled)
        plan = met._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning(unit" in plan
        assert not [x for x in plan.split("\n") if "Exchange" in x and "gram" in x]
        pairs = {tuple(sorted(r)) for r in met.distinct().collect()}
        assert L._dealt(labelled)[0].count() <= 8 * len(rows)
    assert pairs >= {(2 * i, 2 * i + 1) for i in range(40) if rows[2 * i][1] != rows[2 * i + 1][1]}


def made_line(rng, n):
    """n characters of words of 1 to 12 letters, first and last no space."""
    out = ""
    while len(out) < n:
        out += "".join(rng.choice("aeinorst") if rng.random() < 0.6 else rng.choice("bcdfghjklmpquvwxyzé") for _ in range(rng.randint(1, 12))) + " "
    return out[: n - 1].strip().ljust(n, "x")
