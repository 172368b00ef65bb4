from kpiflow.llm import decontam as D
from tests.llm.conftest import prose

ITEMS = "item_id bigint, text string, words string"


def items(spark):
    rows = [(i, prose(5000 + i, 30 + i) + "\n" + prose(6000 + i, 6), "own") for i in range(40)]
    rows += [(90, "Question: what is the capital of the far country of the blue hills\nanswer: the old town", "own"), (91, None, "own"), (92, "", "own"),
             (93, prose(5093, 3), "own"), (90, "Question: what is the capital of the far country of the blue hills\nanswer: the old town", "own")]
    return spark.createDataFrame(rows, ITEMS)


def planted(spark, wide_docs):
    it = {r.item_id: r.text for r in items(spark).collect()}
    rows = [(7000, prose(1, 200) + " " + it[3] + " " + prose(2, 300)), (7001, it[5].upper().replace(" ", ",  ")), (7002, prose(3, 90) + " " + it[7][: len(it[7]) // 2]),
            (7003, " ".join([prose(4, 3000), it[9], prose(5, 3000), it[11], prose(6, 50)])), (7004, it[12].split("\n")[0] + " and another thing"),
            (7005, "what is the capital of the far country of the blue hills"), (7006, it[90]), (7006, it[90]), (None, it[20]), (7007, it[93] + " more words here")]
    return spark.createDataFrame(rows, "doc_id bigint, text string").unionByName(wide_docs.select("doc_id", "text"))


def brute(docs, its):
    out = set()
    for d, text in docs:
        words = D.words_of(text)
        have = {tuple(words[k : k + 5]) for k in range(len(words) - 4)}
        for i, t in its:
            q, a = D.question_answer(t)
            if not q:
                continue
            n = min(5, len(q))
            have_n = have if n == 5 else {tuple(words[k : k + n]) for k in range(len(words) - n + 1)}
            sh = {tuple(q[k : k + n]) for k in range(len(q) - n + 1)}
            if len(sh & have_n) >= 0.8 * len(sh) and (not a or len(set(a) & set(words)) >= 0.8 * len(set(a))):
                out.add((d, i))
    return out


def test_against_full_search(spark, wide_docs):
    docs, its = planted(spark, wide_docs), items(spark)
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in its.collect()])
    found = D.hits(docs, its)
    got = [(r.doc_id, r.item_id) for r in found.collect()]
    assert set(got) == want and len(got) == len(want)
    assert {(7000, 3), (7001, 5), (7003, 9), (7003, 11), (7006, 90), (None, 20), (7007, 93)} <= want
    assert not {d for d, _ in want} & {7002, *range(40)}
    pieces = D.hits(docs, its, piece_words=300)
    assert {(r.doc_id, r.item_id) for r in pieces.collect()} == want


def test_other_items_have_no_say(spark):
    """A question 300 words before its answer is found with and without a much longer item beside it, and whatever the pieces."""
    asked, answer = prose(5500, 30), "the old town by the river"
    item = f"{asked}\nAnswer: {answer}"
    docs = spark.createDataFrame([(1, f"{prose(1, 80)} {asked} {prose(2, 300)} {answer}"), (2, f"{prose(3, 80)} {asked} {prose(4, 30)}"), (3, prose(5, 400))], "doc_id bigint, text string")
    long_item = prose(6600, 600)
    for rows in ([(1, item)], [(1, item), (2, long_item)], [(1, item), *[(10 + i, prose(7000 + i, 20 + 9 * i)) for i in range(60)]]):
        its = spark.createDataFrame(rows, "item_id bigint, text string")
        for words in (D.PIECE_WORDS, 200):
            assert [(r.doc_id, r.item_id) for r in D.hits(docs, its, piece_words=words).collect()] == [(1, 1)]


def test_no_answer_without_a_mark(spark):
    lines = [prose(5600 + i, 25) for i in range(4)]
    its = spark.createDataFrame([(1, "\n".join([*lines, prose(5700, 8)]))], "item_id bigint, text string")
    docs = spark.createDataFrame([(1, " ".join([prose(1, 50), *lines, prose(2, 50)])), (2, lines[0])], "doc_id bigint, text string")
    assert [(r.doc_id, r.item_id) for r in D.hits(docs, its).collect()] == [(1, 1)]


def test_a_rare_word_that_is_missing_loses_no_item(spark):
    """Nine tenths of an item's weight lie on one word; the item without that word is still retrieved."""
    common = "the cat and a dog ran over the hill to see what was on the other side of the river before the sun went down".split()
    rows = [(i, " ".join(common[i % 5 :] + common[: i % 5])) for i in range(50)]
    rows.append((99, " ".join([*common, "xylograph"])))
    its = spark.createDataFrame(rows, "item_id bigint, text string")
    docs = spark.createDataFrame([(1, " ".join(common))], "doc_id bigint, text string")
    assert 99 in {r.item_id for r in D.hits(docs, its).collect()}


def test_decontaminated_rows(spark, wide_docs, no_docs):
    its = items(spark)
    docs = wide_docs.limit(5).unionByName(wide_docs.limit(1).selectExpr(*["7000L as doc_id", f"'{prose(5003, 33)} {prose(6003, 6)}' as text", *[f"`{c}`" for c in wide_docs.columns[2:]]]))
    out = D.decontaminate(docs, its)
    assert out.columns == docs.columns and out.count() == 5 and out.filter("doc_id = 7000").count() == 0
    assert D.hits(no_docs, its).count() == 0 and D.hits(docs, its.limit(0)).count() == 0
    assert D.decontaminate(docs, its.limit(0)).count() == 6


def test_bounds_never_lose_an_item():
    """Block maxima only skip windows and blocks without an item at the threshold."""
    import numpy as np

    qs = [prose(i, 25).split() for i in range(50)]
    df = {}
    for q in qs:
        for w in set(q):
            df[w] = df.get(w, 0) + 1
    index = D.build_index(qs, [[] for _ in qs], df, len(qs), 25.0)
    for k in range(0, 50, 7):
        words = qs[k][:15] + prose(900 + k, 30).split()
        terms = np.unique([index.vocab[w] for w in words if w in index.vocab])
        score = np.zeros(len(qs))
        for t in terms:
            for at in range(index.start[t], index.start[t + 1]):
                score[index.item[at]] += index.impact[at]
        for threshold in (0.2, 0.5):
            got = D.retrieve(index, np.zeros(len(terms), np.int64), terms, 1, threshold)
            assert {i for _, i, _ in got} == set(np.flatnonzero(score >= threshold - 1e-9))
