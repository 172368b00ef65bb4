import random

import pytest
import tiktoken
from pyspark.sql import functions as F

from kpiflow.llm import tokens as T


@pytest.fixture(scope="module")
def encoder():
    with open(T.VOCABULARY, "rb") as f:
        return T.Encoder(f.read())


def test_edits_match_a_full_count(encoder):
    draw = random.Random(3)
    parts = ["the", "'", "s", "r", "e", "ve", "ll", " ", "  ", "\n", "\t", "12", "!", "$$", "é", "日本", "😀", " a", "xxxxx", "'re", "I'll", "\r\n"]
    text_of = lambda n: "".join(draw.choice(parts) for _ in range(n))
    saved = 0
    for _ in range(150):
        text = text_of(draw.choice([0, 1, 3, 30, 400]))
        tree = T.TokenTree(text, encoder)
        for _ in range(5):
            start = draw.randint(0, len(text) + 2)
            end = start + draw.choice([0, 0, 1, 5, 300])
            new = text_of(draw.choice([0, 0, 1, 2, 10, 200]))
            before = tree.encoded
            tree.edit(start, end, new)
            lo = min(start, len(text))
            text = text[:lo] + new + text[max(lo, min(end, len(text))):]
            assert tree.text == text
            assert tree.n_tokens == len(encoder.encoding.encode_ordinary(text))
            assert tree.n_pretokens == len(encoder.split.findall(text)) and tree.chars[1] == len(text)
            saved += tree.n_pretokens - (tree.encoded - before)
    assert saved > 0


def test_only_the_touched_region_is_encoded(encoder):
    tree = T.TokenTree("one two three four five " * 2000, encoder)
    before = tree.encoded
    tree.edit(24_000, 24_003, "zzz yyy")
    assert tree.encoded - before < 12


def test_table(spark, wide_docs, no_docs, encoder):
    note = F.lit("\n[end]")
    got = {r.doc_id: r for r in T.count_edited(T.with_redactions(wide_docs, note), F.col("edits")).collect()}
    assert got[300].n_tokens == 0 and got[300].n_tokens_after == len(encoder.encoding.encode_ordinary("\n[end]"))
    for r in wide_docs.filter("doc_id in (0, 301, 302, 500, 502)").collect():
        assert got[r.doc_id].n_tokens == len(encoder.encoding.encode_ordinary(r.text))
        assert got[r.doc_id].n_tokens_after == len(encoder.encoding.encode_ordinary(r.text + "\n[end]")) == sum(got[r.doc_id].leaf_tokens)
    assert T.count_edited(T.with_redactions(no_docs, note), F.col("edits")).count() == 0


def test_redactions_and_null_edits(spark, encoder):
    text = "mail me at a.b@c.de or +49 30 1234567, x@y.zz"
    rows = spark.createDataFrame([(1, text), (2, "plain")], "doc_id int, text string")
    got = {r.doc_id: r for r in T.count_edited(T.with_redactions(rows, F.lit("")), F.col("edits")).collect()}
    assert got[1].n_tokens_after == len(encoder.encoding.encode_ordinary("mail me at [email] or [phone], [email]"))
    assert got[1].n_edits == 4
    none = T.count_edited(rows, F.lit(None).cast(T.EDITS)).collect()
    assert all(r.n_edits == 0 and r.n_tokens == r.n_tokens_after for r in none)


def test_vocabulary_is_the_library_s(encoder):
    assert isinstance(encoder.encoding, tiktoken.Encoding)
    assert encoder.count(" the") == 1
