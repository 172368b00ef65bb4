"""Small odd tables for the training-data operators."""

import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Names that the operators use inside; as columns of a table they must not matter.
CLASHING = ["_doc", "_id", "_i", "_k", "_key", "_u", "_size", "_text", "node", "bucket", "size", "shard_", "label", "words", "_x", "_spans", "edits"]

WORDS = "the cat and a dog ran over the hill to see what was on the other side of the river before the sun went down again".split()


def prose(seed: int, n: int = 60) -> str:
    """Repeatable text of n words."""
    out, x = [], seed * 2654435761 % 2**32
    for _ in range(n):
        x = (x * 1664525 + 1013904223) % 2**32
        out.append(WORDS[x >> 27] if x >> 27 < len(WORDS) else f"w{(x >> 16) % 5000}")
    return " ".join(out)


def odd_rows():
    rows = [(i, prose(i), "en", "a" if i % 3 else "b", 60) for i in range(40)]
    rows += [(100 + i, prose(7), "en", "hot", 60) for i in range(30)]  # copies
    rows += [(200 + i, prose(1009) + f" extra{i}", "de", "hot", 60) for i in range(5)]  # near copies
    rows += [(300, None, None, None, None), (301, "", "en", "a", 0), (302, " \n\t ", "en", "a", 4), (303, "word", "en", "b", 4)]
    rows += [(None, prose(1011), "en", "a", 60), (None, None, None, "b", None)]
    rows += [(400, prose(1012), "en", "a", 60)] * 2  # a repeated row
    rows += [(500, "long " * 30_000, "en", "b", 150_000), (501, "x" * 120_000, "en", None, 120_000), (502, "é😀 " * 2_000, "fr", "c", 6_000)]
    return rows


@pytest.fixture(scope="session")
def odd_docs(spark):
    return spark.createDataFrame(odd_rows(), DOCS).repartition(3).cache()


@pytest.fixture(scope="session")
def wide_docs(odd_docs):
    from pyspark.sql import functions as F

    return odd_docs.select("*", *[F.lit(f"own {c}").alias(c) for c in CLASHING])


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
