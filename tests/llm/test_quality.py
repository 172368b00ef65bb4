import pytest
from pyspark.sql import functions as F

from kpiflow.llm import quality as Q
from tests.llm.conftest import prose


@pytest.fixture(scope="module")
def labelled(spark):
    rows = [(i, prose(i, 40 + i % 50), 1) for i in range(300)]
    rows += [(1000 + i, " ".join(f"{w}$$$" for w in prose(i, 40).split()), 0) for i in range(60)]
    rows += [(2000 + i, prose(i, 40).upper().replace(" ", "!! "), 0) for i in range(60)]
    rows += [(3000 + i, ("same " * 60).strip(), 0) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, quality int")
    return df.select("doc_id", "text").cache(), df.select("doc_id", "quality").cache()


def test_held_out_accuracy(labelled):
    docs, labels = labelled
    out = Q.quality_digest(docs, labels)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"] and out.count() == docs.count()
    rows = out.join(labels, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert 40 < len(held) < 150 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    assert sum(r.predicted == r.quality for r in held) >= 0.95 * len(held)


def test_fold():
    import zlib

    from pyspark.sql import SparkSession

    rows = SparkSession.getActiveSession().range(50).select("id", Q.held_out(F.col("id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 5 == 0) for r in rows)


def test_odd_tables(labelled, wide_docs, no_docs):
    docs, labels = labelled
    out = Q.score(wide_docs, labels.filter("doc_id > 900"))  # no labelled document among them
    assert out.columns == [*wide_docs.columns, "score", "predicted"] and out.count() == wide_docs.count()
    assert {r.score for r in out.collect()} == {0.5}
    both = docs.unionByName(wide_docs.select("doc_id", "text").filter("doc_id is null or doc_id > 299 and doc_id < 600"))
    messy = labels.union(labels.selectExpr("cast(null as bigint)", "1")).union(labels.limit(3).selectExpr("doc_id", "cast(null as int)")).union(labels.limit(3).selectExpr("doc_id", "7"))
    scored = Q.score(both, messy, max_train=200)
    assert scored.count() == both.count() and scored.filter("score is null").count() == 0
    assert Q.score(no_docs, labels).count() == 0
    assert Q.keep_good(wide_docs, labels).columns == wide_docs.columns


def test_the_sum_of_squares_identity(labelled):
    """The model's score is the factorisation machine's, summed over all pairs of features."""
    import numpy as np
    from pyspark.ml.classification import FMClassifier

    docs, labels = labelled
    x = Q.features(docs.join(labels, "doc_id"), "text", [F.col("quality").cast("double").alias("_y")]).limit(40)
    m = FMClassifier(featuresCol="_x", labelCol="_y", factorSize=2, maxIter=2, seed=1).fit(x)
    v, w = m.factors.toArray(), m.linear.toArray()
    for r in m.transform(x).limit(5).collect():
        a = r["_x"].toArray()
        on = np.flatnonzero(a)
        pairs = sum(v[i] @ v[j] * a[i] * a[j] for k, i in enumerate(on) for j in on[:k])
        assert r.rawPrediction[1] == pytest.approx(m.intercept + w @ a + pairs)
