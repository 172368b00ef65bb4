"""Quality classifier: a factorisation machine over hashed words, structure statistics and length.

``p(good) = sigmoid(w0 + sum_i w_i x_i + 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2))``:
every pair of features interacts through ``FACTORS``-dimensional factors, and the
sum-of-squares identity makes scoring linear in the features of a document.
Spark ML's factorisation machine fits and applies it on the executors.

Features: lower-cased words hashed to ``WORD_SLOTS`` counts, scaled to length 1 per
document; and one indicator per structure statistic and its bin (case, symbols,
digits, repetition, word and line lengths, size), so that a statistic acts
non-linearly and pairs of statistics interact. Language, source, ids and labels
are never features.

Labels: one row per document id (mean of its labels, 0.5 and above is 1; null and
other values are ignored). At most ``max_train`` labelled documents are used, those
with the smallest hash of their id, so the fit costs the same at every corpus size
while each document of the corpus is scored on its whole text.

Defined results: null text is scored as the empty text, which has features of its
own (all statistics in their zero bins); rows that repeat are scored alike; without
labels of both classes each score is the smoothed share of label 1; an empty table
gives an empty result. Other columns pass through and may have any name.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.classification import FMClassifier
from pyspark.ml.feature import HashingTF, Normalizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiflow.llm.common import WORD, cut

WORD_SLOTS = 1 << 12
STAT_SLOTS = 1 << 10
FACTORS = 4
MAX_TRAIN = 20_000
THRESHOLD = 0.3
TRAIN_PARTITIONS = 8


def held_out(doc_id: Column) -> Column:
    """The fold that is never learnt from: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(0.0)


def _statistics(text: Column, words: Column) -> dict[str, Column]:
    """Structure statistics of a text, each with its bin number."""
    n, chars = F.size(words), F.char_length(text)
    count = lambda pattern: chars - F.char_length(F.regexp_replace(text, pattern, ""))
    tenth = lambda x: F.floor(F.least(x, F.lit(1.0)) * 10)
    fine = lambda x: F.floor(F.log2(F.least(x, F.lit(1.0)) * 64 + 1) * 2)  # noqa: E731  finer near 0
    return {
        "words": F.floor(F.log2(n + 1)),
        "word_length": F.floor(F.least(_share(chars, n), F.lit(20.0))),
        "distinct": tenth(_share(F.size(F.array_distinct(words)), n)),
        "upper": tenth(_share(count(r"\p{Lu}+"), chars)),
        "symbols": fine(_share(count(r"[^\p{L}\p{N}\s.,]+"), chars)),
        "digits": fine(_share(count(r"[0-9]+"), chars)),
        "pipes": fine(_share(count(r"[|]+"), n)),
        "stops": fine(_share(count(r"[.,]+"), n)),
        "lines": F.floor(F.log2(1 + count(r"\n"))),
    }


def features(docs: DataFrame, text_col: str, keep: list[Column]) -> DataFrame:
    """``keep`` columns and the feature vector ``_x`` of every row."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(*keep, text.alias("_text")).withColumn("_words", F.regexp_extract_all(F.lower("_text"), F.lit(f"({WORD})"), F.lit(1)))
    stats = _statistics(F.col("_text"), F.col("_words"))
    rows = rows.withColumn("_stats", F.array(*[F.concat(F.lit(f"{k}="), v.cast("string")) for k, v in stats.items()])).drop("_text")
    rows = HashingTF(inputCol="_words", outputCol="_w", numFeatures=WORD_SLOTS).transform(rows).drop("_words")
    rows = Normalizer(inputCol="_w", outputCol="_wn", p=2.0).transform(rows).drop("_w")
    rows = HashingTF(inputCol="_stats", outputCol="_s", numFeatures=STAT_SLOTS, binary=True).transform(rows).drop("_stats")
    return VectorAssembler(inputCols=["_wn", "_s"], outputCol="_x").transform(rows).drop("_wn", "_s")


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        max_train: int = MAX_TRAIN, seed: int = 11) -> Callable[[DataFrame], DataFrame]:
    """Learns from ``labels`` (id, 0/1) and returns a function that adds _score to rows with features ``_x``."""
    lab = labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(
        (F.avg(label_col) >= 0.5).cast("double").alias("_y"))
    # the broadcast side has at most max_train rows
    lab = cut(lab.orderBy(F.xxhash64("_id"), "_id").limit(max_train))
    train = docs.select(F.col(id_col).alias("_i"), F.col(text_col).alias("_t")).join(F.broadcast(lab), F.col("_i") == F.col("_id"))
    train = cut(features(train, "_t", [F.col("_y")])).repartition(TRAIN_PARTITIONS)
    n, good = train.agg(F.count("_y"), F.coalesce(F.sum("_y"), F.lit(0.0))).first()
    if good in (0, n):
        return lambda rows: rows.withColumn("_score", F.lit((good + 1) / (n + 2)))
    model = FMClassifier(featuresCol="_x", labelCol="_y", factorSize=FACTORS, maxIter=60, stepSize=0.1, regParam=1e-2, initStd=0.05, seed=seed).fit(train)
    model.setProbabilityCol("_p").setRawPredictionCol("").setPredictionCol("")
    return lambda rows: model.transform(rows).withColumn("_score", vector_to_array("_p")[1]).drop("_p")


def score(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, **options) -> DataFrame:
    """The rows of ``docs`` with score (double) and predicted (int); columns of these names are replaced."""
    scorer = fit(docs, labels, id_col=id_col, text_col=text_col, **options)
    names = [c for c in docs.columns if c not in ("score", "predicted")]
    doc = F.struct(*[F.col(f"`{c}`") for c in names]).alias("_doc")
    rows = scorer(features(docs, text_col, [doc]))
    return rows.select("_doc.*", F.col("_score").alias("score"), (F.col("_score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, **options) -> DataFrame:
    """The rows of ``docs`` that score at least ``threshold``, with their columns."""
    scorer = fit(docs, labels, id_col=id_col, text_col=text_col, **options)
    doc = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc")
    return scorer(features(docs, text_col, [doc])).filter(F.col("_score") >= threshold).select("_doc.*")


def quality_digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted; learnt from the other folds only."""
    learnable = labels.filter(~held_out(F.col("doc_id")))
    scored = score(docs, learnable)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
