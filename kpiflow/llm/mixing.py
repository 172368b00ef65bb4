"""Mixing sources to target weights by Pareto order sampling (DataFrame functions only).

Targets. Sources in code-point order (null last) weigh 5, 2, 1, repeating. The
total of all sizes is shared by weight, a source takes at most ``max_copies``
times its own size, and what is above is shared again among the others:
``target = min(max_copies * size, level * weight)`` with the one level at which
the targets add up to the total.

Sampling. ``floor(target / size)`` whole copies of every document are certain.
The rest of the target, in words, is filled by a sample: document i has the
inclusion probability ``p_i`` proportional to its size measure (bits of its word
count, so longer documents are likelier), scaled so that the expected words of
the sample are the rest; its rank key is ``odds(u_i) / odds(p_i)`` with ``u_i`` a
hash of doc_id and seed. Documents with ``p_i >= 1`` come first. The sample is
the prefix of this order whose words come nearest to the rest, so it is fixed in
words up to half a document.

Scale. No source is ever gathered: the prefix ends are found by two rounds of
per-source histograms of the rank key (``BINS`` bins each, partial sums first),
and only the documents of one bin in ``BINS**2`` are ordered one by one. The
decision is then a comparison with the source's threshold.

Defined results: null and empty text has size 0 and takes 0; a null source is a
source of its own; rows that repeat a doc_id share its random number and are
taken or left together; an empty table gives an empty mix; targets of a corpus
without words are 0. Other columns pass through ``mix`` and may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpiflow.llm.common import cut, unit_hash, word_count

BINS = 2048
WEIGHTS = (5, 2, 1)
SEED = "mix-1"


def _source_key(c: Column) -> Column:
    return F.coalesce(F.concat(F.lit("s"), c), F.lit(""))


def _rows(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: str) -> DataFrame:
    """Narrow rows: what the mix needs to know of each document."""
    size = word_count(F.col(text_col))
    return docs.select(
        F.col(id_col).alias("_id"), F.col(source_col).alias("_source"), _source_key(F.col(source_col)).alias("_key"),
        size.alias("_size"), unit_hash(F.col(id_col), seed=seed).alias("_u"),
    ).withColumn("_measure", F.length(F.bin("_size")).cast("long"))


def source_targets(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_copies: int = 3) -> DataFrame:
    """One row per source: _key, _source_size, _target, _whole, _rest, _scale.

    The ungrouped windows run over the list of sources, one row each.
    """
    s = rows.groupBy("_key", "_source").agg(
        F.sum("_size").alias("_source_size"), F.sum(F.col("_size") * F.col("_measure")).alias("_mass")
    )
    order = Window.orderBy(F.col("_source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    s = s.withColumn("_w", w.cast("long")).withColumn("_cap", F.col("_source_size") * max_copies)
    by_cap = Window.orderBy((F.col("_cap") / F.col("_w")), "_key")
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    s = (
        s.withColumn("_left", F.sum("_source_size").over(everything) - F.coalesce(F.sum("_cap").over(before), F.lit(0)))
        .withColumn("_open", F.sum("_w").over(everything) - F.coalesce(F.sum("_w").over(before), F.lit(0)))
        .withColumn("_level", F.col("_left").cast("double") / F.col("_open"))
        # the level is the one at the first source that stays under its cap
        .withColumn("_fits", F.when(F.col("_level") * F.col("_w") <= F.col("_cap"), F.struct((F.col("_cap") / F.col("_w")).alias("c"), F.col("_key").alias("k"), F.col("_level").alias("level"))))
        .withColumn("_level", F.min("_fits").over(everything)["level"])
    )
    target = F.least(F.col("_cap").cast("double"), F.coalesce(F.col("_level") * F.col("_w"), F.lit(0.0)))
    s = s.withColumn("_target", target)
    whole = F.when(F.col("_source_size") > 0, F.floor(F.col("_target") / F.col("_source_size"))).otherwise(0).cast("long")
    s = s.withColumn("_whole", whole).withColumn("_rest", F.col("_target") - F.col("_whole") * F.col("_source_size"))
    scale = F.when(F.col("_mass") > 0, F.col("_rest") / F.col("_mass")).otherwise(0.0)
    return s.withColumn("_scale", scale).select("_key", "_source_size", "_target", "_whole", "_rest", "_scale")


def _with_rank(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """Adds _z, the Pareto rank key folded into [0, 1): odds(u) / odds(p) = q, z = q / (1 + q)."""
    p = F.least(F.lit(1.0), F.col("_scale") * F.col("_measure"))
    a, b = F.col("_u") * (1 - p), p * (1 - F.col("_u"))
    return rows.join(targets, "_key").withColumn("_z", F.when(p > 0, a / (a + b)).otherwise(1.0))


def _narrow(rows: DataFrame) -> DataFrame:
    """One histogram round: the bin of each source in which the rest is used up, and the words before it.

    ``rows``: _key, _bin, _size, _budget (words still to fill when the bins begin).
    """
    sums = rows.groupBy("_key", "_bin").agg(F.sum("_size").alias("_n"), F.first("_budget").alias("_budget"))
    upto = F.sum("_n").over(Window.partitionBy("_key").orderBy("_bin"))
    return (
        sums.withColumn("_upto", upto).filter(F.col("_upto") > F.col("_budget"))
        .groupBy("_key").agg(F.min(F.struct("_bin", (F.col("_upto") - F.col("_n")).alias("before"))).alias("_e"))
        .select("_key", F.col("_e._bin").alias("_end"), F.col("_e.before").alias("_before"))
    )


def thresholds(ranked: DataFrame) -> DataFrame:
    """Per source the last place of the sample: _key, _end_z, _end_id (null _end_z: everything is in).

    A row is in when (z, id) is at most (_end_z, _end_id); a null _end_id puts no row at _end_z in.
    """
    fine = F.floor(F.col("_z") * (BINS * BINS)).cast("long")
    rows = ranked.filter(F.col("_size") > 0).withColumn("_fine", fine)
    one = _narrow(rows.select("_key", F.floor(F.col("_fine") / BINS).cast("long").alias("_bin"), "_size", F.col("_rest").alias("_budget")))
    one = one.withColumnRenamed("_end", "_end1").withColumnRenamed("_before", "_before1")
    inside = rows.join(one, "_key").filter(F.floor(F.col("_fine") / BINS) == F.col("_end1")).withColumn("_budget", F.col("_rest") - F.col("_before1"))
    two = _narrow(inside.select("_key", F.col("_fine").alias("_bin"), "_size", "_budget"))
    last = inside.join(two, "_key").filter(F.col("_fine") == F.col("_end"))
    upto = F.sum("_size").over(Window.partitionBy("_key").orderBy("_z", F.col("_id").asc_nulls_first()))  # ties end together
    fits = 2 * F.col("_upto") - F.col("_size") <= 2 * (F.col("_budget") - F.col("_before"))
    return (
        last.withColumn("_upto", upto)
        .groupBy("_key").agg(F.max(F.when(fits, F.struct("_z", "_id"))).alias("_in"), F.min("_end").alias("_end"))
        .select("_key", F.coalesce(F.col("_in._z"), F.col("_end") / float(BINS * BINS)).alias("_end_z"),
                F.col("_in._id").alias("_end_id"), F.col("_in").isNotNull().alias("_some"))
    )


def _decide(ranked: DataFrame, ends: DataFrame) -> DataFrame:
    """Adds _copies: whole copies plus one when the sample holds the document."""
    at_end = F.col("_some") & (F.col("_z") == F.col("_end_z")) & (F.coalesce(F.col("_id") <= F.col("_end_id"), F.col("_id").isNull()))
    chosen = (F.col("_rest") > 0) & (F.col("_size") > 0) & (F.col("_end_z").isNull() | (F.col("_z") < F.col("_end_z")) | at_end)
    return ranked.join(ends, "_key", "left").withColumn("_copies", F.col("_whole") + F.when(chosen, 1).otherwise(0))


def plan_mix(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
             weights: tuple[int, ...] = WEIGHTS, max_copies: int = 3, seed: str = SEED) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(narrow rows, targets per source, thresholds per source)."""
    rows = cut(_rows(docs, id_col, text_col, source_col, seed))
    targets = cut(source_targets(rows, weights, max_copies))
    return rows, targets, cut(thresholds(_with_rank(rows, targets)))


def mix_table(docs: DataFrame, **options) -> DataFrame:
    """Per document: doc_id, size, source_size, target, taken (words), copies."""
    rows, targets, ends = plan_mix(docs, **options)
    return _decide(_with_rank(rows, targets), ends).select(
        F.col("_id").alias(options.get("id_col", "doc_id")), F.col("_size").alias("size"), F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"), (F.col("_size") * F.col("_copies")).alias("taken"), F.col("_copies").alias("copies"),
    )


def mix(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = SEED, **options) -> DataFrame:
    """The mixed corpus: the rows of ``docs``, each as often as the mix takes it, with the columns of ``docs``."""
    _, targets, ends = plan_mix(docs, id_col=id_col, text_col=text_col, source_col=source_col, seed=seed, **options)
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"))
    keyed = whole.select(
        "_doc", F.col("_doc")[id_col].alias("_id"), _source_key(F.col("_doc")[source_col]).alias("_key"),
        word_count(F.col("_doc")[text_col]).alias("_size"), unit_hash(F.col("_doc")[id_col], seed=seed).alias("_u"),
    ).withColumn("_measure", F.length(F.bin("_size")).cast("long"))
    taken = _decide(_with_rank(keyed, targets), ends).filter(F.col("_copies") > 0)
    return taken.select("_doc", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies")))).select("_doc.*")
