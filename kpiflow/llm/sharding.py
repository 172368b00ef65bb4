"""Sharding by a k-d tree over document metadata (law ``bytes``).

Dimensions: language, source, size class (eighths of a power of two). A node
that must become k shards is split at the weighted median (weights: bytes) of its
widest dimension -- the one of which the node still covers the largest share of
all values -- so that ``k // 2`` of k parts of its bytes go left. Splitting goes on
until every leaf is one shard; with ``target_bytes`` the number of shards is the
total over the target, rounded up.

A median usually falls on a value that many rows share (one source may hold a
third of them), so the cut goes through that value: rows at the value are
ordered by a hash of their id in [0, 1), and the cut is found on that hash by two
rounds of histograms. A node is thereby cut within one ``BINS**2``-th of its bytes
or one document, whatever the skew, and rows of one node are never gathered.

What reaches the driver: a few values per node and level, at most as many rows as
there are shards; the next step has them in its expressions instead of broadcasts. Slots count rows inside a shard without a gap: rows are counted
per (shard, hash range), ranges get their offsets, and rows are numbered inside
their range only.

Defined results: null text has size 1; null language or source is a value of
its own that sorts first; equal texts are spread like any other rows; rows that
repeat a doc_id fall together; an empty table gives an empty result; with fewer
documents than shards some shards stay empty. Other columns pass through
``kd_shard`` and may have any name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpiflow.llm.common import byte_size, cut, text_crc, unit_hash

BINS = 2048
SEED = "shard-1"
#: Hash ranges per shard in which slots are numbered.
SLOT_RANGES = 64
#: Nodes up to which what was found for each is written into expressions; more are broadcast.
LITERALS = 64


def _text_code(c: Column) -> Column:
    return F.coalesce(F.concat(F.lit("s"), c), F.lit(""))


def default_dims(size: Column) -> dict[str, Column]:
    """Metadata dimensions as strings whose order is the order of the values."""
    return {
        "lang": _text_code(F.col("lang")), "source": _text_code(F.col("source")),
        "size": F.lpad(F.floor(F.log2(size) * 8).cast("string"), 6, "0"),
    }


@dataclass(frozen=True)
class Cut:
    """Rows of ``node`` go left when their ``dim`` is below ``value``, or equal with a hash below ``at``."""

    node: int
    dim: str
    value: str
    at: float


def _rows(docs: DataFrame, size: Column, dims: dict[str, Column], id_col: str) -> DataFrame:
    return docs.select(
        size.alias("_size"), unit_hash(F.col(id_col), seed=SEED).alias("_u"), F.lit(1).cast("long").alias("_node"),
        *[c.alias(f"_d_{n}") for n, c in dims.items()],
    )


def _known(rows: DataFrame, found: dict[int, tuple], schema: str) -> DataFrame:
    """Adds the columns of ``schema`` with what was found for each row's node; null where nothing was.

    Few nodes are written into the expression, so that no broadcast is made of a handful of rows; of more, the table
    has one row per node, fewer than there are shards.
    """
    columns = [c.split() for c in schema.split(", ")]
    if len(found) > LITERALS:
        table = rows.sparkSession.createDataFrame([(n, *v) for n, v in found.items()], f"_node bigint, {schema}")
        return rows.join(F.broadcast(table), "_node", "left")
    for k, (name, kind) in enumerate(columns):
        pick = [F.when(F.col("_node") == n, F.lit(v[k])) for n, v in found.items()]
        rows = rows.withColumn(name, F.coalesce(*pick, F.lit(None)).cast(kind))
    return rows


def _code(names: list[str]) -> Column:
    """The row's value in the dimension ``_dim``."""
    return F.coalesce(*[F.when(F.col("_dim") == n, F.col(f"_d_{n}")) for n in names])


def _descend(rows: DataFrame, cuts: list[Cut], names: list[str]) -> DataFrame:
    """One level down: node n becomes 2n (left) or 2n + 1; nodes without a cut stay."""
    code = _code(names)
    left = (code < F.col("_value")) | ((code == F.col("_value")) & (F.col("_u") < F.col("_at")))
    node = F.when(F.col("_dim").isNull(), F.col("_node")).otherwise(2 * F.col("_node") + F.when(left, 0).otherwise(1))
    known = _known(rows, {c.node: (c.dim, c.value, c.at) for c in cuts}, "_dim string, _value string, _at double")
    return known.withColumn("_node", node).drop("_dim", "_value", "_at")


def _walked(levels: list[list[Cut]], shard_of: dict[int, int], node: int = 1) -> Column:
    """The shard of a row as one expression of the whole tree."""
    found = {c.node: c for cuts in levels for c in cuts}.get(node)
    if found is None:
        return F.lit(shard_of[node])
    code = F.col(f"_d_{found.dim}")
    left = (code < F.lit(found.value)) | ((code == F.lit(found.value)) & (F.col("_u") < F.lit(found.at)))
    return F.when(left, _walked(levels, shard_of, 2 * node)).otherwise(_walked(levels, shard_of, 2 * node + 1))


def _crossing(sums: DataFrame, by: str) -> DataFrame:
    """Per node the first ``by`` at which the running ``_n`` exceeds ``_want``: _by, what of ``_want`` is left there, and its ``_n`` as _here."""
    upto = F.sum("_n").over(Window.partitionBy("_node").orderBy(by))
    e = F.min(F.when(F.col("_upto") > F.col("_want"), F.struct(F.col(by).alias("by"), (F.col("_upto") - F.col("_n")).alias("before"), F.col("_n").alias("n"))))
    return (
        sums.withColumn("_upto", upto).groupBy("_node").agg(e.alias("_e"), F.max("_want").alias("_want"))
        .select("_node", F.col("_e.by").alias("_by"), (F.col("_want") - F.col("_e.before")).alias("_want"), F.col("_e.n").alias("_here"))
    )


def _level_cuts(rows: DataFrame, parts: dict[int, int], names: list[str], whole: dict[str, int]) -> list[Cut]:
    """The cuts of all nodes of a level that must become more than one shard; ``whole``: about how many values each dimension has.

    Each step finds one row per node, which the next step has in its expressions.
    """
    here = rows.filter(F.col("_node").isin([n for n, k in parts.items() if k > 1]))
    dim = F.explode(F.array(*[F.struct(F.lit(n).alias("dim"), F.col(f"_d_{n}").alias("code")) for n in names]))
    hist = cut(
        here.select("_node", "_size", dim.alias("_x")).groupBy("_node", F.col("_x.dim").alias("_dim"), F.col("_x.code").alias("_code"))
        .agg(F.sum("_size").alias("_n"))
    )
    of_all = F.coalesce(*[F.when(F.col("_dim") == n, F.lit(m)) for n, m in whole.items()])
    widest = (
        hist.groupBy("_node", "_dim").agg(F.count(F.lit(1)).alias("_values"), F.sum("_n").alias("_bytes"))
        .groupBy("_node").agg(F.max_by(F.struct("_dim", "_bytes"), F.struct((F.col("_values") - 1) / of_all, "_dim")).alias("_w"))
        .select("_node", "_w._dim", "_w._bytes").collect()
    )
    wide = {n: (d, b * (parts[n] // 2 / parts[n])) for n, d, b in widest}
    sums = _known(hist.withColumnRenamed("_dim", "_of"), wide, "_dim string, _want double").filter(F.col("_of") == F.col("_dim"))
    value = {n: (wide[n][0], v, want, n_here) for n, v, want, n_here in _crossing(sums, "_code").collect()}
    tied = _known(here, value, "_dim string, _value string, _want double, _here bigint").filter(_code(names) == F.col("_value"))
    coarse = F.floor(F.col("_u") * BINS).cast("long")
    one = _crossing(tied.groupBy("_node", coarse.alias("_bin")).agg(F.sum("_size").alias("_n"), F.first("_want").alias("_want")), "_bin").collect()
    fine = F.floor(F.col("_u") * (BINS * BINS)).cast("long")
    in_bin = _known(tied.drop("_want", "_here"), {n: tuple(rest) for n, *rest in one}, "_by bigint, _want double, _here bigint").filter(coarse == F.col("_by"))
    two = in_bin.groupBy("_node", fine.alias("_bin")).agg(F.sum("_size").alias("_n"), F.first("_want").alias("_want"))
    nearest = F.col("_by") + F.when(2 * F.col("_want") >= F.col("_here"), 1).otherwise(0)  # the side of the last bin that is nearer
    at = dict(tuple(r) for r in _crossing(two, "_bin").select("_node", nearest / float(BINS * BINS)).collect())
    return [Cut(n, d, v, 0.0 if at.get(n) is None else at[n]) for n, (d, v, _, _) in value.items()]


def kd_tree(docs: DataFrame, n_shards: int | None = 16, target_bytes: int | None = None, size: Column | None = None,
            dims: dict[str, Column] | None = None, id_col: str = "doc_id") -> tuple[list[list[Cut]], dict[int, int]]:
    """The cuts of each level and the shard number of each leaf node."""
    size = byte_size(F.col("text")) if size is None else size
    dims = dims or default_dims(size)
    rows = cut(_rows(docs, size, dims, id_col))
    if target_bytes is not None:
        n_shards = max(1, -(-(rows.agg(F.sum("_size")).first()[0] or 0) // target_bytes))
    counts = rows.agg(*[F.approx_count_distinct(f"_d_{n}") for n in dims]).first()
    whole, parts, levels = dict(zip(dims, counts)), {1: n_shards}, []
    while any(k > 1 for k in parts.values()):
        cuts = _level_cuts(rows, parts, list(dims), whole)
        levels.append(cuts)
        split, after = {c.node for c in cuts}, {}
        for n, k in parts.items():
            if k > 1 and n in split:
                after[2 * n], after[2 * n + 1] = k // 2, k - k // 2
            else:  # a leaf, or a node without rows
                after[n] = 1
        # narrow rows, written again so that the plan of a level holds no other
        rows, parts = cut(_descend(rows, cuts, list(dims))) if any(k > 1 for k in after.values()) else rows, after
    return levels, {n: i for i, n in enumerate(sorted(parts, key=lambda n: f"{n:b}"))}


def kd_shard(docs: DataFrame, n_shards: int | None = 16, target_bytes: int | None = None, size: Column | None = None,
             dims: dict[str, Column] | None = None, id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` with their columns, plus shard (int) and slot (long, from 0 in each shard).

    A column of ``docs`` that is named shard or slot is replaced.
    """
    size = byte_size(F.col("text")) if size is None else size
    dims = dims or default_dims(size)
    levels, shard_of = kd_tree(docs, n_shards, target_bytes, size, dims, id_col)
    # the document travels as one struct, so that its column names clash with nothing
    doc = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in ("shard", "slot")])
    rows = docs.select(
        doc.alias("_doc"), F.col(id_col).alias("_id"), unit_hash(F.col(id_col), seed=SEED).alias("_u"),
        F.lit(1).cast("long").alias("_node"), *[c.alias(f"_d_{n}") for n, c in dims.items()],
    )
    if len(shard_of) <= LITERALS:
        rows = rows.withColumn("_shard", _walked(levels, shard_of))
    else:
        for cuts in levels:
            rows = _descend(rows, cuts, list(dims))
        rows = _known(rows, {n: (i,) for n, i in shard_of.items()}, "_shard int")
    rows = rows.withColumn("_range", F.floor(F.col("_u") * SLOT_RANGES).cast("int"))
    counts = rows.groupBy("_shard", "_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_shard").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cut(counts.select("_shard", "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")))
    inside = F.row_number().over(Window.partitionBy("_shard", "_range").orderBy("_u", "_id"))
    # SLOT_RANGES rows per shard
    numbered = rows.select("_doc", "_shard", "_range", inside.alias("_rn")).join(F.broadcast(offsets), ["_shard", "_range"])
    return numbered.select("_doc.*", F.col("_shard").alias("shard"), (F.col("_offset") + F.col("_rn") - 1).cast("long").alias("slot"))


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard, rows in slot order inside each file."""
    sharded.repartition("shard", F.floor(F.col("slot") / 1_000_000)).sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def shard_digest(docs: DataFrame, n_shards: int = 16) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every document, by ``kd_shard``."""
    text = F.col("text")
    narrow = cut(docs.select("doc_id", "lang", "source", byte_size(text).alias("size"), text_crc(text).alias("text_crc32")))
    return kd_shard(narrow, n_shards, size=F.col("size")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
