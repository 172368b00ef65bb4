"""Document fingerprints: invertible Bloom lookup sketches of paragraphs (DataFrame functions only).

A text's paragraphs are its lines, long lines cut after the first sentence mark beyond
``PIECE`` characters, trimmed; its set has a 64-bit digest of each distinct one. The sketch has three times
``THIRD`` cells; a digest falls into one cell of each third. A cell holds the number of its digests,
their exclusive or and that of their checks. The fingerprint is the sketch, as text: its length is
fixed, equal texts have equal ones, and the difference of two, cell by cell, is the sketch of the
paragraphs that only one of the texts has.

Peeling takes that difference apart: a cell with one digest left (its count is 1 or -1 and the check
fits) gives that digest and the side it is from; taking it out of its other cells leaves more such cells.
When all cells are empty, the differing digests are recovered, whole; from them and the sizes of the sets comes
the likeness: common paragraphs by paragraphs in all.

A difference too large for the cells fails to peel. The pair is then retried with four times the
cells: its digests are dealt to four parts by fresh bits of a hash, each part with a sketch of its own
under a fresh seed. Parts that peel are done, the others are retried in the same way until none is
left, so the work for a pair stays in proportion to its paragraphs, times the number of rounds.

``with_next`` gives each document its successor by id without gathering the table: ranges between
quantiles of the id (only the cut points reach the driver) are sorted each on its own, and the last row of a
range takes the first of the next one. An id that many rows share, null included, is spread over ranges
by the texts' hash.

Defined results: a null text is the empty one, which has no paragraph; two empty sets have likeness 1; repeated
paragraphs count once; a null doc_id sorts first, rows of one id by a hash of their text; rows that repeat follow each other;
the only row follows itself; an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from functools import reduce
from math import ceil

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpiflow.llm.common import cut

#: Characters of a line from which on it is cut after a sentence mark.
PIECE = 200
#: Cells of a third of the sketch; a power of two.
THIRD = 8
#: Rounds of peeling before a part is retried with more cells.
ROUNDS = 8

_BITS = THIRD.bit_length() - 1
_ZERO = "named_struct('n', 0L, 'k', 0L, 'c', 0L)"
_CHECK = "(xxhash64({0}, 'check') & 4294967295L)"
#: The cell of hash ``y.h`` in the third that cell number ``i`` (from 0) belongs to.
_HIT = f"(shiftright(y.h, {_BITS} * (i div {THIRD})) & {THIRD - 1}L) = i % {THIRD}"


def paragraph_digests(text: Column) -> Column:
    """Digests of the distinct paragraphs of a text, as array of long."""
    pieces = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(rf"([^\n]{{{PIECE},}}?[.!?](?=\s)|[^\n]+)"), F.lit(1))
    trimmed = F.filter(F.transform(pieces, lambda p: F.btrim(p, F.lit(" \t\r"))), lambda p: p != "")
    return F.array_distinct(F.transform(trimmed, lambda p: F.xxhash64(p)))


def _cells(digests: str, level: int) -> str:
    """SQL of the sketch of an array of digests: array of (n, k, c)."""
    entry = f"transform({digests}, d -> named_struct('d', d, 'c', {_CHECK.format('d')}, 'h', xxhash64(d, {level}L)))"
    one = "named_struct('n', a.n + 1L, 'k', a.k ^ y.d, 'c', a.c ^ y.c)"
    cell = f"aggregate(filter(e, y -> {_HIT}), {_ZERO}, (a, y) -> {one})"
    return f"element_at(transform(array({entry}), e -> transform(sequence(0L, {3 * THIRD - 1}L), i -> {cell})), 1)"


def _peeled(left: str, right: str, level: int) -> str:
    """SQL of what peeling recovers from the difference of two sketches: (t, removed, added); all of t is zero if it is whole."""
    diff = f"zip_with({left}, {right}, (x, y) -> named_struct('n', x.n - y.n, 'k', x.k ^ y.k, 'c', x.c ^ y.c))"
    entry = f"named_struct('d', x.k, 'n', x.n, 'c', x.c, 'h', xxhash64(x.k, {level}L))"
    pure = f"array_distinct(transform(filter(s.t, x -> abs(x.n) = 1L AND {_CHECK.format('x.k')} = x.c), x -> {entry}))"
    rest = f"transform(s.t, (x, i) -> aggregate(filter(q, y -> {_HIT}), x, (a, y) -> named_struct('n', a.n - y.n, 'k', a.k ^ y.d, 'c', a.c ^ y.c)))"
    side = lambda n: f"transform(filter(q, y -> y.n = {n}L), y -> y.d)"
    step = f"named_struct('t', {rest}, 'removed', concat(s.removed, {side(1)}), 'added', concat(s.added, {side(-1)}))"
    none = "cast(array() AS array<bigint>)"
    return (f"aggregate(sequence(1, {ROUNDS}), named_struct('t', {diff}, 'removed', {none}, 'added', {none}), "
            f"(s, r) -> element_at(transform(array({pure}), q -> if(size(q) = 0, s, {step})), 1))")


def fingerprint(digests: str) -> Column:
    """The sketch of a column of digests as text of fixed length."""
    cell = "concat(lpad(hex(x.n), 8, '0'), lpad(hex(x.k), 16, '0'), lpad(hex(x.c), 8, '0'))"
    raw = F.unhex(F.expr(f"array_join(transform({_cells(digests, 0)}, x -> {cell}), '')"))
    return F.translate(F.base64(raw), "\r\n", "")


def recovered(pairs: DataFrame) -> DataFrame:
    """(key, removed, added): the digests that only ``a``, only ``b`` of a pair has; a row per part that was peeled.

    ``pairs``: key, a, b (arrays of distinct digests). Every pair has at least one row.
    """
    todo, done, level = pairs.select("key", F.lit(0).cast("long").alias("part"), "a", "b"), [], 0
    while True:
        tried = todo.withColumn("r", F.expr(_peeled(_cells("a", level), _cells("b", level), level)))
        whole = F.expr("NOT exists(r.t, x -> x.n <> 0L OR x.k <> 0L OR x.c <> 0L)")
        again = lambda c: F.when(~F.col("whole"), F.col(c)).alias(c)
        tried = tried.select("key", "part", "a", "b", "r", whole.alias("whole"))
        tried = cut(tried.select("key", "part", "whole", F.col("r.removed").alias("removed"), F.col("r.added").alias("added"), again("a"), again("b")))
        done.append(tried.filter("whole").select("key", "removed", "added"))
        failed = tried.filter("not whole")
        if failed.isEmpty():
            return reduce(DataFrame.unionByName, done)
        level += 1
        of_side = lambda c, s: F.transform(c, lambda d: F.struct(F.lit(s).alias("side"), d.alias("d")))
        digests = failed.select("key", "part", F.inline(F.concat(of_side("a", 0), of_side("b", 1))))
        fresh = F.xxhash64("d", F.lit("part"), F.lit(level)).bitwiseAND(F.lit(3).cast("long"))
        dealt = digests.select("key", (F.shiftleft("part", 2) + fresh).alias("part"), "side", "d")
        gathered = lambda s, c: F.collect_list(F.when(F.col("side") == s, F.col("d"))).alias(c)
        todo = dealt.groupBy("key", "part").agg(gathered(0, "a"), gathered(1, "b"))


def likeness(sizes: DataFrame, differing: DataFrame) -> DataFrame:
    """(key, near): the share of common paragraphs; ``sizes`` has key and n, the paragraphs of side a."""
    sums = differing.groupBy("key").agg(F.sum(F.size("removed")).alias("gone"), F.sum(F.size("added")).alias("new"))
    both = sizes.join(sums, "key")
    return both.select("key", F.when(F.col("n") + F.col("new") == 0, F.lit(1.0)).otherwise((F.col("n") - F.col("gone")) / (F.col("n") + F.col("new"))).alias("near"))


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text (never null), next_text: the text of the row after it by id; after the last comes the first."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text.alias("text"))
    rows = rows.withColumn("tie", F.shiftrightunsigned(F.xxhash64("text"), 1)).withColumn("at", F.col("doc_id").cast("double"))
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ids = docs.select(F.col(f"`{id_col}`").cast("double").alias("at"))
    n, known = ids.agg(F.count(F.lit(1)), F.count("at")).first()
    cuts = ids.approxQuantile("at", [i / ranges for i in range(1, ranges)], min(0.001, 0.1 / ranges)) if known and ranges > 1 else []
    splits = [float("-inf"), *(sorted(set(cuts)) or [0.0]), float("inf")]
    ranged = Bucketizer(splits=splits, inputCol="at", outputCol="range", handleInvalid="keep").transform(rows)
    # ids that fill several ranges by themselves, as far as doubles tell ids apart
    hot = {c: cuts.count(c) for c in set(cuts) if cuts.count(c) > 1 and abs(c) < 2**53}
    pieces = F.lit(None).cast("int")
    if hot:
        pieces = F.create_map(*[F.lit(x) for pair in sorted(hot.items()) for x in pair])[F.col("at")]
    pieces = F.when(F.col("doc_id").isNull(), F.lit(max(1, ceil(ranges * (n - known) / max(n, 1))))).otherwise(pieces)
    place = F.when(pieces.isNotNull(), F.floor(F.col("tie") / float(2**63) * pieces)).otherwise(F.lit(1 << 30))
    first_range = F.when(F.col("doc_id").isNull(), F.lit(0)).otherwise(F.col("range") + 1).cast("long")
    ranged = ranged.withColumn("piece", first_range * F.lit(1 << 31) + place.cast("long")).select("piece", "doc_id", "tie", "text")

    # the first row of each piece, by its place in the order: as many rows as pieces
    order = F.struct(F.col("doc_id").isNotNull().alias("has"), "doc_id", "tie")
    firsts = ranged.groupBy("piece").agg(F.min(order).alias("o"))
    in_order = Window.orderBy("piece")
    follows = firsts.select(
        F.lag("piece").over(in_order).alias("before"), F.max("piece").over(in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("last"),
        F.col("o.doc_id").alias("id"), F.col("o.tie").alias("its_tie"))
    follows = cut(follows.select(F.coalesce("before", "last").alias("before"), "id", "its_tie"))
    found = ranged.select("doc_id", "tie", F.col("text").alias("first_text")).join(
        F.broadcast(follows), F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("tie") == F.col("its_tie")))
    first_of_next = found.select(F.col("before").alias("piece"), "first_text").dropDuplicates(["piece"])

    within = Window.partitionBy("piece").orderBy(F.col("doc_id").asc_nulls_first(), "tie")
    led = ranged.select("piece", "doc_id", "text", F.lead("text").over(within).alias("next_text"))
    return led.join(first_of_next, "piece", "left").select("doc_id", "text", F.coalesce("next_text", "first_text").alias("next_text"))


def edited_text(text: Column, following: Column) -> Column:
    """The text with its last half of code points replaced by as many first ones of another text."""
    n = F.char_length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - half), F.substring(following, F.lit(1), half))


def fingerprint_digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    rows = with_next(docs, id_col, text_col).withColumn("edited", edited_text(F.col("text"), F.col("next_text")))
    known = cut(rows.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", F.char_length("text").cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        paragraph_digests(F.col("text")).alias("own"), paragraph_digests(F.col("edited")).alias("edited"), paragraph_digests(F.col("next_text")).alias("following")))
    pair = lambda which, b: F.struct(F.struct("row", F.lit(which).alias("which")).alias("key"), F.col("own").alias("a"), F.col(b).alias("b"))
    pairs = known.select(F.inline(F.array(pair(0, "edited"), pair(1, "following"))))
    sizes = known.select(F.size("own").alias("n"), F.explode(F.array(*[F.struct("row", F.lit(w).alias("which")) for w in (0, 1)])).alias("key"))
    near = likeness(sizes, recovered(pairs))
    of = lambda which, name: F.max(F.when(F.col("key.which") == which, F.col("near"))).alias(name)
    near = near.groupBy(F.col("key.row").alias("row")).agg(of(0, "near_edited"), of(1, "near_next"))
    return known.join(near, "row").select(
        "doc_id", "n_chars", "edited_sha256", fingerprint("own").alias("fingerprint"), fingerprint("edited").alias("edited_fingerprint"), "near_edited", "near_next")
