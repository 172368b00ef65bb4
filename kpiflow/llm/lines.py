"""Fuzzy line deduplication over the whole corpus (DataFrame functions only).

A line is normalised (lower case, runs of anything but letters and digits become one
space, trimmed). Two lines are linked when their edit similarity, ``1 - levenshtein / longer length``,
is at least ``SIMILARITY``. Groups are the connected components of the links; the first
occurrence by (doc_id, line number) of each group stays, every other line of the group goes.
Lines without words stay and belong to no group.

1. One pass over the texts makes a narrow row per line: place, digest of the normalised line and the
   hashes of its blocks. A block is a stretch of 5 to 11 words that ends after a word whose last letter
   has an odd code point, so an inserted word moves no more than its own block; of a long line
   the ``KEPT`` blocks with the smallest hashes count. Lines with fewer than ``FINE`` such blocks have finer
   ones as well, of 3 to 6 words, and their halves: the first and the last characters, to multiples
   of ``GRID`` below half the length. Edits of a tenth of a line leave a block untouched (pigeonhole)
   unless they reach all of them.
2. Equal normalised lines meet by digest and are one node from then on.
3. Nodes that share a block, at a length that allows the similarity, share a bucket. Lines in buckets get a 64-bit SimHash,
   words as features. In each bucket every node is paired with the smallest one; pairs whose SimHashes
   differ in more than ``BITS`` bits go (lines below ``FEW`` words are too short for that test). The rest
   have their edit distance taken.
4. Steps 1 to 3 join most of what belongs together, cheaply and not completely (edits may reach every block, and the
   SimHash is a filter that may err). So all links between lines that are still in different components are then looked up without loss:
   with d edits allowed, one of d + 1 parts of the longer line is untouched, the first two parts from there have one edit at
   most, the first three two (``_remaining`` says why). So pairs meet by an untouched piece and are compared around it. Pairs whose counts
   of letters differ by more than the edits can change go; the others have their edit distance taken in full.

No linked pair is lost: groups are exactly the components of all links. What step 4 shuffles are texts, cut to stretches by length
class, about two to three times; the rows per character of the distinct lines are made and met in the task that has the texts. A task holds
the pieces of a class and stretch in memory, ``BLOCK`` thousand at once; of more, it looks up share by share. Places that share
a piece of nine characters at about the same place grow with the square of the lines; they cost time and are not written. Figures are
in the README. Nothing is gathered.

In step 3 the edit distance is taken last. Lines of equally many words are near for certain where the distances of the words at equal places
add up to few enough. Else the distances of what lies between common blocks add up to an upper bound: within the
edits allowed the pair is near, beyond ``SLACK`` times as many it is left to step 4, and only in between the full distance is taken (not
before five character 5-grams missing for each edit have ruled it out), which stops at the number of edits allowed.

Defined results: null and empty texts have one empty line; rows that repeat id and
text are treated as one and cleaned alike; a null doc_id sorts first; an empty
table gives an empty result. Other columns pass through ``drop_repeated_lines`` and
may have any name.
"""

from __future__ import annotations

import contextlib
import functools
import math
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiflow.llm.common import cut
from kpiflow.llm.components import connected_components

SIMILARITY = 0.9
#: Bits of 64 in which the SimHashes of a pair of step 3 differ at most, and the words from which on that is asked.
BITS, FEW = 18, 8
#: Words of a block, least and most; of the finer ones of lines with fewer than ``FINE`` blocks.
STRETCH, SHORT_STRETCH, FINE = (5, 11), (3, 6), 6
#: Blocks that a line is known by: those with the smallest hashes, so near lines choose alike.
KEPT = 12
#: A pair whose distance between common blocks is over so many times the edits allowed is left to step 4.
SLACK = 1.5
#: Step of the lengths of halves.
GRID = 4
#: Thousands of pieces of a length class and stretch that a task holds at once, and shares of such pieces that it looks up one by one.
BLOCK, SHARES = 400, 8
#: Characters of a piece of a line at most, and places that are looked up in one stretch of a text.
PIECE, STEP = 9, 64
#: Parts of a line that are compared where a piece is found, and characters that they never exceed.
PARTS, REACH = 3, 40
#: Ratio of the lengths of a class in step 4.
CLASS = 1.25
#: SQL: the first character of a line that is needed in a stretch.
LOW = "greatest(cell * w - most, 0)"
#: Lines of the length classes from this many characters on have one row per key.
LONG = 2_000
#: The session setting that has joins shuffle by all of their keys.
_WHOLE_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"
#: Letters that are counted in step 4; any letters will do.
LETTERS = " abcdefghijklmnopqrstuvwxyz\u00e9\u00e4\u00fc\u00f6\u00f3"
_PIECE = 32_767


def normalised(line: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(line), r"[^\p{L}\p{N}]+", " "))


def _lanes(h: Column) -> list[Column]:
    """Bits k, k + 16, k + 32 and k + 48 of a hash, each in a lane of 16 bits, for k below 16."""
    return [F.shiftrightunsigned(h, k).bitwiseAND(F.lit(0x0001000100010001).cast("long")) for k in range(16)]


def _majority(lanes: list[str], n: Column) -> Column:
    """The 64-bit SimHash from the summed lanes of n words: the bits that more than half of them have."""
    ones = F.lit(0x0001000100010001).cast("long")
    # a counter above n / 2 brings the sum with ``lift`` to 2 ** 15; half the sum is taken, so that no lane overflows
    lift = (F.lit(_PIECE).cast("long") - F.floor(n / 2).cast("long")) * ones
    lower, top = F.lit(0x7FFF7FFF7FFF7FFF).cast("long"), F.lit(0x4000400040004000).cast("long")
    out = F.lit(0).cast("long")
    for k, lane in enumerate(lanes):
        half = F.col(lane).bitwiseAND(lift) + F.shiftrightunsigned(F.col(lane).bitwiseXOR(lift), 1).bitwiseAND(lower)
        out = out.bitwiseOR(F.shiftleft(F.shiftrightunsigned(half.bitwiseAND(top), 14), k))
    return out


def with_simhash(rows: DataFrame, by: list[str]) -> DataFrame:
    """``by`` columns, piece and sig of every line with words (``norm``); ``by`` tells lines apart.

    The words of a line are summed in the task that read it; what is shuffled is
    one row of 16 sums per line. A piece holds up to 32,767 words of a line.
    """
    words = rows.filter("norm <> ''").select(*by, F.posexplode(F.split("norm", " ")).alias("_at", "_w"))
    piece = F.floor(F.col("_at") / _PIECE).cast("int")
    names = [f"_c{k}" for k in range(16)]
    hashed = words.select(*by, piece.alias("piece"), F.xxhash64("_w").alias("_h"))
    sums = hashed.groupBy(*by, "piece").agg(F.count(F.lit(1)).alias("_n"), *[F.sum(c).alias(n) for c, n in zip(_lanes(F.col("_h")), names)])
    return sums.select(*by, "piece", _majority(names, F.col("_n")).alias("sig"))


def _key(c: Column) -> Column:
    return F.unhex(F.md5(c.cast("binary")))


def line_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_key, line_no, norm of every line."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), _key(text).alias("text_key"), text.alias("text"))
    rows = rows.select("doc_id", "text_key", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))
    return rows.select("doc_id", "text_key", "line_no", normalised(F.col("line")).alias("norm"))


#: Last letters (and digits) with odd code points: Latin, Greek, Cyrillic.
_ODD = "".join(chr(c) for low, high in (("0", "9"), ("a", "z"), ("\u00df", "\u00ff"), ("\u03b1", "\u03c9"), ("\u0430", "\u045f")) for c in range(ord(low), ord(high) + 1) if c % 2)


def _stretches(least: int, most: int) -> str:
    return rf"((?:[^ ]++ ){{{least},{most}}}?(?<=[{_ODD}] )|(?:[^ ]++ ){{{most}}}|.+)"


def _blocks(norm: str, least: int, most: int, short: int) -> str:
    """SQL: the blocks of a line; what is left at the end may be a word or two, which say nothing."""
    return f"filter(transform(regexp_extract_all({norm}, '{_stretches(least, most)}', 1), x -> rtrim(x)), (x, i) -> i = 0 OR length(x) >= {short})"


def block_hashes(norm: str) -> Column:
    """Hashes of the blocks that a normalised line is known by, as array of long."""
    n = f"length({norm})"
    half = lambda k: f"({n} div {2 * GRID} - {k}) * {GRID}"
    ends = f"flatten(transform(filter(array({half(0)}, {half(1)}), c -> c > 0), c -> array(substring({norm}, 1, c), substring({norm}, {n} - c + 1, c))))"
    hashes = lambda x: f"transform({x}, x -> xxhash64(x))"
    fine = f"concat(b, {hashes(_blocks(norm, *SHORT_STRETCH, 10))}, {hashes(ends)})"
    long_line = f"slice(array_sort(b), 1, {KEPT})"
    return F.expr(f"array_distinct(element_at(transform(array({hashes(_blocks(norm, *STRETCH, 16))}), b -> if(size(b) < {FINE}, {fine}, {long_line})), 1))")


def _near(a: str, b: str) -> Column:
    return (F.bit_count(F.col(f"s{a}").bitwiseXOR(F.col(f"s{b}"))) <= BITS) | (F.least(f"w{a}", f"w{b}") < FEW)


def _most(na: str, nb: str) -> Column:
    """Edits that the similarity allows between lines of these lengths."""
    return F.floor(F.greatest(na, nb) * (1 - SIMILARITY) + 1e-9).cast("int")


def linked(ta: str, tb: str, na: str, nb: str) -> Column:
    """True where two lines have the edit similarity, for step 3; pairs far apart between common blocks are false unseen."""
    most = f"cast(floor(greatest({na}, {nb}) * {1 - SIMILARITY!r}D + 1e-9D) AS int)"
    limit = f"cast(floor({most} * {SLACK}) AS int)"
    wa, wb = f"split({ta}, ' ')", f"split({tb}, ' ')"
    aligned = f"size({wa}) = size({wb}) AND aggregate(zip_with({wa}, {wb}, (x, y) -> if(x = y, 0, levenshtein(x, y))), 0, (s, x) -> s + x) <= {most}"
    # between blocks that both lines have, one after the other at nearly the same place: an upper bound of the distance
    gap = lambda x, y: f"if({x} = {y}, 0, coalesce(nullif(levenshtein({x}, {y}, greatest({limit} - s.cost, 0)), -1), {limit} + 1))"
    before = lambda text, at: f"substring({text}, 1, {at} - 1)"
    step = (f"element_at(transform(array(named_struct('p', locate(x, s.ra), 'q', locate(x, s.rb))), f -> if(s.cost > {limit} OR f.p = 0 OR f.q = 0 OR abs(f.p - f.q) > {limit}, s, "
            f"named_struct('ra', substring(s.ra, f.p + length(x), length(s.ra)), 'rb', substring(s.rb, f.q + length(x), length(s.rb)), "
            f"'cost', s.cost + {gap(before('s.ra', 'f.p'), before('s.rb', 'f.q'))}))), 1)")
    bound = (f"aggregate({_blocks(ta, *STRETCH, 16)}, named_struct('ra', {ta}, 'rb', {tb}, 'cost', 0), (s, x) -> {step}, "
             f"s -> if(s.cost > {limit}, s.cost, s.cost + {gap('s.ra', 's.rb')}))")
    grams = lambda t: f"regexp_extract_all({t}, '(?=(.{{5}}))', 1)"
    missing = f"size(array_except({grams(ta)}, {grams(tb)})) > 5 * {most}"
    full = f"levenshtein({ta}, {tb}, {most}) >= 0"
    decide = f"CASE WHEN c <= {most} THEN true WHEN c > {limit} THEN false WHEN {missing} THEN false ELSE {full} END"
    return F.expr(f"CASE WHEN abs({na} - {nb}) > {most} THEN false WHEN {aligned} THEN true ELSE element_at(transform(array({bound}), c -> {decide}), 1) END")


def line_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(lines: doc_id, text_key, line_no, key; groups: key, first place and group of every line digest)."""
    rows = line_rows(docs, id_col, text_col).filter("norm <> ''").withColumn("key", _key(F.col("norm")))
    lines = cut(rows.select("doc_id", "text_key", "line_no", "key"), "zstd")
    place = F.struct(F.col("doc_id").isNotNull().alias("has"), "doc_id", "line_no", "text_key")
    distinct = rows.groupBy("key").agg(F.min(place).alias("first"), F.first("norm").alias("t"))
    nodes = cut(distinct.select(F.monotonically_increasing_id().alias("node"), "key", "first", F.char_length("t").alias("n"), "t"), "zstd")
    texts = nodes.select("node", "n", "t")

    # nodes that share a block, by length: lengths that allow the similarity share a class
    step = F.floor(F.log("n") / math.log(1 / SIMILARITY) + 1e-9).cast("int")
    exploded = texts.select(F.coalesce("node", F.lit(0)).alias("node"), F.coalesce(step, F.lit(0)).alias("step"), F.explode(block_hashes("t")).alias("block"))
    exploded = exploded.withColumn("block", F.coalesce("block", F.lit(0))).repartition("block")
    classes = F.explode(F.array(F.col("step"), F.col("step") + 1)).alias("class")
    lowest = exploded.groupBy("block", "step").agg(F.min("node").alias("low"), F.count(F.lit(1)).alias("m")).select("block", classes, "low", "m")
    heads = lowest.groupBy("block", "class").agg(F.min("low").alias("a"), F.sum("m").alias("m")).filter("m > 1").select("block", "class", "a")
    with _by_some_keys(docs.sparkSession):
        buckets = exploded.select("node", "block", classes).join(heads, ["block", "class"])
        stars = cut(buckets.filter("node <> a").select("a", F.col("node").alias("b")).distinct())
    sketched = cut(_sketched(_wanted(texts, stars)))

    side = lambda c: sketched.select(F.col("node").alias(c), F.col("sig").alias(f"s{c}"), F.col("n").alias(f"n{c}"), F.col("words").alias(f"w{c}"))
    star = stars.join(side("a"), "a").join(side("b"), "b").filter(_near("a", "b") & (F.abs(F.col("na") - F.col("nb")) <= _most("na", "nb")))
    labels = cut(connected_components(cut(_verified(cut(star.select("a", "b")), texts))))

    more = _remaining(texts, labels)
    known = labels.select(F.col("node").alias("a"), F.col("component").alias("b"))
    groups = connected_components(cut(known.unionByName(more)))
    grouped = nodes.select("node", "key", "first").join(groups, "node", "left").select("key", "first", F.coalesce("component", "node").alias("group"))
    return lines, grouped


@contextlib.contextmanager
def _by_some_keys(spark: SparkSession) -> Iterator[None]:
    """Joins of rows that are in one task by some of the join's keys do not shuffle them again by all."""
    before = spark.conf.get(_WHOLE_KEYS)
    spark.conf.set(_WHOLE_KEYS, "false")
    try:
        yield
    finally:
        spark.conf.set(_WHOLE_KEYS, before)


def _allowed(n: str) -> str:
    """SQL: edits allowed for a pair whose longer line has n characters."""
    return f"cast(floor({n} * {1 - SIMILARITY!r}D + 1e-9D) AS int)"


def _piece(n: str) -> str:
    """SQL: length of the pieces of a line of n characters: at most that of the shortest of its parts."""
    return f"least({PIECE}, {n} div ({_allowed(n)} + 1))"


def _class(n: str) -> str:
    """SQL: a class of length; the lines that a line is near to are in one or two classes."""
    return f"cast(floor(ln({n}) / {math.log(CLASS)!r}D) AS int)"


def _width(c: str) -> str:
    """SQL: characters of the stretches that lines of a class are dealt in, about four times the edits allowed."""
    return f"greatest(64, cast({4 * (1 - SIMILARITY)!r}D * power({CLASS!r}D, {c} + 1) AS int))"


def _cells(lines: DataFrame) -> DataFrame:
    """One row per line, length class and stretch: the columns, most, c, w, cell, low (first character that is needed there)."""
    rows = lines.selectExpr("*", f"{_allowed('n')} AS most")
    rows = rows.select("*", F.explode(F.expr(f"array_distinct(array({_class('(n - most)')}, {_class('n')}))")).alias("c")).selectExpr("*", f"{_width('c')} AS w")
    return rows.select("*", F.explode(F.expr("sequence(0, (n - 1) div w)")).alias("cell")).selectExpr("*", f"{LOW} AS low")


def _dealt(labelled: DataFrame) -> tuple[DataFrame, int]:
    """(rows of ``_cells`` with the text that is needed there, those of one class and stretch in one task: unit, r, s; number of passes).

    The keys of a class and stretch with many pieces fall into r shares. Each pass over the shuffled texts looks up one of them; for every
    SHARES of them the texts are there once more (s).
    """
    pieces = F.sum(F.expr("(least(n, (cell + 1) * w + most) - low) * (most + 1) / n"))
    full = cut(_cells(labelled.select("n")).groupBy("c", "cell").agg(pieces.alias("m")).selectExpr("c", "cell", "m", f"cast(ceil(m / {1000 * BLOCK}) AS int) AS r"))
    m, r = full.agg(F.coalesce(F.sum("m"), F.lit(0)), F.coalesce(F.max("r"), F.lit(1))).first()
    tasks = max(int(labelled.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(2_000, int(m / (400 * BLOCK)) + 1))
    rows = _cells(labelled).join(F.broadcast(full.select("c", "cell", "r")), ["c", "cell"]).select("*", F.explode(F.expr(f"sequence(0, (r - 1) div {SHARES})")).alias("s"))
    text = f"substring(t, low + 1, (cell + 1) * w + most + {REACH} - low) AS t"
    rows = rows.selectExpr("hash(c, cell, s) AS unit", "r", f"cast(s * {SHARES} AS int) AS s", "c", "cell", "node", "label", "n", "most", text)
    # no column is null; where Spark knows that it infers no filters of a pass, and all passes read one shuffle
    rows = rows.select(*[F.coalesce(F.col(c), F.lit("" if c == "t" else 0).cast(rows.schema[c].dataType)).alias(c) for c in rows.columns])
    return rows.repartition(tasks, "unit").withColumn("w", F.coalesce(F.expr(_width("c")), F.lit(0))), min(r, SHARES)


def _pieces(dealt: DataFrame, share: int) -> DataFrame:
    """One row per piece of a line as the longer of a pair: unit, gram, b, lb, nb, mostb, i, at and x, the text of PARTS parts from there."""
    at = lambda i: f"cast(({i}) * cast(n AS long) div (most + 1) AS int)"
    part = lambda c: f"cast(({c}) * cast(most + 1 AS long) div n AS int)"
    rows = dealt.selectExpr("*", f"{LOW} AS low", f"{_piece('n')} AS p").selectExpr("*", f"{part('low')} AS i0", f"least(most, {part('(cell + 1) * w + most')}) AS i1")
    # a piece is looked up in the text of STEP characters
    steps = rows.select("*", F.explode(F.expr(f"sequence(0, (i1 - i0) div {STEP // 8})")).alias("k")).selectExpr("*", f"i0 + k * {STEP // 8} AS i2")
    steps = steps.selectExpr("*", f"least(i1, i2 + {STEP // 8 - 1}) AS i3", f"greatest({at('i2')}, low) AS start").selectExpr("*", f"substring(t, start - low + 1, {at('i3')} + {REACH} - start) AS u")
    rows = steps.select("*", F.explode(F.expr("sequence(i2, i3)")).alias("i")).selectExpr("*", f"{at('i')} AS at").filter("i < most + sign(most) AND at >= low AND at < (cell + 1) * w + most")
    x = f"substring(u, at - start + 1, {at(f'least(i + {PARTS}, most + 1)')} - at)"
    rows = rows.selectExpr("unit", "r", "s", "hash(substring(u, at - start + 1, p)) AS gram", "c", "node AS b", "label AS lb", "n AS nb", "most AS mostb", "i", "at", f"{x} AS x")
    return rows.filter(f"pmod(gram, r) = s + {share}").drop("r", "s")


def _places(dealt: DataFrame, share: int) -> DataFrame:
    """One row per place and piece length of a line as the shorter of a pair: unit, gram, a, la, na, q (the place) and the text t from low."""
    longer = "filter(sequence(n, n + n div 8 + 1), m -> m - n <= {0} AND {0} > 0)".format(_allowed("m"))
    sizes = f"if(n >= {10 * PIECE}, array({PIECE}), array_distinct(transform({longer}, m -> {_piece('m')})))"
    rows = dealt.selectExpr("*", f"{LOW} AS low", f"cast(coalesce(c = {_class('n')} AND s + {share} < r, false) AS int) AS own").select("*", F.explode(F.expr(sizes)).alias("p"))
    rows = rows.selectExpr("*", "own * (least((cell + 1) * w, n - p + 1) - cell * w) AS many").filter("many > 0")
    # a place is looked up in the text of STEP places
    rows = rows.select("*", F.explode(F.expr(f"sequence(0, (many - 1) div {STEP})")).alias("k")).selectExpr("*", f"cell * w + k * {STEP} AS start")
    rows = rows.selectExpr("*", f"substring(t, start - low + 1, {STEP - 1} + p) AS u", f"least({STEP}, many - k * {STEP}) AS here")
    rows = rows.select("*", F.explode(F.expr("sequence(0, here - 1)")).alias("j"))
    rows = rows.selectExpr("unit", "r", "s", "hash(substring(u, j + 1, p)) AS gram", "c", "node AS a", "label AS la", "n AS na", "start + j AS q", "low", "t")
    return rows.filter(f"pmod(gram, r) = s + {share}").drop("r", "s")


def _candidates(labelled: DataFrame) -> DataFrame:
    """Pairs (a, b) of nodes of different components that may be near, as often as they are met; see ``_remaining``."""
    dealt, passes = _dealt(labelled)
    return functools.reduce(DataFrame.unionByName, [_met(_pieces(dealt, share), _places(dealt, share)) for share in range(passes)])


def _met(pieces: DataFrame, places: DataFrame) -> DataFrame:
    """The pairs (a, b) of one pass."""
    lengths = "la <> lb AND na <= nb AND nb - na <= mostb"
    like = lambda text: f"levenshtein({text}, x, 2 * least({PARTS - 1}, mostb - i)) >= 0"
    fits = f"{lengths} AND abs(q - at) + abs(q - at + nb - na) <= mostb AND abs(q - at + nb - na) <= mostb - i AND {like('substring(t, q - low + 1, char_length(x))')}"
    short, of_long = f"c < {_class(str(LONG))}", f"c >= {_class(str(LONG))}"
    met = places.filter(short).drop("c").join(pieces.filter(short).drop("c").hint("shuffle_hash"), ["unit", "gram"]).filter(fits).select("a", "b")
    # of long lines one row per key, from the lowest to the highest place: a line that repeats itself would meet others in all its periods
    spans = lambda at: [F.min(at).alias(f"low_{at}"), F.max(at).alias(f"high_{at}"), F.count(F.lit(1)).alias(f"m_{at}")]
    wide_b = pieces.filter(of_long).groupBy("unit", "gram", "b", "lb", "nb", "mostb").agg(*spans("at"), F.min("i").alias("i"), F.first("x").alias("x"))
    wide_a = places.filter(of_long).selectExpr("*", f"substring(t, q - low + 1, {REACH}) AS f").groupBy("unit", "gram", "a", "la", "na").agg(*spans("q"), F.first("f").alias("f"))
    fits = (f"{lengths} AND low_q - high_at <= least(mostb, na - nb + mostb - i) AND low_at - high_q <= least(mostb, nb - na + mostb - i) "
            f"AND (m_q > 1 OR m_at > 1 OR {like('substring(f, 1, char_length(x))')})")
    return met.unionByName(wide_a.join(wide_b.hint("shuffle_hash"), ["unit", "gram"]).filter(fits).select("a", "b"))


def _bags(texts: DataFrame) -> DataFrame:
    """node, n, g0 to g3: how often each of 32 letters is in the line (up to 255), eight to a number."""
    count = lambda c: F.least(F.col("n") - F.char_length(F.replace(F.col("t"), F.lit(c), F.lit(""))), F.lit(255)).cast("long")
    packed = []
    for k in range(0, len(LETTERS), 8):
        lanes = [F.shiftleft(count(c), 8 * j) for j, c in enumerate(LETTERS[k : k + 8])]
        packed.append(functools.reduce(lambda x, y: x.bitwiseOR(y), lanes).alias(f"g{k // 8}"))
    return texts.select("node", "n", *packed)


def _bag_distance() -> Column:
    """Sum of the differences of the letters' counts: an edit changes it by 2 at most."""
    lane = lambda c, j: F.shiftrightunsigned(c, 8 * j).bitwiseAND(F.lit(255).cast("long"))
    return functools.reduce(lambda x, y: x + y, [F.abs(lane(F.col(f"a{k}"), j) - lane(F.col(f"b{k}"), j)) for k in range(4) for j in range(8)])


def _remaining(texts: DataFrame, labels: DataFrame) -> DataFrame:
    """The links (a, b) between lines of different components: all of them.

    With d edits allowed, the longer line is cut into d + 1 parts of even length. Let S(k) be the edits in the first k parts, less k. S starts
    at 0 and ends below it, so S has a last maximum, at a part i before the end. From there on S stays below: of the parts from i on, the first has no
    edit, the first two have one at most, the first l have l - 1 and all have d - i. So the first characters of each part are looked up at
    all places of the shorter lines, by length class and stretch of the line, and there the text of PARTS parts must be within twice their
    edits (as many again, for the texts compared have one length), the rest of the line may be moved by d - i, and all of it by d.
    """
    labelled = texts.join(labels, "node", "left").selectExpr("node", "t", "n", "coalesce(component, node) AS label")
    with _by_some_keys(texts.sparkSession):
        met = cut(_candidates(labelled).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    some = _wanted(texts, met)
    bags = cut(_bags(some))
    side = lambda c: bags.select(F.col("node").alias(c), F.col("n").alias(f"n{c}"), *[F.col(f"g{k}").alias(f"{c}{k}") for k in range(4)])
    pairs = cut(met.join(side("a"), "a").join(side("b"), "b").filter(_bag_distance() <= 2 * _most("na", "nb")).select("a", "b"))
    return _beside(pairs, texts).filter(F.expr(f"levenshtein(ta, tb, {_allowed('greatest(na, nb)')}) >= 0")).select("a", "b")


def _wanted(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """The texts of the nodes in pairs (a, b)."""
    ends = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node")))
    return texts.join(ends, "node", "left_semi")


def _beside(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b), written before, with ta, na, tb and nb."""
    some = _wanted(texts, pairs)
    side = lambda c: some.select(F.col("node").alias(c), F.col("t").alias(f"t{c}"), F.col("n").alias(f"n{c}"))
    return pairs.join(side("a"), "a").join(side("b"), "b")


def _sketched(texts: DataFrame) -> DataFrame:
    """node, sig (SimHash of the whole line), n (characters), words."""
    sigs = with_simhash(texts.select("node", "n", F.size(F.split("t", " ")).alias("words"), F.col("t").alias("norm")), ["node", "n", "words"])
    return sigs.groupBy("node", "n", "words").agg(F.bit_xor("sig").alias("sig"))


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes whose lines have the edit similarity."""
    return _beside(pairs, texts).filter(linked("ta", "tb", "na", "nb")).select("a", "b")


def removed_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_key, removed: the line numbers (from 0, ascending) that go from each document that loses any."""
    lines, groups = line_groups(docs, id_col, text_col)
    keeper = groups.groupBy("group").agg(F.min("first").alias("keep"))
    decided = cut(groups.join(keeper, "group").select("key", "keep"))
    same = F.col("doc_id").eqNullSafe(F.col("keep.doc_id")) & (F.col("line_no") == F.col("keep.line_no")) & (F.col("text_key") == F.col("keep.text_key"))
    gone = lines.join(decided, "key").filter(~same).select("doc_id", "text_key", "line_no")
    return gone.groupBy("doc_id", "text_key").agg(F.array_sort(F.collect_set("line_no")).alias("removed"))  # lines of one text


def line_digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_lines, n_removed, removed (line numbers from 0, comma-joined)."""
    gone = removed_lines(docs, id_col, text_col)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("_i"), _key(text).alias("_k"), F.size(F.split(text, "\n", -1)).cast("long").alias("n_lines"))
    rows = rows.join(gone, F.col("_i").eqNullSafe(F.col("doc_id")) & (F.col("_k") == F.col("text_key")), "left")
    n = F.coalesce(F.when(F.col("removed").isNotNull(), F.size("removed")), F.lit(0)).cast("long")
    return rows.select(F.col("_i").alias("doc_id"), "n_lines", n.alias("n_removed"), F.coalesce(F.array_join("removed", ","), F.lit("")).alias("removed"))


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without the lines that repeat an earlier line of their group."""
    gone = removed_lines(docs, id_col, text_col).select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), F.col("removed").alias("_removed"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), F.col(id_col).alias("_i"), _key(F.coalesce(F.col(text_col), F.lit(""))).alias("_k"))
    rows = rows.join(gone, F.col("_i").eqNullSafe(F.col("_id")) & (F.col("_k") == F.col("_key")), "left")
    text = F.col("_doc")[text_col]
    kept = F.filter(F.split(text, "\n", -1), lambda x, i: ~F.array_contains("_removed", i))
    clean = F.when(F.col("_removed").isNull(), text).otherwise(F.array_join(kept, "\n"))
    return rows.select(*[clean.alias(c) if c == text_col else F.col("_doc")[c].alias(c) for c in docs.columns])
