"""Personal data: candidate spans, gradient-boosted trees, calibrated thresholds (DataFrame functions only).

Base spans. Four fixed patterns, leftmost and non-overlapping per kind, found on the
whole text; matches that fail their check (IP parts above 255, card numbers
without 16 to 19 digits or a right check digit, phones without 8 to 15 digits) are
dropped without another try. Base spans are always reported.

Added spans. High-recall generators propose further, possibly overlapping spans:
``secret`` (long tokens with digits), ``contact`` (spelt-out mail addresses), ``number``
(digit groups) and ``iban``. Boosted trees (Spark ML) score each candidate from its
format (length, character classes, digit runs, alternation, check digits) and its
context (key words, separators and quotes before it). The trees learn from the
corpus itself: spans that pass a checksum or range check, or stand in a
credential's fixed format, are positive; matches of the same patterns that fail
their check and ordinary long words are negative; repeats (same string, context and
label) anywhere in the corpus count once, and all of these are used (``max_train`` bounds
them, to those with the smallest hash). A quarter of the strings is held out, at least one of each
class on each side (the only string of a class is on both), and the threshold is the
lowest one with ``PRECISION`` on that quarter.

Positions are code points, end exclusive: the pattern splits the text into gaps, and
running lengths of gaps and matches give the places.

Defined results: null text is the empty text, without spans; rows that repeat are
treated alike; candidates that overlap a base span are left out, the base span
covers them; when the corpus has no negative or no positive candidate the trees are
not fitted and nothing is added; an empty table gives an empty result. Other columns
pass through ``redact`` and may have any name.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiflow.llm.common import cut

BASE = ("email", "ip", "card", "phone")
ADDED = ("secret", "contact", "number", "iban")
PRECISION = 0.95
#: Training rows of a partition while the trees are fitted, and partitions at least.
TRAIN_ROWS, TRAIN_PARTS = 50_000, 8

# Patterns for the regular expression engine of the JVM. They match what the plain patterns match; possessive
# quantifiers and the look-behinds (a match starts a run, or where the last one ended) keep long runs linear.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # a maximal run of digits with single separators, of 16 to 19 digits
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){15,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    "secret": r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]{0,64}[0-9])[A-Za-z0-9+/_-]{12,}+",
    "contact": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{2,64}+ ?[\[({] ?at ?[\])}] ?[A-Za-z0-9-]++(?: ?(?:[\[({] ?dot ?[\])}]|\.) ?[A-Za-z0-9-]++){1,8}",
    "number": r"(?<![0-9A-Za-z.+-])\(?[0-9]{2,4}\)?(?:[ .-][0-9]{2,5}){1,4}(?![0-9A-Za-z])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "word": r"(?<![\p{L}\p{N}])\p{L}{12,40}+(?![\p{L}\p{N}])",
}
#: What a text must hold for the pattern to be tried at all.
NEEDS = {"email": "@", "phone": "+", "contact": "at"}
OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"
KEYS = {
    "key_secret": r"(?i)(?:pass(?:word|wd)?|pwd|token|secret|api.?key|key|auth|credential)\W{0,6}$",
    "key_phone": r"(?i)(?:tel|phone|fax|mobile|call|cell)\w*\W{0,6}$",
    "key_account": r"(?i)(?:card|visa|iban|account|konto|ssn|passport)\w*\W{0,6}$",
    "key_contact": r"(?i)(?:mail|contact|write)\w*\W{0,6}$",
    "assigned": r"[=:]\s*[\"']?$",
}
CREDENTIAL = r"^(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|sk-[A-Za-z0-9_-]{20,}|xox[abpr]-[A-Za-z0-9-]{10,})$"


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def luhn(s: Column) -> Column:
    """Whether the digits of ``s`` carry a right check digit."""
    d = F.transform(F.split(F.reverse(_digits(s)), ""), lambda x: x.try_cast("int"))
    twice = lambda x: 2 * x - F.when(x > 4, 9).otherwise(0)
    worth = F.transform(d, lambda x, i: F.coalesce(F.when(i % 2 == 1, twice(x)).otherwise(x), F.lit(0)))
    return F.aggregate(worth, F.lit(0), lambda a, x: a + x) % 10 == 0


def octets(s: Column) -> Column:
    return s.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")


def _digit_count(s: Column, lo: int, hi: int) -> Column:
    return F.length(_digits(s)).between(lo, hi)


CHECKS: dict[str, Callable[[Column], Column]] = {
    "email": lambda s: F.lit(True),
    "ip": octets,
    "card": lambda s: luhn(s),
    "phone": lambda s: _digit_count(s, 8, 15),
    "number": lambda s: _digit_count(s, 7, 15),
}


def _passes(kind: str) -> Callable[[Column], Column]:
    return lambda x: CHECKS[kind](x["t"])


def _fails(kind: str) -> Callable[[Column], Column]:
    return lambda x: ~CHECKS[kind](x["t"])


def _of(spans: str, kind: str) -> Column:
    return F.filter(spans, lambda x: x["kind"] == kind)


def found_spans(df: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    """Adds one array column per kind: structs of kind, s, e (code points), t (the match), before (30 characters)."""
    text = F.col("_text")
    m, g = {}, {}
    for k in kinds:
        hits = F.regexp_extract_all(text, F.lit(PATTERNS[k]), F.lit(0))
        m[f"_m_{k}"] = F.when(F.contains(text, F.lit(NEEDS[k])), hits) if k in NEEDS else hits
        g[f"_g_{k}"] = F.when(F.size(f"_m_{k}") > 0, F.split(text, PATTERNS[k], -1))
    df = df.withColumns(m).withColumns(g)
    empty = F.array().cast("array<struct<kind:string,s:int,e:int,t:string,before:string>>")

    def placed(k: str) -> Column:
        gaps = F.slice(f"_g_{k}", 1, F.size(f"_m_{k}"))
        pairs = F.arrays_zip(gaps.alias("g"), F.col(f"_m_{k}").alias("m"))
        step = F.transform(pairs, lambda p: F.struct(F.char_length(p["g"]).alias("n"), F.char_length(p["m"]).alias("l"), p["m"].alias("t"), F.substring(p["g"], -30, 30).alias("b")))

        def add(acc: Column, x: Column) -> Column:
            s = acc["pos"] + x["n"]
            span = F.struct(F.lit(k).alias("kind"), s.alias("s"), (s + x["l"]).alias("e"), x["t"].alias("t"), x["b"].alias("before"))
            return F.struct((s + x["l"]).alias("pos"), F.concat(acc["out"], F.array(span)).alias("out"))

        spans = F.aggregate(step, F.struct(F.lit(0).alias("pos"), empty.alias("out")), add, lambda acc: acc["out"])
        return F.when(F.col(f"_g_{k}").isNotNull(), spans).otherwise(empty)

    return df.withColumns({f"_{k}": placed(k) for k in kinds}).drop(*m, *g)


def spans_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document, without its text: _rid, doc_id, _base (valid base spans), _cand (candidates), _word (an ordinary long word)."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    rows = found_spans(rows, BASE + ADDED)
    good = [F.filter(f"_{k}", _passes(k)) for k in BASE]
    bad = [F.filter(f"_{k}", _fails(k)) for k in BASE if k != "email"]
    more = [F.filter(f"_{k}", _passes(k)) if k in CHECKS else F.col(f"_{k}") for k in ADDED]
    return rows.select(
        F.monotonically_increasing_id().alias("_rid"), "doc_id", F.concat(*good).alias("_base"), F.concat(*bad).alias("_failed"),
        F.concat(*more).alias("_cand"), F.regexp_extract("_text", PATTERNS["word"], 0).alias("_word"),
    )


FEATURES = ["n", "digits", "upper", "lower", "signs", "runs", "longest", "parts", "hexed", "luhn", "ip", "plus", "at", *KEYS]


def with_features(c: DataFrame) -> DataFrame:
    """Format and context features of the candidates (t, before), as doubles."""
    t, n = F.col("t"), F.greatest(F.char_length("t"), F.lit(1))
    share = lambda p: (n - F.char_length(F.regexp_replace(t, p, ""))) / n
    longest = F.array_max(F.transform(F.split(F.regexp_replace(t, "[^0-9]+", " "), " "), lambda x: F.length(x)))
    f = {
        "n": F.least(n, F.lit(64)), "digits": share("[0-9]"), "upper": share(r"\p{Lu}"), "lower": share(r"\p{Ll}"), "signs": share(r"[^\p{L}\p{N}]"),
        "runs": F.length(F.regexp_replace(F.regexp_replace(t, r"[0-9]+", "1"), r"\p{L}+", "a")) / n, "longest": F.least(F.coalesce(longest, F.lit(0)), F.lit(32)),
        "parts": F.least(F.size(F.split(t, "[ .-]")), F.lit(10)), "hexed": share("[0-9a-f]"), "luhn": luhn(t) & (F.length(_digits(t)) > 11), "ip": octets(t),
        "plus": t.startswith("+"), "at": t.rlike(r"@|[\[({ ]at[\])} ]"), **{k: F.col("before").rlike(p) for k, p in KEYS.items()},
    }
    return c.withColumns({k: F.coalesce(v.cast("double"), F.lit(0.0)) for k, v in f.items()})


def _training(found: DataFrame, max_train: int | None = None) -> DataFrame:
    """The labelled candidates (at most ``max_train``, if given), each (t, before, label) once: label (double) and features."""
    sure = lambda x: F.struct(x["t"].alias("t"), x["before"].alias("before"))
    credential = F.filter("_cand", lambda x: (x["kind"] == "secret") & x["t"].rlike(CREDENTIAL))
    keyed = F.filter("_cand", lambda x: (x["kind"] == "secret") & x["before"].rlike(KEYS["key_secret"]) & x["t"].rlike("[0-9].*[0-9].*[0-9]"))
    good = F.transform(F.concat("_base", credential, keyed), sure)
    word = F.when(F.col("_word") != "", F.array(F.struct(F.col("_word").alias("t"), F.lit("").alias("before")))).otherwise(F.array().cast("array<struct<t:string,before:string>>"))
    bad = F.concat(F.transform("_failed", sure), word)
    rows = [found.select(F.explode(F.array_distinct(x)).alias("x"), F.lit(y).alias("label")).select("x.*", "label").distinct() for x, y in ((good, 1.0), (bad, 0.0))]
    if max_train is not None:
        rows = [r.orderBy(F.xxhash64("t", "before"), "t", "before").limit(max_train // 2) for r in rows]
    return with_features(rows[0].unionByName(rows[1]))


def _split(train: DataFrame) -> DataFrame:
    """Adds _hold: a quarter of the strings, with rows of each class on both sides."""
    train = train.withColumn("_h", F.xxhash64("t", F.lit("hold")))
    held = F.pmod("_h", F.lit(4)) == 0
    per = train.groupBy("label").agg(F.min("_h").alias("_lo"), F.max("_h").alias("_hi"), F.bool_or(held).alias("_any"), F.bool_and(held).alias("_all"))  # two rows
    sides = F.when(F.col("_lo") == F.col("_hi"), F.array(F.lit(True), F.lit(False))).when(~F.col("_any"), F.array(F.col("_h") == F.col("_lo")))
    sides = sides.when(F.col("_all"), F.array(F.col("_h") != F.col("_hi"))).otherwise(F.array(held))
    return train.join(F.broadcast(per), "label").withColumn("_hold", F.explode(sides)).drop("_h", "_lo", "_hi", "_any", "_all")


def fit(found: DataFrame, max_train: int | None = None, precision: float = PRECISION) -> tuple[Callable[[DataFrame], DataFrame] | None, float]:
    """(a function that adds _score to rows with features, the calibrated threshold); (None, 1) without both classes."""
    train = _split(cut(_training(found, max_train)))
    classes, n_learn = train.filter(~F.col("_hold")).agg(F.countDistinct("label"), F.count(F.lit(1))).first()
    if classes < 2:
        return None, 1.0
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="_x")
    # by key and in order: the same rows in the same places, whatever wrote them
    learn = train.filter(~F.col("_hold")).repartition(max(TRAIN_PARTS, n_learn // TRAIN_ROWS), "t", "before").sortWithinPartitions("t", "before", "label")
    learn = assembler.transform(learn).select("_x", "label")
    model = GBTClassifier(featuresCol="_x", labelCol="label", maxIter=12, maxDepth=4, stepSize=0.3, seed=7).fit(learn)
    model.setProbabilityCol("_p").setRawPredictionCol("").setPredictionCol("")

    def score(rows: DataFrame) -> DataFrame:
        return model.transform(assembler.transform(rows)).withColumn("_score", vector_to_array("_p")[1]).drop("_x", "_p")

    held = score(train.filter("_hold")).select(F.floor(F.col("_score") * 100).alias("bin"), "label").groupBy("bin").agg(F.sum("label").alias("good"), F.count("label").alias("n")).collect()
    good = n = 0
    threshold = 0.99
    for r in sorted(held, key=lambda r: -r["bin"]):  # at most 101 score bins
        good, n = good + r["good"], n + r["n"]
        if good >= precision * n:
            threshold = max(0.5, r["bin"] / 100)
    return score, threshold


def find(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", max_train: int | None = None, precision: float = PRECISION, threshold: float | None = None) -> DataFrame:
    """doc_id, base and added: arrays of (kind, s, e), in order of kind and place."""
    found = cut(spans_table(docs, id_col, text_col))
    score, calibrated = fit(found, max_train, precision)

    def place(c: str, kinds: tuple[str, ...]) -> Column:
        bare = lambda x: F.struct(x["kind"].alias("kind"), x["s"].alias("s"), x["e"].alias("e"))
        return F.flatten(F.array(*[F.transform(_of(c, k), bare) for k in kinds]))

    none = F.array().cast("array<struct<kind:string,s:int,e:int>>")
    if score is None:
        return found.select("doc_id", place("_base", BASE).alias("base"), none.alias("added"))
    free = F.filter("_cand", lambda c: ~F.exists("_base", lambda b: (b["s"] < c["e"]) & (c["s"] < b["e"])))
    cand = found.filter(F.size("_cand") > 0).select("_rid", F.explode(free).alias("c")).select("_rid", "c.*")
    kept = score(with_features(cand)).filter(F.col("_score") >= (calibrated if threshold is None else threshold))
    kept = kept.groupBy("_rid").agg(F.array_sort(F.collect_list(F.struct("s", "e", "kind"))).alias("_kept"))  # the spans of one text
    rows = found.join(kept, "_rid", "left")
    return rows.select("doc_id", place("_base", BASE).alias("base"), F.coalesce(place("_kept", ADDED), none).alias("added"))


def pii_digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans."""
    joined = lambda c: F.array_join(F.transform(c, lambda x: F.concat_ws(":", x["kind"], x["s"].cast("string"), x["e"].cast("string"))), ",")
    counts = [F.size(_of("base", k)).cast("long").alias(f"n_{k}") for k in BASE]
    return find(docs).select("doc_id", *counts, F.sha2(joined("base").cast("binary"), 256).alias("base_sha256"), joined(F.concat("base", "added")).alias("spans"))


def redact(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` (ids unique) with every span of ``text_col`` replaced by ``[kind]``; overlapping spans by the first."""
    spans = find(docs, id_col=id_col, text_col=text_col, **options).select(F.col("doc_id").alias("_id"), F.array_sort(F.transform(F.concat("base", "added"), lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["kind"].alias("kind")))).alias("_spans"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), F.col(id_col).alias("_i"))
    rows = rows.join(spans.filter(F.size("_spans") > 0), F.col("_i") == F.col("_id"), "left")
    text = F.col("_doc")[text_col]

    def add(acc: Column, x: Column) -> Column:
        fresh = x["s"] >= acc["pos"]
        piece = F.concat(text.substr(acc["pos"] + 1, F.greatest(x["s"] - acc["pos"], F.lit(0))), F.lit("["), x["kind"], F.lit("]"))
        return F.struct(F.greatest(acc["pos"], x["e"]).alias("pos"), F.when(fresh, F.concat(acc["out"], piece)).otherwise(acc["out"]).alias("out"))

    clean = F.aggregate("_spans", F.struct(F.lit(0).alias("pos"), F.lit("").alias("out")), add, lambda a: F.concat(a["out"], text.substr(a["pos"] + 1, F.char_length(text))))
    clean = F.when(F.col("_spans").isNull(), text).otherwise(clean)
    return rows.select(*[clean.alias(c) if c == text_col else F.col("_doc")[c].alias(c) for c in docs.columns])
