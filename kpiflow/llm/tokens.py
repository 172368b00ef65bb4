"""Edit-aware token counts.

The text of a document is cut into pre-tokens by the tokenizer's pattern; each
pre-token is encoded on its own, so a document's count is the sum over them. The
state of a document holds its pre-tokens' lengths and token counts in leaves of ``LEAF``
pre-tokens, and a segment tree whose nodes hold the characters and tokens below
them.

An edit (start, end, replacement; code points of the text before this edit) descends the tree
to the leaf that holds its start, steps back to a pre-token whose match did not
look at the edited characters (``boundary context``: the pre-token before the edit and
any run of white space before that), and cuts and encodes forward from there until a
pre-token boundary behind the edit is one of the old ones. From there on the
pattern sees the same text as before, so the rest stands. Touched leaves are
replaced and the sums above them updated; counts elsewhere are never recomputed.

The vocabulary file is a parameter of the driver; its entries travel in one broadcast
(rank files have a fixed size, checked against ``MAX_VOCAB_BYTES``).

Defined results: null text has no pre-tokens and 0 tokens, edits on it are taken as edits
of the empty text; edits beyond the end are clipped to it, and an end before the
start counts as the start; edits of one document apply in their order; rows that
repeat are counted alike; an empty table gives an empty result. Only the columns
named are read.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiflow.llm import pii

LEAF = 64
MAX_VOCAB_BYTES = 16 << 20
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pre-token pattern of the vocabulary.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class Encoder:
    """Counts the tokens of a pre-token; remembers short ones, up to ``MOST`` of them."""

    MOST = 300_000

    def __init__(self, vocabulary: bytes, pattern: str = PATTERN):
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}
        self.encoding = tiktoken.Encoding("counts", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.split = regex.compile(pattern)
        self.known: dict[str, int] = {}

    def count(self, piece: str) -> int:
        n = self.known.get(piece)
        if n is None:
            n = len(self.encoding.encode_ordinary(piece))
            if len(piece) <= 32:
                if len(self.known) >= self.MOST:
                    self.known.clear()
                self.known[piece] = n
        return n


class TokenTree:
    """Pre-tokens of one text with their sums."""

    def __init__(self, text: str, encoder: Encoder):
        self.text, self.encoder = text, encoder
        self.encoded = 0  # pre-tokens encoded so far
        pieces = encoder.split.findall(text)
        lengths, counts = list(map(len, pieces)), list(map(encoder.count, pieces))
        self.leaves = [(lengths[i : i + LEAF], counts[i : i + LEAF]) for i in range(0, len(pieces), LEAF)]
        self.encoded = len(pieces)
        self._rebuild()

    def _rebuild(self) -> None:
        size = 1
        while size < len(self.leaves):
            size *= 2
        self.size = size
        self.chars, self.tokens = [0] * (2 * size), [0] * (2 * size)
        for i, (lengths, counts) in enumerate(self.leaves):
            self.chars[size + i], self.tokens[size + i] = sum(lengths), sum(counts)
        for k in range(size - 1, 0, -1):
            self.chars[k] = self.chars[2 * k] + self.chars[2 * k + 1]
            self.tokens[k] = self.tokens[2 * k] + self.tokens[2 * k + 1]

    @property
    def n_tokens(self) -> int:
        return self.tokens[1]

    @property
    def n_pretokens(self) -> int:
        return sum(len(lengths) for lengths, _ in self.leaves)

    def leaf_at(self, offset: int) -> tuple[int, int]:
        """(leaf, characters before it) of the leaf that holds the character at ``offset``; the last one beyond the end."""
        k, before = 1, 0
        while k < self.size:
            k *= 2
            if offset >= before + self.chars[k] and self.chars[k + 1]:
                before += self.chars[k]
                k += 1
        return k - self.size, before

    def edit(self, start: int, end: int, replacement: str) -> None:
        old = self.text
        start = min(max(start, 0), len(old))
        end = min(max(end, start), len(old))
        new = old[:start] + replacement + old[end:]
        self.text = new
        if not self.leaves:
            encoded = self.encoded
            self.__init__(new, self.encoder)
            self.encoded += encoded
            return
        # the start: the last boundary before the edit whose earlier matches saw none of it
        first, before = self.leaf_at(max(start - 1, 0))
        while True:
            bounds, at = [], before
            for n in self.leaves[first][0]:
                bounds.append(at)
                at += n
            safe = [b for b in bounds if self._settled(old, b, start)]
            if safe or first == 0:
                begin = safe[-1] if safe else 0
                break
            first -= 1
            before -= self.chars[self.size + first]
        shift = len(replacement) - (end - start)
        # forward until a new boundary behind the edit is an old one
        lengths, counts = [], []
        for n, c in zip(*self.leaves[first]):  # kept head of the first leaf
            if before >= begin:
                break
            lengths.append(n)
            counts.append(c)
            before += n
        last, left = self.leaf_at(begin)
        old_bounds = self._bounds_from(last, left)
        bound, leaf, place = next(old_bounds)
        at = begin
        for m in self.encoder.split.finditer(new, begin):
            while bound is not None and (bound < end or bound + shift < at):
                bound, leaf, place = next(old_bounds)
            if bound is not None and bound + shift == at:
                break
            lengths.append(m.end() - at)
            counts.append(self.encoder.count(m.group()))
            self.encoded += 1
            at = m.end()
        else:
            bound = None
        if bound is None:
            leaf, tail = len(self.leaves), ([], [])
        else:
            tail = (self.leaves[leaf][0][place:], self.leaves[leaf][1][place:])
            leaf += 1
        lengths += tail[0]
        counts += tail[1]
        places = leaf - first
        if len(lengths) <= 2 * LEAF * places:  # the same leaves hold them, and only the sums above change
            cut = [len(lengths) * k // places for k in range(places + 1)]
            self.leaves[first:leaf] = [(lengths[a:b], counts[a:b]) for a, b in zip(cut[:-1], cut[1:])]
            self._update(first, leaf)
        else:  # more leaves: those behind move in the tree
            self.leaves[first:leaf] = [(lengths[i : i + LEAF], counts[i : i + LEAF]) for i in range(0, len(lengths), LEAF)]
            self._rebuild()

    @staticmethod
    def _settled(text: str, bound: int, start: int) -> bool:
        """Whether no match that ends at ``bound`` looked at the character at ``start`` or behind it."""
        if bound == 0:
            return True
        # a match looks up to two characters past its end (contractions), inside white space to the end of the run
        return bound + 2 <= start and not (text[bound - 1].isspace() and text[bound].isspace())

    def _bounds_from(self, leaf: int, before: int) -> Iterator[tuple[int | None, int, int]]:
        """(boundary, leaf, place) of the old pre-tokens from a leaf on; (None, 0, 0) at the end."""
        at = before
        for k in range(leaf, len(self.leaves)):
            for place, n in enumerate(self.leaves[k][0]):
                yield at, k, place
                at += n
        while True:
            yield None, 0, 0

    def _update(self, first: int, leaf: int) -> None:
        touched = set()
        for i in range(first, leaf):
            lengths, counts = self.leaves[i]
            self.chars[self.size + i], self.tokens[self.size + i] = sum(lengths), sum(counts)
            touched.add((self.size + i) // 2)
        while touched:
            above = set()
            for k in touched:
                if k:
                    self.chars[k] = self.chars[2 * k] + self.chars[2 * k + 1]
                    self.tokens[k] = self.tokens[2 * k] + self.tokens[2 * k + 1]
                    above.add(k // 2)
            touched = above


def _vocabulary(spark: SparkSession, path: str):
    with open(path, "rb") as f:
        data = f.read(MAX_VOCAB_BYTES + 1)
    if len(data) > MAX_VOCAB_BYTES:
        raise ValueError(f"vocabulary file of more than {MAX_VOCAB_BYTES} bytes: {path}")
    return spark.sparkContext.broadcast(data)


def with_redactions(docs: DataFrame, note: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, text and ``edits``: mail addresses and phone numbers replaced, last one first, then ``note`` put at the end."""
    rows = docs.select(F.col(id_col).alias(id_col), F.col(text_col).alias(text_col), note.alias("_note"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    found = pii.found_spans(rows, ("email", "phone"))
    edit = lambda x: F.struct(x["s"].alias("start"), x["e"].alias("end"), F.concat(F.lit("["), x["kind"], F.lit("]")).alias("replacement"))
    # where a phone number runs into a mail address, the later edit is clipped or repeats a place; counts stay exact
    changes = F.reverse(F.array_sort(F.transform(F.concat("_email", "_phone"), edit)))
    end = F.lit(2**31 - 1)
    at_end = F.array(F.struct(end.alias("start"), end.alias("end"), F.col("_note").alias("replacement")))
    return found.select(id_col, text_col, F.concat(changes, at_end).alias("edits"))


EDITS = "array<struct<start:int,end:int,replacement:string>>"


def count_edited(docs: DataFrame, edits: Column, *, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """Counts before and after the edits of each row.

    ``edits``: per row an array of (start, end, replacement), applied in order. Returns doc_id,
    n_tokens, n_pretokens, n_edits, n_tokens_after, n_pretokens_after, n_reencoded (pre-tokens
    encoded for the edits) and leaf_tokens (sums of the leaves after the edits).
    """
    shared = _vocabulary(docs.sparkSession, vocabulary)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), edits.cast(EDITS).alias("edits"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value)
        for batch in batches:
            out: list[list] = [[] for _ in range(7)]
            for text, todo in zip(batch.column("text"), batch.column("edits")):
                tree = TokenTree(text.as_py() or "", encoder)
                n, pieces, todo = tree.n_tokens, tree.n_pretokens, todo.as_py() or []
                done = tree.encoded
                for e in todo:
                    tree.edit(e["start"] or 0, e["end"] or 0, e["replacement"] or "")
                row = (n, pieces, len(todo), tree.n_tokens, tree.n_pretokens, tree.encoded - done, [sum(c) for _, c in tree.leaves])
                for column, value in zip(out, row):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(c, pa.int64()) for c in out[:6]], pa.array(out[6], pa.list_(pa.int64()))],
                names=["doc_id", "n_tokens", "n_pretokens", "n_edits", "n_tokens_after", "n_pretokens_after", "n_reencoded", "leaf_tokens"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    longs = ", ".join(f"{c} bigint" for c in ("n_tokens", "n_pretokens", "n_edits", "n_tokens_after", "n_pretokens_after", "n_reencoded"))
    return rows.mapInArrow(run, f"doc_id {kind}, {longs}, leaf_tokens array<bigint>")
