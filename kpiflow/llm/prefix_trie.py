"""Prefix trie of conversations by union-find over neighbours in sorted order.

A conversation is the sequence of its turns; a node of depth d is a distinct sequence of
first d turns, and the conversations that start with it are its members.

1. A turn becomes a 16-byte digest of its role and text, a conversation the string of
   these digests. Rows are narrow from here on: id, path, words per turn.
2. Conversations are dealt out by ranges of (path, id) and sorted, so equal ones may lie in
   several partitions. Neighbours in sorted order share a longest common prefix
   (LCP). In each partition, union-find takes the edges between neighbours in descending
   depth: an edge joins two components under a branching node at its depth, or hangs one
   under the other where that already ends or branches there. Between a node and its parent
   lie the nodes of the turns in between, with the same members.
3. Nodes that hold neither the first nor the last conversation of their partition are
   complete. The others lie on the prefixes of those two, at most two for each depth: this
   contracted forest has each node's local counts only. The LCPs across the partition
   boundaries tell where such a node begins and ends; with that, members, children,
   childless nodes and saved tokens of a node that several partitions share are plain
   sums over partitions, so the contracted forests merge in one grouped sum.
4. Complete nodes under a shared parent take its smallest member by a join on
   (partition, parent). Ids that end at a shared node are digested as a stream of chunks in
   order; no task holds them all.

What must fit a task: its range of conversations (id, lengths, words of new nodes), and
the narrow turns of one conversation. The one window without a partition key has
a row per partition.

Defined results: a null role or text is empty; turns are ordered by number, null first, and
where numbers repeat by role and then by digest; repeated rows are turns of their own;
rows without conv_id belong to no conversation; an empty table has no node, not even the
root. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kpiflow.llm.common import cut, word_count

#: Bytes of a turn in a path.
TURN = 16
#: Turns of a partition, at most about.
PART_TURNS = 500_000
_NOTHING = hashlib.sha256(b"").hexdigest()


def sequences(conversations: DataFrame) -> DataFrame:
    """conv_id, turns: key (digest) and words of each turn, in order."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    key = F.unhex(F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    turns = conversations.filter("conv_id is not null").select("conv_id", "turn", role.alias("role"), key.alias("key"), word_count(text).alias("words"))
    one = F.struct(F.col("turn").isNotNull().alias("has"), "turn", "role", "key", "words")
    rows = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(one)).alias("t"))
    return rows.select("conv_id", F.transform("t", lambda x: F.struct(x["key"].alias("key"), x["words"].alias("words"))).alias("turns"))


def branched(seqs: DataFrame, family: int = 20, most: int = 3) -> DataFrame:
    """``sequences`` in which every conversation begins like the first of its family.

    Conversation c keeps its own turns after the first h, with ``h = crc32(c) % (most + 1)``, and
    puts the first h turns of conversation ``c - c % family`` before them (what there is of them).
    """
    heads = seqs.filter(F.col("conv_id") % family == 0).select(F.col("conv_id").alias("_base"), F.slice("turns", 1, most).alias("_head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (most + 1)).cast("int")
    rows = seqs.join(heads, F.col("conv_id") - F.col("conv_id") % family == F.col("_base"), "left")
    own = F.slice("turns", h + 1, F.size("turns"))
    head = F.when(F.col("_head").isNull(), F.slice("turns", 1, 0)).otherwise(F.slice("_head", F.lit(1), h))
    return rows.select("conv_id", F.concat(head, own).alias("turns"))


def forest(lengths: list[int], lcps: list[int]) -> dict[str, list[int]]:
    """Nodes over sorted sequences: depth, lo and hi (first and last member), ends (members that end there), up (parent, -1 at the root, -2 for a node that is part of another).

    ``lcps[i]`` is the common prefix of sequences i - 1 and i. The first nodes are the sequences.
    """
    m = len(lengths)
    depth, lo, hi = list(lengths), list(range(m)), list(range(m))
    ends, up = [1] * m, [-1] * m
    root, top = list(range(m)), list(range(m))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    def branch(d: int, x: int, y: int) -> int:
        depth.append(d)
        lo.append(lo[x])
        hi.append(hi[y])
        ends.append(0)
        up.append(-1)
        up[x] = up[y] = len(depth) - 1
        return len(depth) - 1

    for e in sorted(range(1, m), key=lambda e: -lcps[e]):  # within a depth from left to right
        a, b = find(e - 1), find(e)
        x, y, d = top[a], top[b], lcps[e]
        if depth[x] > d:  # the right side is deeper as well: what ends at d sorts before what goes on
            top[a] = branch(d, x, y)
        else:
            hi[x] = hi[y]
            if depth[y] > d:
                up[y] = x
            else:  # the same sequence once more; nothing hangs under it yet
                ends[x] += ends[y]
                up[y] = -2
        root[b] = a
    if m and depth[top[find(0)]] > 0:
        x = top[find(0)]
        branch(0, x, x)
    return {"depth": depth, "lo": lo, "hi": hi, "ends": ends, "up": up}


def common_turns(a: bytes, b: bytes) -> int:
    """Turns that two paths have in common at their beginning."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n // TURN
    low, high = 0, n // TURN - 1  # the first ``low`` are equal, the first ``high + 1`` are not
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a[: mid * TURN] == b[: mid * TURN] else (low, mid - 1)
    return low


def prefix_names(path: bytes) -> list[bytes]:
    """A name for each prefix of a path, from the empty one on."""
    h = hashlib.blake2b(digest_size=16)
    out = [h.digest()]
    for i in range(0, len(path), TURN):
        h.update(path[i : i + TURN])
        out.append(h.copy().digest())
    return out


#: Columns of the forests: complete nodes have no ``node``; ``under`` names a parent that is not complete.
_FOREST = (
    "part int, conv_id bigint, depth bigint, parent_conv_id bigint, under binary, n_convs bigint, n_children bigint, n_leaves bigint, "
    "saved_tokens bigint, ends_sha256 string, node binary, words bigint, at_left boolean, at_right boolean, last_ends boolean, "
    "ends string, ends_from bigint, first_path binary, last_path binary"
)
_ARROW = pa.schema([
    ("part", pa.int32()), ("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("under", pa.binary()), ("n_convs", pa.int64()),
    ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends_sha256", pa.string()), ("node", pa.binary()), ("words", pa.int64()),
    ("at_left", pa.bool_()), ("at_right", pa.bool_()), ("last_ends", pa.bool_()), ("ends", pa.string()), ("ends_from", pa.int64()),
    ("first_path", pa.binary()), ("last_path", pa.binary())])


def _nodes(part: int, ids: list[int], lengths: list[int], lcps: list[int], new_words: list[list[int]], first: bytes, last: bytes) -> Iterator[tuple]:
    """Rows of ``_FOREST`` for one sorted partition; ``new_words`` has the words of each sequence's turns after its LCP."""
    f = forest(lengths, lcps)
    depth, lo, hi, ends, up = f["depth"], f["lo"], f["hi"], f["ends"], f["up"]
    bottom_up = sorted((v for v in range(len(depth)) if up[v] != -2), key=lambda v: -depth[v])
    end = len(ids) - 1
    names = {0: prefix_names(first), 1: prefix_names(last)}  # of the nodes that hold the first, the last sequence
    smallest = [ids[lo[v]] if ends[v] else None for v in range(len(depth))]
    for v in bottom_up:
        if (p := up[v]) >= 0 and (smallest[p] is None or smallest[v] < smallest[p]):
            smallest[p] = smallest[v]
    kids, leaves, saved = [0] * len(depth), [0] * len(depth), [0] * len(depth)
    for v in bottom_up:
        p, n, low = up[v], hi[v] - lo[v] + 1, smallest[v]
        above = depth[p] if p >= 0 else -1
        words = new_words[lo[v]]
        own = ",".join(map(str, ids[lo[v] : lo[v] + ends[v]]))
        left, right = lo[v] == 0, hi[v] == end
        open_ = left or right
        if not open_ and not kids[v]:
            leaves[v] = 1
        total = saved[v]
        for d in range(depth[v], above, -1):
            deepest = d == depth[v]
            w = words[d - 1 - lcps[lo[v]]] if d else 0
            if open_:
                path = names[0] if left else names[1]
                yield (part, low, d, None, path[d - 1] if d else None, n, kids[v] * deepest, leaves[v] * deepest, saved[v] * deepest, None, path[d], w, left, right,
                       lengths[hi[v]] == d, own if deepest and own else None, ids[lo[v]] if deepest and own else None, first if d == 0 else None, last if d == 0 else None)
                continue
            total += (n - 1) * w
            hangs = d - 1 == above and (lo[p] == 0 or hi[p] == end)
            under = (names[0] if lo[p] == 0 else names[1])[above] if hangs else None
            parent = None if hangs else low if d - 1 > above else smallest[p]
            digest = hashlib.sha256(own.encode()).hexdigest() if deepest and own else _NOTHING
            yield (part, low, d, parent, under, n, kids[v] if deepest else 1, leaves[v], total, digest, *(None,) * 9)
        if p >= 0 and not open_:
            kids[p] += 1
            leaves[p] += leaves[v]
            saved[p] += total


def _partition_forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ids, lengths, lcps, new_words, first, last = [], [], [], [], b"", b""
    for batch in batches:
        for conv, path, words in zip(batch.column("conv_id").to_pylist(), batch.column("path").to_pylist(), batch.column("words").to_pylist()):
            shared = common_turns(last, path) if ids else 0
            first = first if ids else path
            ids.append(conv)
            lengths.append(len(path) // TURN)
            lcps.append(shared)
            new_words.append(words[shared:])
            last = path
    if not ids:
        return
    rows = []
    for row in _nodes(TaskContext.get().partitionId(), ids, lengths, lcps, new_words, first, last):
        rows.append(row)
        if len(rows) == 20_000:
            yield _batch(rows)
            rows = []
    yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * len(_ARROW), _ARROW)], schema=_ARROW)


def _boundaries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        lcp = lambda a, b: -1 if a is None or b is None else common_turns(a, b)
        yield pd.DataFrame({
            "part": pdf["part"], "before": [lcp(a, b) for a, b in zip(pdf["previous"], pdf["first_path"])],
            "after": [lcp(a, b) for a, b in zip(pdf["last_path"], pdf["next"])]}).astype({"before": "int64", "after": "int64"})


def _contracted(pdf: pd.DataFrame) -> pd.DataFrame:
    """Sums over the subtrees of a partition's shared nodes, each thing counted in one partition: children and nodes where they begin, childless nodes where they end."""
    out = {}
    for r in sorted(pdf.itertuples(), key=lambda r: -r.depth):
        begins = not r.at_left or r.depth > r.before
        childless = (not r.at_right or r.depth > r.after) and r.last_ends
        kids, leaves, saved = out.get(r.node, (0, 0, 0))
        kids, leaves, saved = kids + r.n_children, leaves + r.n_leaves + childless, saved + r.saved_tokens + (r.n_convs - begins) * r.words
        out[r.node] = (kids, leaves, saved)
        if r.under is not None:
            k, x, s = out.get(r.under, (0, 0, 0))
            out[r.under] = (k + begins, x + leaves, s + saved)
    kept = pdf[["node", "under", "depth", "conv_id", "n_convs"]].copy()
    for i, c in enumerate(("n_children", "n_leaves", "saved_tokens")):
        kept[c] = [int(out[x][i]) for x in pdf["node"]]
    return kept


def _end_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, digest) of the joined chunks; rows come by node and then in order."""
    node, h = None, None
    names, digests = [], []
    for batch in batches:
        for key, chunk in zip(batch.column("node").to_pylist(), batch.column("ends").to_pylist()):
            if key != node:
                if node is not None:
                    names.append(node)
                    digests.append(h.hexdigest())
                node, h = key, hashlib.sha256(chunk.encode())
            else:
                h.update(b"," + chunk.encode())
    if node is not None:
        names.append(node)
        digests.append(h.hexdigest())
    yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(digests, pa.string())], names=["node", "ends_sha256"])


def trie_nodes(seqs: DataFrame, part_turns: int = PART_TURNS) -> DataFrame:
    """Per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``seqs`` is what ``sequences`` returns, one row per conv_id. saved_tokens is what sharing saves in the
    node's subtree: for each node the words of its last turn, times its members but one.
    """
    spark = seqs.sparkSession
    joined = F.unhex(F.array_join(F.transform("turns", lambda t: F.hex(t["key"])), ""))
    paths = cut(seqs.select("conv_id", joined.alias("path"), F.transform("turns", lambda t: t["words"]).alias("words")))
    turns = paths.agg(F.sum(F.size("words") + F.lit(1).cast("long"))).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-turns // part_turns))
    ranged = paths.repartitionByRange(parts, "path", "conv_id").sortWithinPartitions("path", "conv_id")
    found = cut(ranged.mapInArrow(_partition_forest, _FOREST))

    in_order = Window.orderBy("first_path", "last_path", "conv_id")  # a row per partition
    edges = found.filter("node is not null and depth = 0").select(
        "part", "first_path", "last_path", F.lag("last_path").over(in_order).alias("previous"), F.lead("first_path").over(in_order).alias("next"))
    limits = edges.mapInPandas(_boundaries, "part int, before bigint, after bigint")
    shared = found.filter("node is not null").drop("first_path", "last_path", "ends", "ends_from", "parent_conv_id", "ends_sha256")
    summed = cut(shared.join(limits, "part").groupBy("part").applyInPandas(
        _contracted, "node binary, under binary, depth bigint, conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint"))
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    merged = cut(summed.groupBy("node").agg(F.min("under").alias("under"), F.min("depth").alias("depth"), F.min("conv_id").alias("conv_id"), *sums))
    chunks = found.filter("ends is not null and node is not null").select("node", "ends_from", "ends")
    digests = chunks.repartition("node").sortWithinPartitions("node", "ends_from").mapInArrow(_end_digests, "node binary, ends_sha256 string")
    named = merged.select(F.col("node").alias("under"), F.col("conv_id").alias("parent_conv_id"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    across = merged.join(named, "under", "left").join(digests, "node", "left").fillna({"ends_sha256": _NOTHING}).select(columns)
    complete = found.filter("node is null")
    of_part = shared.select("part", F.col("node").alias("under")).distinct().join(named, "under")
    hanging = complete.filter("under is not null").drop("parent_conv_id").join(of_part, ["part", "under"]).select(columns)
    return complete.filter("under is null").select(columns).unionByName(hanging).unionByName(across)
