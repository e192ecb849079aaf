"""Prefix trie of conversations: which openings conversations share, and what sharing saves.

A conversation is a sequence of turns (role, text); a node is a distinct sequence of first turns.
Distinct sequences are dealt to *prefix shards*. In a shard the turns get dense ids, and the trie
is packed as a double array (Aoe: An Efficient Digital Search Algorithm by Using a Double-Array
Structure, IEEE TSE 1989): the child of slot s by turn id c is slot BASE[s] + c if CHECK there is
s. Sequences are then walked through BASE and CHECK to count members, and subtrees are summed from
the leaves up.

Shards: a sequence is cut at the first of the depths 0, 1, 2, 4, ... whose prefix has at most
``SHARD_TURNS`` turns below it; prefixes of one bucket of hashes share a task. An opening with a third
of all conversations is so cut deeper, wherever its conversations part. Nodes below the cut
belong to one shard. Nodes above it, the *shared* upper nodes, come from several shards and are
merged by a digest of their path. Their subtree sums follow by pointer doubling over the upper
trie: each round adds the sums of descendants twice as far away, so a path of d shared nodes takes
log2(d) rounds, no loop over depths.

Equal conversations are one sequence. The ids of its members are sorted by range over all tasks
and become strings of many ids each; only the SHA-256 over a sequence's ids, sequential by its
nature, streams through one task, in bounded memory.

Rebuilding (``rebuilt``): conversation c takes the first h = crc32(c) % 9 turns of conversation
c - c % 5 and its own turns after its first h.

Defined cases: turns are ordered by ``turn``, null first, ties by a digest of role and text; null
role or text is empty; repeated rows are turns of their own; rows without conv_id belong to no
conversation; a conversation may be rebuilt to no turn and ends at the root; very long texts enter as digest
and length only; an empty table has no nodes. A conversation travels as one row of 16-byte turn
digests, so its number of turns, not its text, must fit a row.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from fallscan.llm.common import settle, small_side

# Fixed values of the rebuilding.
FAMILY = 5
HEAD_CYCLE = 9

#: Turns below a prefix beyond which it is cut deeper, and turns that a task is sized for.
SHARD_TURNS = 20_000

#: Tries to fit a node's children between taken slots before they go behind the last one.
FIT_TRIES = 64

_FREE, _ROOT = -2, -1

NODES = (
    "shared boolean, key binary, parent_key binary, conv_id long, depth int, parent_conv_id long, "
    "n_convs long, bytes long, n_children long, n_leaves long, saved long, ends string"
)
NO_ENDS = hashlib.sha256(b"").hexdigest()


# ---- conversations as sequences of turns ---------------------------------------------------


def sequences(turns: DataFrame) -> DataFrame:
    """(conv_id, turns) with turns in order, each as (key, bytes)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    named = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    key = F.unhex(F.substring(F.sha2(named, 256), 1, 32))
    item = F.struct(
        F.col("turn").cast("long").alias("turn"), key.alias("key"), F.octet_length(text).alias("bytes")
    )
    ordered = F.array_sort(F.collect_list(item))
    return (
        turns.where("conv_id is not null")
        .groupBy(F.col("conv_id").cast("long").alias("conv_id"))
        .agg(ordered.alias("items"))
        .select("conv_id", F.transform("items", lambda t: F.struct(t["key"], t["bytes"])).alias("turns"))
    )


def rebuilt(convs: DataFrame) -> DataFrame:
    """Conversations with the head of their family's first one; see the module."""
    head_turns = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(HEAD_CYCLE))
    family = F.col("conv_id") - F.col("conv_id") % FAMILY
    heads = convs.where(F.col("conv_id") % FAMILY == 0).select(
        F.col("conv_id").alias("family"), F.slice("turns", 1, HEAD_CYCLE - 1).alias("head")
    )
    own = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))
    opening = F.slice("head", F.lit(1), F.col("h"))
    with_head = convs.withColumns({"h": head_turns.cast("int"), "family": family})
    return with_head.join(heads, "family", "left").select(
        "conv_id", F.when(F.col("head").isNull(), own).otherwise(F.concat(opening, own)).alias("turns")
    )


# ---- members of equal sequences ------------------------------------------------------------


def _strings_of_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of one sequence in a sorted batch, a row each with all ids of the run."""
    for batch in batches:
        if not batch.num_rows:
            continue
        keys, ids = batch.column("sequence").to_pylist(), batch.column("conv_id").to_pylist()
        starts = [k for k in range(len(keys)) if not k or keys[k] != keys[k - 1]]
        ends = starts[1:] + [len(keys)]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([keys[k] for k in starts], pa.binary()),
                pa.array([ids[k] for k in starts], pa.int64()),
                pa.array([e - s for s, e in zip(starts, ends)], pa.int64()),
                pa.array([",".join(map(str, ids[s:e])) for s, e in zip(starts, ends)]),
            ],
            ["sequence", "first", "n", "ids"],
        )


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per sequence from its sorted strings, which stream through a running hash."""
    names = ["sequence", "conv_id", "n", "ends"]
    key, first, n, state = None, None, 0, None
    for batch in batches:
        done = []
        for row in zip(*(batch.column(c).to_pylist() for c in ("sequence", "first", "n", "ids"))):
            if row[0] != key:
                if key is not None:
                    done.append((key, first, n, state.hexdigest()))
                key, first, n, state = row[0], row[1], 0, hashlib.sha256()
            elif n:
                state.update(b",")
            state.update(row[3].encode())
            n += row[2]
        columns = list(zip(*done)) or [()] * 4
        kinds = (pa.binary(), pa.int64(), pa.int64(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)
    if key is not None:
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([key], pa.binary()), pa.array([first], pa.int64()),
                pa.array([n], pa.int64()), pa.array([state.hexdigest()]),
            ],
            names,
        )


def distinct_sequences(convs: DataFrame) -> DataFrame:
    """(conv_id, n, ends, turns): every distinct sequence with its smallest member, the number
    of members and the digest of their ids; settled."""
    path = F.array_join(F.transform("turns", lambda t: F.hex(t["key"])), "")
    named = settle(convs.select("conv_id", "turns", F.unhex(F.sha2(path, 256)).alias("sequence")))
    sorted_ids = (
        named.select("sequence", "conv_id")
        .repartitionByRange("sequence", "conv_id")
        .sortWithinPartitions("sequence", "conv_id")
    )
    strings = sorted_ids.mapInArrow(_strings_of_ids, "sequence binary, first long, n long, ids string")
    members = (
        strings.repartition("sequence")
        .sortWithinPartitions("sequence", "first")
        .mapInArrow(_digests, "sequence binary, conv_id long, n long, ends string")
    )
    return settle(members.drop("sequence").join(named.drop("sequence"), "conv_id"))


# ---- prefix shards -------------------------------------------------------------------------


def _prefix(depth: Column) -> Column:
    return F.xxhash64(F.slice("turns", F.lit(1), F.least(depth, F.size("turns"))))


def sharded(seqs: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """Add ``cut``, the depth above which a sequence's nodes are shared, and its ``bucket``.

    Whether a prefix is cut deeper depends on the prefix alone, therefore all sequences through a
    node agree whether it is shared. Prefixes with equal hashes are cut alike, which does no harm.
    """
    total = seqs.agg(F.sum(F.size("turns") + 1)).first()[0] or 0
    if total <= shard_turns:
        return seqs.withColumns({"cut": F.lit(0), "bucket": F.lit(0)})
    size = F.size("turns")
    depths = F.expr("transform(sequence(0, 30), k -> cast(shiftleft(1, k) as int))")
    reached = F.filter(depths, lambda d: d <= size)
    prefixes = seqs.select(
        "conv_id", (size + 1).alias("weight"),
        F.explode(F.transform(reached, lambda d: F.struct(d.alias("depth"), _prefix(d).alias("prefix")))).alias("p"),
    ).select("conv_id", "weight", "p.depth", "p.prefix")
    prefixes = settle(prefixes)
    heavy = (
        prefixes.groupBy("depth", "prefix")
        .agg(F.sum("weight").alias("turns"))
        .where(F.col("turns") > shard_turns)
        .select("depth", "prefix", F.lit(True).alias("heavy"))
    )
    cuts = (
        prefixes.join(small_side(settle(heavy)), ["depth", "prefix"], "left")
        .where("heavy is null")
        .groupBy("conv_id")
        .agg(F.min("depth").alias("light"))
    )
    beyond = F.element_at(F.filter(depths, lambda d: d > size), 1)
    buckets = math.ceil(total / shard_turns)
    return (
        seqs.join(cuts, "conv_id", "left")
        .withColumn("cut", F.coalesce("light", beyond))
        .withColumn("bucket", F.pmod(_prefix(F.col("cut")), F.lit(buckets)).cast("int"))
        .drop("light")
    )


# ---- the double array of one shard ---------------------------------------------------------


class DoubleArray:
    """A trie over sequences of dense ids, packed into BASE and CHECK."""

    def __init__(self, ordered: list[list[int]]):
        """``ordered``: distinct sequences in lexicographic order."""
        self.base, self.check = [0], [_ROOT]
        self.order = [0]  # slots, parents before their children
        self._free = 1
        pending = [(0, 0, len(ordered), 0)] if ordered else []
        for slot, low, high, depth in pending:  # grows while it is walked: breadth first
            if high - low == 1:
                for symbol in ordered[low][depth:]:
                    slot = self._place(slot, [symbol])[0]
                continue
            while low < high and len(ordered[low]) == depth:
                low += 1
            starts, symbols = [], []
            for k in range(low, high):
                if not symbols or ordered[k][depth] != symbols[-1]:
                    starts.append(k)
                    symbols.append(ordered[k][depth])
            if symbols:
                slots = self._place(slot, symbols)
                for child, a, b in zip(slots, starts, starts[1:] + [high]):
                    pending.append((child, a, b, depth + 1))

    def _taken(self, slot: int) -> bool:
        return slot < len(self.check) and self.check[slot] != _FREE

    def _place(self, parent: int, symbols: list[int]) -> list[int]:
        """Take slots BASE[parent] + symbol for all symbols, which ascend."""
        while self._taken(self._free):
            self._free += 1
        at, lead = self._free, symbols[0]
        for _ in range(FIT_TRIES):
            if not any(self._taken(at + s - lead) for s in symbols):
                break
            at += 1
            while self._taken(at):
                at += 1
        else:
            at = len(self.check)
        slots = [at + s - lead for s in symbols]
        missing = slots[-1] + 1 - len(self.check)
        if missing > 0:
            self.check.extend([_FREE] * missing)
            self.base.extend([0] * missing)
        self.base[parent] = at - lead
        for slot in slots:
            self.check[slot] = parent
        self.order.extend(slots)
        return slots

    def walk(self, symbols: list[int]) -> list[int]:
        """The slots of a sequence's nodes, the root first."""
        slots, at = [0], 0
        for symbol in symbols:
            slot = self.base[at] + symbol
            if slot < 0 or slot >= len(self.check) or self.check[slot] != at:
                raise KeyError(symbol)
            slots.append(slot)
            at = slot
        return slots


def _nodes(group: pa.Table) -> pa.Table:
    """All nodes of one shard with what the shard knows of them."""
    group = group.combine_chunks()
    lists = group.column("turns").combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.chunk(0)
    flat = lists.flatten()
    keys = flat.field("key").to_pylist()
    lengths = flat.field("bytes").to_pylist()
    dense: dict[bytes, int] = {}
    ids = [dense.setdefault(k, len(dense)) for k in keys]
    size_of = [0] * len(dense)
    for symbol, length in zip(ids, lengths):
        size_of[symbol] = length
    bounds = np.cumsum([0] + [len(x) for x in lists]).tolist()
    conv, n, ends, cut = (group.column(c).to_pylist() for c in ("conv_id", "n", "ends", "cut"))
    rows = sorted(
        (ids[a:b], conv[k], n[k], ends[k], cut[k])
        for k, (a, b) in enumerate(zip(bounds, bounds[1:]))
    )
    trie = DoubleArray([row[0] for row in rows])
    slots = len(trie.check)
    members, least, depth = [0] * slots, [None] * slots, [0] * slots
    text_bytes, shared, ended = [0] * slots, [False] * slots, [None] * slots
    symbol_of = [0] * slots
    for symbols, first, count, digest, deep in rows:
        path = trie.walk(symbols)
        for at, slot in enumerate(path):
            members[slot] += count
            if least[slot] is None:
                least[slot], depth[slot], shared[slot] = first, at, at < deep
                if at:
                    symbol_of[slot] = symbols[at - 1]
                    text_bytes[slot] = size_of[symbols[at - 1]]
            elif first < least[slot]:
                least[slot] = first
        ended[path[-1]] = digest
    children, leaves, saved = [0] * slots, [0] * slots, [0] * slots
    for slot in reversed(trie.order):
        if shared[slot]:
            continue
        leaves[slot] = leaves[slot] or 1
        saved[slot] += (members[slot] - 1) * text_bytes[slot]
        parent = trie.check[slot]
        if parent >= 0:
            children[parent] += 1
            leaves[parent] += leaves[slot]
            saved[parent] += saved[slot]
    names = list(dense)
    path_key: dict[int, bytes] = {_ROOT: b""}
    for slot in trie.order:
        if shared[slot]:
            above = path_key[trie.check[slot]]
            turn = names[symbol_of[slot]] if depth[slot] else b""
            path_key[slot] = hashlib.blake2b(above + turn, digest_size=16).digest()
    own = [(s, trie.check[s]) for s in trie.order]
    top = [p >= 0 and (shared[s] or shared[p]) for s, p in own]  # the parent is a shared node
    columns = [
        [shared[s] for s, _ in own],
        [path_key.get(s) for s, _ in own],
        [path_key[p] if t else None for (_, p), t in zip(own, top)],
        [least[s] for s, _ in own],
        [depth[s] for s, _ in own],
        [least[p] if p >= 0 and not t else None for (_, p), t in zip(own, top)],
        *([values[s] for s, _ in own] for values in (members, text_bytes, children, leaves, saved, ended)),
    ]
    fields = [f.split() for f in NODES.split(", ")]
    kinds = {"boolean": pa.bool_(), "binary": pa.binary(), "long": pa.int64(), "int": pa.int32(), "string": pa.string()}
    return pa.table({name: pa.array(c, kinds[kind]) for c, (name, kind) in zip(columns, fields)})


# ---- shared upper nodes --------------------------------------------------------------------


def _merged(parts: DataFrame) -> DataFrame:
    """The upper nodes with the sums of all shards and of their subtrees; settled."""
    nodes = (
        parts.groupBy("key")
        .agg(
            F.min("parent_key").alias("parent_key"),
            F.min("conv_id").alias("conv_id"),
            F.first("depth").alias("depth"),
            F.sum("n_convs").alias("n_convs"),
            F.first("bytes").alias("bytes"),
            F.sum("n_children").alias("below"),
            F.sum("n_leaves").alias("n_leaves"),
            F.sum("saved").alias("saved"),
            F.max("ends").alias("ends"),
        )
    )
    nodes = settle(nodes)
    upper = (
        nodes.where("parent_key is not null")
        .groupBy(F.col("parent_key").alias("key"))
        .agg(F.count("*").alias("upper"))
    )
    children = F.col("below") + F.coalesce("upper", F.lit(0))
    nodes = settle(
        nodes.join(upper, "key", "left").select(
            "key", "parent_key", "conv_id", "depth", "n_convs", "ends",
            children.alias("n_children"),
            (F.col("n_leaves") + (children == 0).cast("long")).alias("n_leaves"),
            (F.col("saved") + (F.col("n_convs") - 1) * F.col("bytes")).alias("saved"),
        )
    )
    sums = nodes.select("key", F.col("parent_key").alias("above"), "n_leaves", "saved")
    while not sums.where("above is not null").isEmpty():
        up = (
            sums.where("above is not null")
            .groupBy(F.col("above").alias("key"))
            .agg(F.sum("n_leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        )
        further = sums.select(F.col("key").alias("above"), F.col("above").alias("next"))
        sums = settle(
            sums.join(up, "key", "left")
            .join(small_side(further), "above", "left")
            .select(
                "key",
                F.col("next").alias("above"),
                (F.col("n_leaves") + F.coalesce("more_leaves", F.lit(0))).alias("n_leaves"),
                (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"),
            )
        )
    return settle(nodes.drop("n_leaves", "saved").join(sums.drop("above"), "key"))


# ---- the whole -----------------------------------------------------------------------------


def prefix_nodes(convs: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """The nodes of the trie of ``convs`` (conv_id, turns); conv_id must be unique."""
    seqs = sharded(distinct_sequences(convs), shard_turns)
    found = settle(
        seqs.select("bucket", "conv_id", "n", "ends", "cut", "turns")
        .groupBy("bucket")
        .applyInArrow(_nodes, NODES)
    )
    columns = [
        F.col("conv_id"),
        F.col("depth").cast("long").alias("depth"),
        F.col("parent_conv_id"),
        F.col("n_convs"),
        F.col("n_children"),
        F.col("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends", F.lit(NO_ENDS)).alias("ends_sha256"),
    ]
    lower = found.where("not shared and parent_key is null").select(*columns)
    if found.where("shared").isEmpty():
        return lower
    upper = _merged(found.where("shared"))
    parents = small_side(
        upper.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    )
    tops = found.where("not shared and parent_key is not null").drop("parent_conv_id")
    return (
        lower.unionByName(tops.join(parents, "parent_key").select(*columns))
        .unionByName(upper.join(parents, "parent_key", "left").select(*columns))
    )


def conversation_trie(turns: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """The nodes of the trie of all rebuilt conversations of a table of turns."""
    return prefix_nodes(rebuilt(settle(sequences(turns))), shard_turns)


ORACLE_SQL = rf"""
WITH RECURSIVE table_of(i, v, k) AS (
    SELECT i::BIGINT, i::BIGINT, 0 FROM range(256) AS r(i)
    UNION ALL
    SELECT i, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END, k + 1
    FROM table_of WHERE k < 8),
crc_table AS (SELECT i, v FROM table_of WHERE k = 8),
ids AS (SELECT DISTINCT conv_id AS c, conv_id::VARCHAR AS s FROM conversations WHERE conv_id IS NOT NULL),
crc(c, s, pos, v) AS (
    SELECT c, s, 0, 4294967295::BIGINT FROM ids
    UNION ALL
    SELECT c, s, pos + 1, xor(x.v // 256, t.v)
    FROM crc x JOIN crc_table t ON t.i = xor(x.v % 256, ascii(s[pos + 1:pos + 1])::BIGINT)
    WHERE pos < length(s)),
heads AS (SELECT c, xor(v, 4294967295) % {HEAD_CYCLE} AS h FROM crc WHERE pos = length(s)),
items AS (
    SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text, turn,
           left(sha256(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '')
                       || coalesce(text, '')), 32) AS key
    FROM conversations WHERE conv_id IS NOT NULL),
placed AS (
    SELECT c, key, strlen(text) AS bytes,
           row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, key) AS p FROM items),
built AS (
    SELECT h.c, p.p, p.key, p.bytes FROM heads h JOIN placed p ON p.c = h.c AND p.p > h.h
    UNION ALL
    SELECT h.c, p.p, p.key, p.bytes FROM heads h JOIN placed p
      ON p.c = h.c - h.c % {FAMILY} AND p.p <= h.h),
numbered AS (
    SELECT c, key, bytes, row_number() OVER (PARTITION BY c ORDER BY p) AS d FROM built),
paths AS (
    SELECT c, d, bytes, md5(string_agg(key, '') OVER (PARTITION BY c ORDER BY d)) AS path FROM numbered
    UNION ALL SELECT c, 0, 0, '' FROM ids),
lengths AS (SELECT c, max(d) AS len FROM paths GROUP BY c),
nodes AS (
    SELECT path, d, min(c) AS least, count(*) AS n, any_value(bytes) AS bytes,
           sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (len = d), '')) AS ends
    FROM paths JOIN lengths USING (c) GROUP BY path, d),
parents AS (
    SELECT n.path, n.d, p.path AS above, up.least AS parent
    FROM nodes n JOIN paths p ON p.c = n.least AND p.d = n.d - 1
    JOIN nodes up ON up.path = p.path AND up.d = n.d - 1),
children AS (SELECT above AS path, d - 1 AS d, count(*) AS k FROM parents GROUP BY ALL),
full_nodes AS (
    SELECT n.*, coalesce(k, 0) AS k FROM nodes n LEFT JOIN children c ON c.path = n.path AND c.d = n.d),
sums AS (
    SELECT a.path, a.d, count(*) FILTER (v.k = 0) AS leaves, sum((v.n - 1) * v.bytes) AS saved
    FROM full_nodes v JOIN paths a ON a.c = v.least AND a.d <= v.d GROUP BY ALL)
SELECT n.least AS conv_id, n.d::BIGINT AS depth, p.parent AS parent_conv_id,
       n.n::BIGINT AS n_convs, n.k::BIGINT AS n_children, s.leaves::BIGINT AS n_leaves,
       s.saved::BIGINT AS saved_tokens, n.ends AS ends_sha256
FROM full_nodes n JOIN sums s ON s.path = n.path AND s.d = n.d
LEFT JOIN parents p ON p.path = n.path AND p.d = n.d
"""
