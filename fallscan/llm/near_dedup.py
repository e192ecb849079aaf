"""Near-duplicates: MinHash signatures joined by a multi-index Hamming search, links confirmed
on whole shingle sets.

A set of five-word shingles gets a signature of ``SYMBOLS`` minimum hashes of b = 32 bits. Two
sets of similarity J differ in a symbol with probability 1 - J, so the Hamming distance over
symbols estimates 1 - J. All pairs of signatures at a distance of at most ``MAX_DISTANCE`` share
a key (Norouzi, Punjani, Fleet: Fast Search in Hamming Space with Multi-Index Hashing, CVPR
2012): the signature is split into ``CHUNKS`` chunks; by the pigeonhole principle one chunk has
at most floor(MAX_DISTANCE / CHUNKS) = 1 error, and both sides enumerate that error, a symbol
left out, as keys. At J = 0.75 a pair lies beyond the distance with a probability below 1e-8.

Keys that a common passage makes are crowded and say little. A chunk is *crowded* for a document
if one of its keys has more than ``CROWD`` nodes. A document with at least ``OPEN_CHUNKS`` other
chunks is found by those: a chunk of a pair at J = 0.75 has more than one error with probability
0.16. Such chunks and crowded ones are not independent (a chunk with two errors is not crowded by the
passage that both share), so of pairs at 0.75 whose common passage is half of their union about
6e-6 are lost, at three quarters 2e-4. The rest, documents made mostly of common text, are joined
exactly: similar sets share one of their rarest shingles, counted over all these documents
(prefix filter; Chaudhuri, Ganti, Kaushik: A Primitive Operator for Similarity Joins, ICDE 2006).

Work per group is not quadratic. Documents with equal sets are one node. A key's nodes are
first compared with a few leaders only, since copies of one original need not be similar to each
other; confirmed links join them to components. Then only nodes of a key that are still in
different components are compared, all of them, in blocks. Before sets are fetched, a
bitmap of parities rejects pairs: it differs in no more bits than the sets differ in shingles,
so it never rejects a link. Pairs are neither written nor shuffled there: a block names the
nodes that passing pairs tie together, and returns a spanning forest of their confirmed links.

Defined cases: null and blank texts have an empty set, link with nothing and are kept; a null
doc_id takes part with null as its id, which no component takes as its smallest; rows that
repeat a doc_id share a component; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from fallscan.llm import shingles
from fallscan.llm.common import broadcast_bytes, free_names, settle, small_side

CHUNKS = 16
CHUNK_SYMBOLS = 3
SYMBOLS = CHUNKS * CHUNK_SYMBOLS
MAX_DISTANCE = 31

#: Nodes from which a key is crowded, and chunks that a node needs without such keys.
CROWD = 64
OPEN_CHUNKS = 9

#: Bits of the bitmap of parities.
BITMAP = 2048

#: The similarity that links: 100 * intersection >= SIMILARITY * union.
SIMILARITY = 75

#: Leaders of a key beside its smallest node, and salts by which they are drawn. They steer work
#: only: what the leaders do not join is compared exactly.
LEADERS = 2
SALTS = 8

#: Nodes of one key that one task compares with each other or with another block.
BLOCK = 512

#: Shingles of whole sets that one block may hold on average, 8 bytes each.
BLOCK_SHINGLES = 1 << 20

_U64 = np.uint64
_FACTORS = shingles.seeded(11, SYMBOLS) | _U64(1)
_TERMS = shingles.seeded(12, SYMBOLS)
_KEY_SEEDS = shingles.seeded(13, SYMBOLS)
_SPAN = 1 << 15  # shingles hashed at a time, so that a pass stays in the cache

SIGNED = "doc_id long, n_shingles long, digest binary, signature binary, bitmap binary"


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """Minimum hashes of several non-empty sets, a row of SYMBOLS 32-bit numbers for each."""
    out = np.empty((len(sets), SYMBOLS), np.uint32)
    at = 0
    while at < len(sets):
        end, held = at, 0
        while end < len(sets) and (end == at or held + len(sets[end]) <= _SPAN):
            held += len(sets[end])
            end += 1
        x = np.concatenate(sets[at:end])
        starts = np.cumsum([0] + [len(s) for s in sets[at : end - 1]])
        work = np.empty_like(x)
        for k in range(SYMBOLS):
            np.multiply(x, _FACTORS[k], out=work)
            np.add(work, _TERMS[k], out=work)
            least = np.minimum.reduceat(work, starts)
            out[at:end, k] = (least * _U64(0x9E3779B97F4A7C15)) >> _U64(32)
        at = end
    return out


def bitmap_of(shingle_hashes: np.ndarray) -> bytes:
    """For each of BITMAP classes of shingles, whether their number is odd."""
    classes = (shingle_hashes & _U64(BITMAP - 1)).astype(np.int64)
    return np.packbits(np.bincount(classes, minlength=BITMAP).astype(np.uint8) & 1).tobytes()


def most_differing(total_size):
    """Most shingles in which two linked sets of so many shingles in all can differ."""
    return total_size * (100 - SIMILARITY) // (100 + SIMILARITY)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [shingles.shingle_set(w) for w in shingles.word_groups(batch.column("text"))]
        full = [s for s in sets if len(s)]
        rows = iter(signatures(full) if full else ())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([shingles.digest_of(s) for s in sets], pa.binary()),
                pa.array([next(rows).tobytes() if len(s) else None for s in sets], pa.binary()),
                pa.array([bitmap_of(s) for s in sets], pa.binary()),
            ],
            ["doc_id", "n_shingles", "digest", "signature", "bitmap"],
        )


def signed(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, digest, signature) of every document, settled."""
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return settle(narrow.mapInArrow(_sign, SIGNED))


def _nodes(found: DataFrame) -> DataFrame:
    """One node per distinct set: (node, digest, least_id, n, signature, bitmap), settled."""
    sets = (
        found.where("digest is not null")
        .groupBy("digest")
        .agg(
            F.min("doc_id").alias("least_id"),
            F.first("n_shingles").alias("n"),
            F.first("signature").alias("signature"),
            F.first("bitmap").alias("bitmap"),
        )
    )
    return settle(sets.withColumn("node", F.monotonically_increasing_id()))


def _matrix(column: pa.Array, kind: type, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, width)


def _bitmaps(column: pa.Array) -> np.ndarray:
    return _matrix(column, np.uint64, BITMAP // 64)


def chunk_keys(matrix: np.ndarray, chunk: int) -> np.ndarray:
    """Keys of one chunk, a column for each symbol that may be wrong."""
    at = chunk * CHUNK_SYMBOLS
    symbols = matrix[:, at : at + CHUNK_SYMBOLS].astype(_U64)
    keys = np.empty((len(matrix), CHUNK_SYMBOLS), _U64)
    for left_out in range(CHUNK_SYMBOLS):
        key = np.full(len(matrix), _KEY_SEEDS[at + left_out])
        for k in range(CHUNK_SYMBOLS):
            if k != left_out:
                key = shingles._mix(key ^ symbols[:, k])
        keys[:, left_out] = key
    return keys


def _enumerate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        matrix = _matrix(batch.column("signature"), np.uint32, SYMBOLS)
        keys = np.concatenate([chunk_keys(matrix, c) for c in range(CHUNKS)], axis=1)
        nodes = batch.column("node").to_numpy()
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(keys.ravel().view(np.int64)),
                pa.array(np.repeat(nodes, SYMBOLS)),
                pa.array(np.tile(np.arange(SYMBOLS, dtype=np.int32) // CHUNK_SYMBOLS, len(nodes))),
            ],
            ["key", "node", "chunk"],
        )


def _shared_keys(nodes: DataFrame) -> DataFrame:
    """(key, node, chunk, size) of keys that two nodes or more have, settled.

    One shuffle of narrow rows; keys of a single node, the great majority, end here.
    """
    keys = nodes.select("node", "signature").mapInArrow(
        _enumerate, "key long, node long, chunk int"
    )
    size = F.count("*").over(Window.partitionBy("key")).alias("size")
    return settle(keys.select("*", size).where("size > 1"))


def _explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [np.frombuffer(s.as_buffer(), np.int64) for s in batch.column("shingles")]
        if not sets:
            continue
        sizes = np.array([len(s) for s in sets], np.int64)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate(sets)),
                pa.array(np.repeat(batch.column("node").to_numpy(), sizes)),
                pa.array(np.repeat(sizes, sizes)),
            ],
            ["key", "node", "n"],
        )


def _rare_keys(docs: DataFrame, nodes: DataFrame, shared: DataFrame) -> DataFrame:
    """(key, node, n, fits): the rarest shingles of nodes with too few uncrowded chunks, settled.

    Sets with 100 * intersection >= SIMILARITY * union share one of the first
    n - ceil(SIMILARITY / 100 * n) + 1 shingles of either, in any common order; the order is
    by how many of these nodes have a shingle. Shingles of a single node come first and join
    nothing, therefore they are counted and not kept.

    At the first shingle that two sets share, neither has more in common with the other than the
    shingles from there on, so a set links there only with sets of at most ``fits`` shingles, and
    only if it fits them too. Rows that fit no other row of their key are left out.
    """
    crowded = (
        shared.where(F.col("size") > CROWD)
        .groupBy("node")
        .agg(F.count_distinct("chunk").alias("chunks"))
        .where(F.col("chunks") > CHUNKS - OPEN_CHUNKS)
        .select("node")
    )
    sets = settle(_sets(docs, nodes, settle(crowded)))
    rows = sets.mapInArrow(_explode, "key long, node long, n long")
    common = rows.select("*", F.count("*").over(Window.partitionBy("key")).alias("owners"))
    common = common.where("owners > 1")
    by_node = Window.partitionBy("node")
    single = F.col("n") - F.count("*").over(by_node)
    rank = F.row_number().over(by_node.orderBy("owners", "key"))
    least = F.floor((F.col("n") * SIMILARITY + 99) / 100)
    prefix = common.select("key", "node", (single + rank).alias("rank"), least.alias("least"), "n")
    left = F.col("n") - F.col("rank") + 1
    fits = F.floor(left * (100 + SIMILARITY) / SIMILARITY).cast("long") - F.col("n")
    at_key = Window.partitionBy("key")
    bounds = [F.min("n").over(at_key).alias("least"), F.max("fits").over(at_key).alias("most")]
    kept = prefix.where("rank <= n - least + 1").select("key", "node", "n", fits.alias("fits"))
    kept = kept.select("*", *bounds).where("fits >= least and n <= most")
    return settle(kept.drop("least", "most"))


def _within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs that sizes and bitmaps do not rule out."""
    for batch in batches:
        if batch.num_rows:
            a, b = _bitmaps(batch.column("bitmap_a")), _bitmaps(batch.column("bitmap_b"))
            sizes = batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy()
            differ = np.bitwise_count(a ^ b).sum(axis=1, dtype=np.int64)
            near = pa.array(differ <= most_differing(sizes))
            yield batch.select(["a", "b"]).filter(near)


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sorted, non-empty sets of shingles link."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    at = np.searchsorted(large, small)
    at[at == len(large)] = 0
    common = int((large[at] == small).sum())
    return 100 * common >= SIMILARITY * (len(a) + len(b) - common)


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose whole sets are similar enough."""
    for batch in batches:
        linked = [
            similar(np.frombuffer(x.as_buffer(), _U64), np.frombuffer(y.as_buffer(), _U64))
            for x, y in zip(batch.column("shingles_a"), batch.column("shingles_b"))
        ]
        yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))


def _set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [shingles.shingle_set(w) for w in shingles.word_groups(batch.column("text"))]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([shingles.digest_of(s) for s in sets], pa.binary()),
                pa.array([s.tobytes() for s in sets], pa.binary()),
            ],
            ["digest", "shingles"],
        )


def _with_both(pairs: DataFrame, side: DataFrame, *values: str) -> DataFrame:
    """Pairs (a, b) with the values of both ends, as <value>_a and <value>_b."""
    for end in ("a", "b"):
        named = [F.col(v).alias(f"{v}_{end}") for v in values]
        pairs = pairs.join(side.select(F.col("node").alias(end), *named), end)
    return pairs


def _sets(docs: DataFrame, nodes: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, shingles) of the wanted nodes, dealt by node.

    Texts are read again for them alone: the ids of their documents are broadcast if they are
    few, else joined; so are the names of the nodes, which spares a shuffle of the sets.
    """
    known = settle(nodes.join(wanted, "node").select("node", "digest", "least_id"))
    ids = small_side(settle(known.select(F.col("least_id").alias("_wanted")).distinct()))
    names = broadcast_bytes(known.select("node", "digest"), F.octet_length("digest") + 8)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    texts = texts.join(ids, F.col("doc_id").eqNullSafe(F.col("_wanted")), "left_semi")
    return (
        texts.select("text")
        .mapInArrow(_set_rows, "digest binary, shingles binary")
        .join(names, "digest")
        .groupBy("node")
        .agg(F.first("shingles").alias("shingles"))
    )


def _links(docs: DataFrame, nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """The candidate pairs (a, b) that are links, settled."""
    both = _with_both(pairs.select("a", "b").distinct(), nodes, "n", "bitmap")
    near = settle(both.mapInArrow(_within, "a long, b long"))
    if near.isEmpty():
        return near
    ends = near.select(F.col("a").alias("node")).union(near.select("b")).distinct()
    both = _with_both(near, settle(_sets(docs, nodes, ends)), "shingles")
    return settle(both.mapInArrow(_confirm, "a long, b long"))


def _between(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """The edges (a, b), a < b, between the labels of their ends, those within a label left out."""
    for end, other in ("ab", "ba"):
        at = labels.select(F.col("node").alias(end), F.col("label").alias("root"))
        edges = edges.join(at, end, "left").select(F.coalesce("root", end).alias(end), other)
    ends = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return ends.where("a < b").distinct()


def components(links: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """(node, label) of every linked node but the smallest of each component, its label.

    Every node takes the smallest smaller neighbour as its parent; parents of parents, doubled
    until they stand, lead to roots. Links are then drawn between roots, and what is left, far
    fewer, is treated alike until no link remains. With ``labels``, the result for earlier links,
    only the components that these left are joined by the further ones.
    """
    if labels is None:
        ends = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        edges = settle(ends.where("a < b").distinct())
    else:
        edges = settle(_between(links, labels))
    while labels is None or not edges.isEmpty():
        tree = edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("label"))
        tree = settle(tree)
        while True:
            above = tree.select(F.col("node").alias("label"), F.col("label").alias("top"))
            jumped = settle(
                tree.join(above, "label", "left").select(
                    "node", F.coalesce("top", "label").alias("label"), F.col("top").alias("moved")
                )
            )
            tree = jumped.select("node", "label")
            if jumped.where("moved is not null").isEmpty():
                break
        if labels is None:
            labels = tree
        else:
            roots = tree.select(F.col("node").alias("label"), F.col("label").alias("root"))
            followed = labels.join(roots, "label", "left").select(
                "node", F.coalesce("root", "label").alias("label")
            )
            labels = settle(followed.union(tree))
        edges = settle(_between(edges, tree))
    return labels


def _leader_pairs(groups: DataFrame) -> DataFrame:
    """(a, b): the leaders of each key with its other nodes, as far as they fit each other.

    One leader is the node of the smallest set, or the smallest node where sizes are not given:
    sets that share a passage and little else fit this one if they fit any. LEADERS more are
    those with the least hash of node and a salt; the salts follow from the key and are few, so
    keys of the same nodes repeat the same pairs, while one large group is met by many leaders.
    """
    at_key = Window.partitionBy("key")
    row = F.struct("node", "n", "fits")
    heads = [F.min_by(row, F.struct("n", "node")).over(at_key)]
    for turn in range(LEADERS):
        salt = F.pmod(F.col("key") + turn, F.lit(SALTS))
        heads.append(F.min_by(row, F.xxhash64(salt, "node")).over(at_key))
    led = groups.select("node", "n", "fits", F.array_distinct(F.array(*heads)).alias("heads"))
    pairs = led.select("node", "n", "fits", F.explode("heads").alias("lead"))
    pairs = pairs.where("node <> lead.node").where(
        F.coalesce(F.expr("n <= lead.fits and lead.n <= fits"), F.lit(True))
    )
    return pairs.select(
        F.least("lead.node", "node").alias("a"), F.greatest("lead.node", "node").alias("b")
    )


def _parts(rows: DataFrame, by: str, weight: Column) -> DataFrame:
    """(by, main, inner, outer, size) of groups that span several components.

    ``main`` is the label of the largest component, ``inner`` and ``outer`` are the numbers of
    blocks that its nodes and all others fill, by a weight of at most BLOCK_SHINGLES a block.
    """
    held = rows.groupBy(by, "label").agg(
        F.sum(weight).alias("held"), F.count("*").alias("size")
    )
    groups = held.groupBy(by).agg(
        F.max(F.struct("held", "label")).alias("top"),
        F.sum("held").alias("held"),
        F.sum("size").alias("size"),
        F.count("*").alias("labels"),
    )
    blocks = lambda total: F.ceil(total / BLOCK_SHINGLES).cast("int")
    return groups.where("labels > 1").select(
        by,
        F.col("top.label").alias("main"),
        blocks(F.col("top.held")).alias("inner"),
        blocks(F.col("held") - F.col("top.held")).alias("outer"),
        "size",
    )


def _in_blocks(rows: DataFrame, by: str, parts: DataFrame) -> DataFrame:
    """``rows`` with (block, own): the nodes of a group in pairs of blocks.

    The nodes outside a group's main component are dealt into blocks 0 to outer - 1, the others
    into the ``inner`` blocks behind; blocks i and j meet in the pair (i, j), so a task never
    holds more than about two. Nodes of the main component need not meet each other: they are
    copied to the outer blocks only, and where those outside are few, a node is copied to one
    pair if it is inside and once a block if not, twice the size of the group in all.
    """
    dealt = rows.join(parts.drop("size"), by)
    inside, at = F.col("label") == F.col("main"), F.xxhash64("node")
    own = F.when(inside, F.col("outer") + F.pmod(at, F.col("inner")))
    dealt = dealt.withColumn("own", own.otherwise(F.pmod(at, F.col("outer"))).cast("int"))
    met = F.col("outer") + F.when(inside, 0).otherwise(F.col("inner"))
    block = F.transform(
        F.sequence(F.lit(0), met - 1),
        lambda o: F.least("own", o).cast("long") * F.lit(1 << 20) + F.greatest("own", o),
    )
    return dealt.withColumn("block", F.explode(block)).drop("main", "inner", "outer")


def _open_links(
    docs: DataFrame, groups: DataFrame, labels: DataFrame, nodes: DataFrame
) -> DataFrame:
    """Links (a, b) that join what the links so far left in different components; settled.

    First, nodes of a key in different components that bitmaps let pass are gathered to sets,
    a row for each member; equal sets of several keys are one. Then every set is
    confirmed on whole shingle sets, and gives a spanning forest of its links only: both steps
    return no more rows than they read, however many links a group has.
    """
    labelled = F.coalesce("label", "node").alias("label")
    fits = F.coalesce("fits", F.lit(1 << 62)).alias("fits")
    placed = groups.join(labels, "node", "left").select("key", "node", labelled, fits)
    torn = _parts(placed, "key", F.lit(BLOCK_SHINGLES // BLOCK))
    torn = torn.where("size > 2")  # of two nodes, one is a leader
    met = _in_blocks(placed, "key", torn).join(nodes.select("node", "n", "bitmap"), "node")
    found = met.groupBy("key", "block").applyInArrow(_gather, "gathered long, node long")
    members = settle(found.distinct())
    if members.isEmpty():
        return members.select(F.col("gathered").alias("a"), F.col("node").alias("b"))
    sized = members.join(nodes.select("node", "n"), "node").join(labels, "node", "left")
    sized = sized.select("gathered", "node", labelled, "n")
    weight = F.greatest(F.lit(BLOCK_SHINGLES // BLOCK), "n")
    sets = _sets(docs, nodes, members.select("node").distinct())
    met = _in_blocks(sized.drop("n"), "gathered", _parts(sized, "gathered", weight))
    met = met.join(sets, "node")
    return settle(met.groupBy("gathered", "block").applyInArrow(_span, "a long, b long").distinct())


def _met_in(group: pa.Table) -> tuple[np.ndarray, bool]:
    """The blocks of a group's nodes, and whether the group is one block with itself."""
    block = group.column("block")[0].as_py()
    return group.column("own").to_numpy(), block >> 20 == block & ((1 << 20) - 1)


def _gather(group: pa.Table) -> pa.Table:
    """(gathered, node): nodes tied by pairs of different components that sizes, ``fits`` where
    given, and bitmaps do not rule out; tied nodes have the digest of their set in common."""
    nodes, labels, n = (group.column(c).to_numpy() for c in ("node", "label", "n"))
    own, same_block = _met_in(group)
    fits = group.column("fits").to_numpy() if "fits" in group.column_names else None
    bitmaps = _bitmaps(group.column("bitmap").combine_chunks())
    tied = np.arange(len(nodes))
    for k in range(len(nodes) - 1):
        rest = slice(k + 1, None)
        open_pair = (labels[rest] != labels[k]) & (tied[rest] != tied[k])
        if not same_block:
            open_pair &= own[rest] != own[k]
        if fits is not None:
            open_pair &= (n[rest] <= fits[k]) & (n[k] <= fits[rest])
        at = np.flatnonzero(open_pair) + k + 1
        differ = np.bitwise_count(bitmaps[at] ^ bitmaps[k]).sum(axis=1, dtype=np.int64)
        at = at[differ <= most_differing(n[at] + n[k])]
        if len(at):
            tied[np.isin(tied, tied[at])] = tied[k]
    which, size = np.unique(tied, return_counts=True)
    names, members = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for one in which[size > 1]:
        inside = np.sort(nodes[tied == one])
        name = hashlib.blake2b(inside.tobytes(), digest_size=8).digest()
        names.append(np.repeat(np.frombuffer(name, np.int64), len(inside)))
        members.append(inside)
    return pa.table({"gathered": np.concatenate(names), "node": np.concatenate(members)})


def _span(group: pa.Table) -> pa.Table:
    """A spanning forest of the links of one group between different components."""
    nodes = group.column("node").to_numpy()
    labels = group.column("label").to_numpy().copy()
    own, same_block = _met_in(group)
    sets = [np.frombuffer(s.as_buffer(), _U64) for s in group.column("shingles")]
    n = np.array([len(s) for s in sets], np.int64)
    bitmaps = np.frombuffer(b"".join(map(bitmap_of, sets)), np.uint64).reshape(len(sets), -1)
    a, b = [], []
    for k in range(len(nodes) - 1):
        rest = slice(k + 1, None)
        open_pair = labels[rest] != labels[k]
        if not same_block:
            open_pair &= own[rest] != own[k]
        at = np.flatnonzero(open_pair) + k + 1
        differ = np.bitwise_count(bitmaps[at] ^ bitmaps[k]).sum(axis=1, dtype=np.int64)
        for other in at[differ <= most_differing(n[at] + n[k])]:
            if labels[other] != labels[k] and similar(sets[k], sets[other]):
                labels[labels == labels[other]] = labels[k]
                a.append(min(nodes[k], nodes[other]))
                b.append(max(nodes[k], nodes[other]))
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def near_groups(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id, kept."""
    found = signed(docs)
    nodes = _nodes(found)
    shared = _shared_keys(nodes)
    groups = (
        shared.where(F.col("size") <= CROWD)
        .select("key", "node", *(F.lit(None).cast("long").alias(c) for c in ("n", "fits")))
        .union(_rare_keys(docs, nodes, shared))
    )
    links = _links(docs, nodes, _leader_pairs(groups))
    labels = components(links)
    rest = _open_links(docs, groups, labels, nodes)
    if not rest.isEmpty():
        labels = components(rest, labels)
    named = nodes.join(labels, "node", "left").select(
        "digest", "least_id", F.coalesce("label", "node").alias("label")
    )
    least = named.groupBy("label").agg(F.min("least_id").alias("component_id"))
    classes = settle(named.join(least, "label").select("digest", "component_id"))
    return found.join(classes, "digest", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("digest").isNull(), F.col("doc_id"))
        .otherwise(F.col("component_id"))
        .alias("component_id"),
        F.coalesce(
            F.col("doc_id") == F.col("component_id"), F.col("digest").isNull()
        ).alias("kept"),
    )


def representatives(docs: DataFrame) -> DataFrame:
    """``docs`` with all its columns, one document of each group; texts are not shuffled
    unless the dropped ids are too many to broadcast."""
    groups = near_groups(docs)
    gone = groups.where("not kept and doc_id is not null")
    (name,) = free_names(docs, "__gone")
    dropped = small_side(settle(gone.select(F.col("doc_id").alias(name)).distinct()))
    mine = docs["doc_id"].cast("long") == F.col(name)
    return docs.join(dropped, mine, "left_anti")
