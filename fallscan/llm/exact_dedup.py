"""Exact deduplication over a distributed cuckoo-filter index.

The index is partitioned into hash buckets by digest. A bucket holds the live digests with
the row that stays for each (its *content*) and a cuckoo filter over them (Fan, Andersen,
Kaminsky, Mitzenmacher: Cuckoo Filter, CoNEXT 2014). A digest that the filter does not know
is new; a hit is verified against the content, so false positives cost a look-up and never a
document. A filter that overflows is rebuilt at twice its size from the stored keys. Deleting
a live digest takes its fingerprint out again.

Scale: digests are combined per Arrow batch before the shuffle, so a text that fills a third
of the corpus arrives as a row per batch; the number of buckets grows with the corpus, and the
documents meet the index in a plain equi-join that adaptive execution can split.

Defined cases: null text counts as empty, empty texts are equal to each other; null doc_id
sorts last; of rows that repeat doc_id and text exactly one is kept; an empty table gives an
empty result; further columns are ignored by the index and passed through by ``unique``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from fallscan.llm.common import SPACE, free_names, parts_for, settle, small_side

#: Rows of the index that one bucket is sized for.
BUCKET_ROWS = 20_000

_SLOTS = 4
_MAX_KICKS = 250
_FIRST_BUCKETS = 64

INDEX_SCHEMA = (
    "bucket int, digest binary, keep_id long, keep_row long, copies long, same_rows long, "
    "filter binary"
)


class CuckooFilter:
    """Sixteen-bit fingerprints in buckets of four slots; 0 marks a free slot."""

    def __init__(self, buckets: int = _FIRST_BUCKETS, table: bytes | None = None):
        self.mask = buckets - 1  # a power of two
        self.table = (
            np.zeros((buckets, _SLOTS), np.uint16)
            if table is None
            else np.frombuffer(table, np.uint16).reshape(-1, _SLOTS).copy()
        )
        self.turn = 0

    def _places(self, digest: bytes) -> tuple[int, int, int]:
        mark = int.from_bytes(digest[8:10], "little") or 1
        first = int.from_bytes(digest[10:16], "little") & self.mask
        return mark, first, self._other(first, mark)

    def _other(self, place: int, mark: int) -> int:
        return place ^ ((mark * 0x5BD1E995 >> 7) & self.mask)

    def __contains__(self, digest: bytes) -> bool:
        mark, first, second = self._places(digest)
        return bool((self.table[first] == mark).any() or (self.table[second] == mark).any())

    def insert(self, digest: bytes) -> bool:
        """False if the filter overflows; it is then to be rebuilt from the stored keys."""
        mark, first, second = self._places(digest)
        for place in (first, second):
            free = np.flatnonzero(self.table[place] == 0)
            if free.size:
                self.table[place, free[0]] = mark
                return True
        place = second
        for _ in range(_MAX_KICKS):
            self.turn = (self.turn + 1) % _SLOTS
            mark, self.table[place, self.turn] = int(self.table[place, self.turn]), mark
            place = self._other(place, mark)
            free = np.flatnonzero(self.table[place] == 0)
            if free.size:
                self.table[place, free[0]] = mark
                return True
        return False

    def delete(self, digest: bytes) -> None:
        """Free one slot with the digest's fingerprint; the digest must be live."""
        mark, first, second = self._places(digest)
        for place in (first, second):
            found = np.flatnonzero(self.table[place] == mark)
            if found.size:
                self.table[place, found[0]] = 0
                return

    def to_bytes(self) -> bytes:
        return self.table.tobytes()


def _order(keep_id: int | None, keep_row: int) -> tuple:
    return (keep_id is None, keep_id or 0, keep_row)


class DigestBucket:
    """One bucket of the index: filter and content, kept in step."""

    def __init__(self, table: bytes | None = None):
        buckets = _FIRST_BUCKETS if table is None else len(table) // (2 * _SLOTS)
        self.filter = CuckooFilter(buckets, table)
        self.content: dict[bytes, list] = {}  # digest -> [keep_id, keep_row, copies, same_rows]
        self.verified = self.false_hits = self.resizes = 0

    def load(self, digest: bytes, entry: list) -> None:
        """A stored key that the loaded filter already covers."""
        self.content[digest] = entry

    def __contains__(self, digest: bytes) -> bool:
        return digest in self.filter and digest in self.content

    def insert(self, digest: bytes, keep_id, keep_row: int, copies: int, same_rows: int) -> None:
        if digest in self.filter:
            held = self.content.get(digest)
            if held is not None:
                self.verified += 1
                held[2] += copies
                if held[0] == keep_id:
                    held[3] += same_rows
                    held[1] = min(held[1], keep_row)
                elif _order(keep_id, keep_row) < _order(held[0], held[1]):
                    held[0], held[1], held[3] = keep_id, keep_row, same_rows
                return
            self.false_hits += 1
        self.content[digest] = [keep_id, keep_row, copies, same_rows]
        if not self.filter.insert(digest):
            self.resize()

    def delete(self, digest: bytes) -> bool:
        """Forget a live digest; False if it is not live."""
        if digest not in self:
            return False
        del self.content[digest]
        self.filter.delete(digest)
        return True

    def resize(self) -> None:
        buckets = self.filter.mask + 1
        while True:
            buckets *= 2
            self.resizes += 1
            self.filter = CuckooFilter(buckets)
            if all(self.filter.insert(key) for key in self.content):
                return

    def rows(self, bucket: int) -> pd.DataFrame:
        """A row for each live digest, then one with the filter."""
        rows = [(bucket, key, *entry, None) for key, entry in self.content.items()]
        rows.append((bucket, None, None, None, None, None, self.filter.to_bytes()))
        names = [field.split()[0] for field in INDEX_SCHEMA.split(", ")]
        frame = pd.DataFrame(rows, columns=names)
        whole = ["keep_id", "keep_row", "copies", "same_rows"]
        return frame.astype({name: "Int64" for name in whole})


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, row_no, digest) of every document, settled: the texts are read once.

    ``row_no`` tells rows apart; it is fixed once the result is settled.
    """
    return settle(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.monotonically_increasing_id().alias("row_no"),
            F.unhex(F.sha2(normalised("text"), 256)).alias("digest"),
        )
    )


def normalised(column: str):
    """The text with each run of white space as one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(F.col(column), F.lit("")), SPACE, " ")


def _combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per digest and batch: the first row by (doc_id, row_no) and counts."""
    for batch in batches:
        if not batch.num_rows:
            continue
        order = pc.sort_indices(
            batch, [(name, "ascending") for name in ("digest", "doc_id", "row_no")]
        )  # nulls last
        rows = batch.take(order)
        digest = rows.column("digest")
        new = np.ones(len(digest), bool)
        new[1:] = pc.not_equal(digest[1:], digest[:-1]).to_numpy(zero_copy_only=False)
        starts = np.flatnonzero(new)
        copies = np.diff(np.append(starts, len(digest)))
        ids = rows.column("doc_id")
        values = pc.fill_null(ids, 0).to_numpy()
        nulls = ids.is_null().to_numpy(zero_copy_only=False)
        first = np.repeat(starts, copies)
        same = (values == values[first]) & (nulls == nulls[first])
        best = rows.take(pa.array(starts))
        yield pa.RecordBatch.from_arrays(
            [
                *(best.column(name) for name in ("digest", "doc_id", "row_no")),
                pa.array(np.add.reduceat(same.astype(np.int64), starts)),
                pa.array(copies.astype(np.int64)),
            ],
            ["digest", "doc_id", "row_no", "same_rows", "copies"],
        )


_COMBINED = "digest binary, doc_id long, row_no long, same_rows long, copies long"


def _bucket_of(n_buckets: int):
    head = F.conv(F.hex(F.substring("digest", 1, 6)), 16, 10).cast("long")
    return (head % n_buckets).cast("int").alias("bucket")


def _arrivals(found: DataFrame, n_buckets: int) -> DataFrame:
    return found.mapInArrow(_combine, _COMBINED).select(_bucket_of(n_buckets), "*")


def _fill(key, arrived):
    bucket = DigestBucket()
    _insert_all(bucket, arrived)
    return bucket.rows(int(key[0]))


def _insert_all(bucket: DigestBucket, arrived: pd.DataFrame) -> None:
    ids = arrived["doc_id"].astype("Int64")
    for digest, doc_id, row_no, same_rows, copies in zip(
        arrived["digest"], ids, arrived["row_no"], arrived["same_rows"], arrived["copies"]
    ):
        keep = None if doc_id is pd.NA else int(doc_id)
        bucket.insert(bytes(digest), keep, int(row_no), int(copies), int(same_rows))


def bucket_count(found: DataFrame) -> int:
    """Buckets of an index over settled digests; to be kept with the index."""
    return 4 * parts_for(found.sparkSession, found.count(), BUCKET_ROWS)


def build_index(found: DataFrame, n_buckets: int) -> DataFrame:
    """The index over ``digests(docs)``, settled: see INDEX_SCHEMA.

    Each bucket's rows reach one task together; their number is bounded by BUCKET_ROWS in the
    mean plus a row per batch for a digest that repeats.
    """
    filled = _arrivals(found, n_buckets).groupBy("bucket").applyInPandas(_fill, INDEX_SCHEMA)
    return settle(filled)


def _restore(stored: pd.DataFrame) -> DigestBucket:
    tables = [bytes(t) for t in stored["filter"] if t is not None]
    bucket = DigestBucket(tables[0] if tables else None)
    content = stored[stored["digest"].notnull()]
    ids = content["keep_id"].astype("Int64")
    for digest, keep, row, copies, same in zip(
        content["digest"], ids, content["keep_row"], content["copies"], content["same_rows"]
    ):
        entry = [None if keep is pd.NA else int(keep), int(row), int(copies), int(same)]
        bucket.load(bytes(digest), entry)
    return bucket


def insert(index: DataFrame, found: DataFrame, n_buckets: int) -> DataFrame:
    """The index after further documents; ``n_buckets`` is that of the index."""

    def update(key, stored, arrived):
        bucket = _restore(stored)
        _insert_all(bucket, arrived)
        return bucket.rows(int(key[0]))

    arrivals = _arrivals(found, n_buckets)
    grouped = index.groupBy("bucket").cogroup(arrivals.groupBy("bucket"))
    return settle(grouped.applyInPandas(update, INDEX_SCHEMA))


def delete(index: DataFrame, removed: DataFrame, n_buckets: int) -> DataFrame:
    """The index without the digests of ``removed`` (column ``digest``); unknown ones are ignored."""

    def update(key, stored, gone):
        bucket = _restore(stored)
        for digest in gone["digest"]:
            bucket.delete(bytes(digest))
        return bucket.rows(int(key[0]))

    keys = removed.select("digest").distinct().select(_bucket_of(n_buckets), "digest")
    grouped = index.groupBy("bucket").cogroup(keys.groupBy("bucket"))
    return settle(grouped.applyInPandas(update, INDEX_SCHEMA))


def entries(index: DataFrame) -> DataFrame:
    """The live digests of an index."""
    return index.where("digest is not null").drop("filter", "bucket")


def exact_groups(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, keep_id, group_size, kept, text_sha256."""
    found = digests(docs)
    live = entries(build_index(found, bucket_count(found)))
    return found.join(live, "digest").select(
        "doc_id",
        "keep_id",
        F.col("copies").alias("group_size"),
        (F.col("row_no") == F.col("keep_row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def unique(docs: DataFrame) -> DataFrame:
    """``docs`` with all its columns, without later rows of equal texts.

    The texts are not shuffled unless the dropped rows are too many to broadcast.
    """
    digest, gone_id, gone_digest, twice_id, twice_digest = free_names(
        docs, "__digest", "__gone_id", "__gone_digest", "__twice_id", "__twice_digest"
    )
    found = digests(docs)
    live = entries(build_index(found, bucket_count(found)))
    dropped = settle(
        found.join(live, "digest")
        .where("not (doc_id <=> keep_id)")
        .select(F.col("doc_id").alias(gone_id), F.col("digest").alias(gone_digest))
        .distinct()
    )
    marked = docs.withColumn(digest, F.unhex(F.sha2(normalised("text"), 256)))
    mine = docs["doc_id"].cast("long").eqNullSafe(F.col(gone_id))
    kept = marked.join(
        small_side(dropped), mine & (F.col(digest) == F.col(gone_digest)), "left_anti"
    )
    if live.where("same_rows > 1").isEmpty():
        return kept.drop(digest)
    # Rows that repeat doc_id and text: one of them stays.
    repeated = settle(
        live.where("same_rows > 1").select(
            F.col("digest").alias(twice_digest), F.col("keep_id").alias(twice_id)
        )
    )
    twice = (F.col(digest) == F.col(twice_digest)) & F.col("doc_id").cast(
        "long"
    ).eqNullSafe(F.col(twice_id))
    once = kept.join(small_side(repeated), twice, "left_anti")
    several = kept.join(small_side(repeated), twice, "left_semi").dropDuplicates(
        ["doc_id", digest]
    )
    return once.unionByName(several).drop(digest)
