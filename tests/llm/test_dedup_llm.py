"""Exact and near deduplication against brute force."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from fallscan.llm import exact_dedup as ex
from fallscan.llm import near_dedup as nd

SCHEMA = "doc_id long, text string, digest string, bucket int, kept string"  # clashing names


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, "y") for i, t in rows], SCHEMA)


def lower(text):
    return text.translate({c: c + 32 for c in range(65, 91)})


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text or ""))
    return frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()


def brute_components(rows):
    sets, root = {i: shingles(t) for i, t in rows}, {i: i for i, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in ids}


def test_filter_inserts_deletes_and_resizes():
    bucket = ex.DigestBucket()
    keys = [hashlib.sha256(str(k).encode()).digest() for k in range(2000)]
    for k, key in enumerate(keys):
        bucket.insert(key, k, k, 1, 1)
    assert bucket.resizes and all(key in bucket for key in keys)
    bucket.insert(keys[5], 1, 9, 2, 1)  # a verified hit: smaller id, more copies
    assert bucket.content[keys[5]] == [1, 9, 3, 1] and bucket.verified == 1
    assert all(bucket.delete(key) for key in keys[:1000]) and not bucket.delete(keys[0])
    assert not any(key in bucket for key in keys[:1000])
    assert all(key in bucket for key in keys[1000:])


ROWS = [
    (5, "a  b\tc"), (3, "a b c"), (9, "a b\nc"), (4, None), (7, ""), (8, " "), (None, "a b c"),
    (6, "long " * 30_000), (2, "tie"), (2, "tie"), (1, "tie"), (1, "tie"), (10, "A b c"),
]


def test_exact_groups(spark):
    found = ex.exact_groups(frame(spark, ROWS)).collect()
    groups = {}
    for i, t in ROWS:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), []).append(i)
    for text, ids in groups.items():
        digest = hashlib.sha256(text.encode()).hexdigest()
        rows = [r for r in found if r.text_sha256 == digest]
        least = min(i for i in ids if i is not None)
        assert len(rows) == len(ids) and {r.group_size for r in rows} == {len(ids)}
        assert {r.keep_id for r in rows} == {least}
        assert [r.doc_id for r in rows if r.kept] == [least]
    assert ex.exact_groups(frame(spark, [])).isEmpty()


def test_unique_keeps_columns_and_one_of_each(spark):
    docs = frame(spark, ROWS)
    kept = ex.unique(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 4, 6, 8, 10]


def test_index_grows_and_shrinks(spark):
    first = ex.digests(frame(spark, [(1, "a"), (2, "b")]))
    n = ex.bucket_count(first)
    index = ex.build_index(first, n)
    index = ex.insert(index, ex.digests(frame(spark, [(0, "a"), (3, "c")])), n)
    ids = lambda ix: sorted((r.keep_id, r.copies) for r in ex.entries(ix).collect())
    assert ids(index) == [(0, 2), (2, 1), (3, 1)]
    index = ex.delete(index, ex.digests(frame(spark, [(7, "a"), (8, "unknown")])), n)
    assert ids(index) == [(2, 1), (3, 1)]


def near_rows(rng):
    word = lambda: "".join(rng.choice("abcdefg") for _ in range(5))
    passage = [word() for _ in range(60)]
    rows, n = [], 0
    for g in range(8):
        base = [word() for _ in range(rng.choice([12, 80, 200]))]
        for _ in range(rng.choice([1, 3, 9])):
            text = list(base)
            for _ in range(rng.choice([0, 1, 2, 5])):
                text[rng.randrange(len(text))] = word()
            rows.append((n := n + 1, " ".join(text).upper() if g == 0 else " ".join(text)))
    # a crowd around one passage, some of it close, most of it not
    for _ in range(150):
        own = [word() for _ in range(rng.choice([2, 10, 14, 18, 25, 60]))]
        rows.append((n := n + 1, " ".join(passage + own)))
    rows += [(1000, None), (1001, ""), (1002, "two words"), (1003, "Two  words"), (1004, "five words are one set")]
    return rows


def test_near_groups_equal_brute_force(spark):
    rows = near_rows(random.Random(4))
    expected = brute_components(rows)
    for crowd in (nd.CROWD, 8):  # the second sends the crowd through the exact prefix join
        before, nd.CROWD = nd.CROWD, crowd
        try:
            found = {r.doc_id: r for r in nd.near_groups(frame(spark, rows)).collect()}
        finally:
            nd.CROWD = before
        assert {i: r.component_id for i, r in found.items()} == expected
        assert all(found[i].n_shingles == len(shingles(t)) for i, t in rows)
        assert all(r.kept == (r.doc_id == r.component_id) for r in found.values())


def group_of(sets, labels, own, block):
    n = len(sets)
    held = {
        "block": [block] * n, "own": own, "node": list(range(n)), "label": labels,
        "n": [len(s) for s in sets], "bitmap": [nd.bitmap_of(s) for s in sets],
        "shingles": [s.tobytes() for s in sets],
    }
    return pa.table(held)


@pytest.mark.parametrize("block", [0, 1])
def test_a_block_returns_a_spanning_forest(block):
    rng = np.random.default_rng(7)
    base = [np.unique(rng.integers(0, 2**63, 60, np.uint64)) for _ in range(3)]
    sets = [np.unique(np.append(base[k % 3][k % 7 :], rng.integers(0, 2**63, k % 5, np.uint64))) for k in range(40)]
    labels = [k - k % 2 if k < 8 else k for k in range(40)]
    own = [k // 3 % 2 for k in range(40)]
    group = group_of(sets, labels, own, block)
    root = dict(enumerate(labels))  # brute force over all pairs that the block compares

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(40):
        for k in range(i):
            common = len(np.intersect1d(sets[i], sets[k]))
            if 100 * common >= 75 * (len(sets[i]) + len(sets[k]) - common) and (not block or own[i] != own[k]):
                root[find(i)] = find(k)
    expected = {frozenset(i for i in range(40) if find(i) == r) for r in map(find, range(40))}
    links = nd._span(group).to_pylist()
    root = dict(enumerate(labels))
    for row in links:
        assert row["a"] < row["b"] and find(row["a"]) != find(row["b"])  # a forest
        root[find(row["a"])] = find(row["b"])
    assert {frozenset(i for i in range(40) if find(i) == r) for r in map(find, range(40))} == expected
    gathered = nd._gather(group).to_pylist()
    assert len(gathered) <= 40
    where = {row["node"]: row["gathered"] for row in gathered}
    assert all(where[row["a"]] == where[row["b"]] for row in links)


def test_a_block_without_links():
    far = [np.arange(k * 100, k * 100 + 50, dtype=np.uint64) * np.uint64(2654435761) for k in range(3)]
    group = group_of(far, [0, 1, 2], [0, 0, 0], 0)
    assert nd._span(group).num_rows == 0 and nd._gather(group).num_rows == 0


@pytest.mark.parametrize("seed", [4, 5])
def test_crowds_in_small_blocks_make_few_rows(spark, monkeypatch, seed):
    rows, made = near_rows(random.Random(seed)), []
    real = nd._in_blocks

    def counted(held, by, parts):
        blocks = real(held, by, parts)
        made.append((blocks.count(), held.join(parts.select(by).distinct(), by, "left_semi").count()))
        return blocks

    monkeypatch.setattr(nd, "CROWD", 8)
    monkeypatch.setattr(nd, "BLOCK", 16)
    monkeypatch.setattr(nd, "BLOCK_SHINGLES", 1 << 12)
    monkeypatch.setattr(nd, "_in_blocks", counted)
    found = {r.doc_id: r.component_id for r in nd.near_groups(frame(spark, rows)).collect()}
    assert found == brute_components(rows)
    assert made and all(copies <= 3 * size for copies, size in made)


def test_all_components_of_a_group_meet(spark, monkeypatch):
    monkeypatch.setattr(nd, "BLOCK", 16)
    monkeypatch.setattr(nd, "BLOCK_SHINGLES", 1 << 12)
    label = {k: k if k < 40 else 1000 for k in range(400)} | {k: 2000 for k in range(400, 410)}
    rows = [(7, k, v) for k, v in label.items()] + [(8, k, 5) for k in range(50)]
    held = spark.createDataFrame(rows, "key long, node long, label long")
    met = nd._in_blocks(held, "key", nd._parts(held, "key", nd.F.lit(256))).collect()
    assert {r.key for r in met} == {7}  # the other is one component
    blocks = {}
    for r in met:
        blocks.setdefault(r.block, []).append((r.node, r.own))
    pairs = {(a, b) for held in blocks.values() for a, _ in held for b, _ in held}
    assert all((a, b) in pairs for a in label for b in label if label[a] != label[b])
    assert max(map(len, blocks.values())) < 80  # about two blocks of 16
    assert sum(1 for r in met if r.label == 1000) <= 4 * 360  # a copy for each block outside


def test_components_grow_by_further_links(spark):
    links = [(k, k + 1) for k in range(0, 40, 2)]
    rest = [(k + 1, k + 2) for k in range(10, 30, 2)] + [(3, 100), (100, 7), (200, 201)]
    make = lambda pairs: spark.createDataFrame(pairs, "a long, b long")
    for first, then in ((links, rest), (rest, links)):
        grown = nd.components(make(then), nd.components(make(first)))
        assert sorted(grown.collect()) == sorted(nd.components(make(links + rest)).collect())


def test_near_defined_cases(spark):
    rows = [(None, "one two three four five six"), (4, "one two three four five six"), (4, "one two three four five six"), (5, None)]
    found = nd.near_groups(frame(spark, rows)).collect()
    assert sorted((r.doc_id or -1, r.component_id) for r in found) == [(-1, 4), (4, 4), (4, 4), (5, 5)]
    assert nd.near_groups(frame(spark, [])).isEmpty()
    docs = frame(spark, [(1, "a b c d e f"), (2, "A b c d e f"), (3, "other")])
    kept = nd.representatives(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 3]


@pytest.mark.parametrize("n", [2, 70])
def test_components_of_chains_and_stars(spark, n):
    links = [(k, k + 1) for k in range(n)] + [(1000 + k, 2000) for k in range(20)]
    found = dict(nd.components(spark.createDataFrame(links, "a long, b long")).collect())
    assert found == {k: 0 for k in range(1, n + 1)} | {k: 1000 for k in [*range(1001, 1020), 2000]}
