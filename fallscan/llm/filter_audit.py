"""How document filters interact: what each removes in every order, and its fair share.

Five filters are players of a removal game: a coalition of filters is worth the number of
documents that at least one of its members fails. The game's potential (Hart, Mas-Colell:
Potential, Value, and Consistency, Econometrica 1989) is computed recursively over all 32
coalitions, P(S) = (v(S) + sum of P(S without i) over i in S) / |S|. The Shapley value of a filter
is the potential of all filters minus the potential without it; what a filter removes at its step
of an order is the difference between the coalition up to it and the one before it.

Potentials are kept as whole numbers Q(S) = |S|! P(S), so Q(S) = (|S| - 1)! v(S) + sum of
Q(S without i). The sum of what a filter removes over all 120 orders is 120 times its Shapley
value: Q(all) - 5 Q(all without it).

Filters (a document fails if): A under 200 words, B fewer distinct words than half its words,
C capitals above two in a hundred code points, D any of ``#$%&*|``, E a text that a smaller doc_id
has as well, anywhere in the table.

Scale: a document becomes a mask of five bits and a digest; documents are then counted by part and
mask, so only 32 counts per part move. Whether a text occurs with a smaller doc_id follows from the
smallest id per digest, aggregated on the map side and joined by (doc_id, digest): a text that fills
a third of the table is one row there, and the join's key is as good as unique.

Defined cases: a null text counts as empty (it fails A only, and E if repeated), a null source as
the part ``""``; a document without doc_id never fails E and has no labels; rows that repeat a doc_id
count one by one, and repeats of one doc_id don't make each other fail E; of several labels of a
doc_id the largest counts; a very long text is read whole; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import itertools
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from fallscan.llm.common import settle

FILTERS = "ABCDE"
COALITIONS = 1 << len(FILTERS)
ORDERS = ["".join(order) for order in itertools.permutations(FILTERS)]

# Fixed values of the filters.
MIN_WORDS = 200
MIN_DISTINCT_PERCENT = 50
MAX_CAPITALS_PERCENT = 2
CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SYMBOLS = b"#$%&*|"

_CONTINUATION = bytes(range(0x80, 0xC0))  # all other bytes begin a code point
_REPEATED = 1 << FILTERS.index("E")

MEASURED = "doc_id long, part string, mask int, digest binary"


def failures(text: bytes) -> int:
    """Mask of the filters A to D that a text in UTF-8 fails."""
    words = text.split()  # of bytes: space and 0x09 to 0x0D part words, nothing else
    capitals = len(text) - len(text.translate(None, CAPITALS))
    points = len(text.translate(None, _CONTINUATION))
    return (
        (len(words) < MIN_WORDS)
        | (100 * len(set(words)) < MIN_DISTINCT_PERCENT * len(words)) << 1
        | (100 * capitals > MAX_CAPITALS_PERCENT * points) << 2
        | (len(text.translate(None, SYMBOLS)) < len(text)) << 3
    )


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("part"),
                pa.array([failures(t) for t in texts], pa.int32()),
                pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary()),
            ],
            ["doc_id", "part", "mask", "digest"],
        )


def masks(docs: DataFrame) -> DataFrame:
    """(doc_id, part, mask) of every document, with all five filters."""
    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        F.col("text").cast("string").alias("text"),
    )
    found = settle(narrow.mapInArrow(_measure, MEASURED))
    firsts = found.groupBy("digest").agg(F.min("doc_id").alias("first"))
    keyed = firsts.select(F.col("first").alias("doc_id"), "digest", F.lit(True).alias("is_first"))
    repeated = F.col("doc_id").isNotNull() & F.col("is_first").isNull()
    return found.join(keyed, ["doc_id", "digest"], "left").select(
        "doc_id",
        "part",
        F.col("mask").bitwiseOR(F.when(repeated, _REPEATED).otherwise(0)).alias("mask"),
    )


def counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents by the filters they fail, settled."""
    per_doc = (
        labels.where("doc_id is not null")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic"))
    )
    return settle(
        masks(docs)
        .join(per_doc, "doc_id", "left")
        .groupBy("part", "mask")
        .agg(
            F.count("*").alias("n"),
            F.count_if(F.col("quality") == 1).alias("good"),
            F.count_if(F.col("toxic") == 1).alias("toxic"),
        )
    )


def _worth(measure: str, coalition: int) -> Column:
    """What a coalition removes: documents that fail one of its filters."""
    fails = F.col("mask").bitwiseAND(F.lit(coalition)) != 0
    return F.sum(F.when(fails, F.col(measure)).otherwise(0))


def games(by_mask: DataFrame) -> DataFrame:
    """Per part: ``total``; the worths of all coalitions as arrays; per filter what fails it
    alone, and its share summed over all orders."""
    every = range(COALITIONS)
    worths = {
        name: F.array(*[_worth(measure, s) for s in every])
        for name, measure in (("removed", "n"), ("good", "good"), ("toxic", "toxic"))
    }
    alone = [
        F.sum(F.when(F.col("mask") == 1 << i, F.col("n")).otherwise(0))
        for i in range(len(FILTERS))
    ]
    game = by_mask.groupBy("part").agg(
        F.sum("n").alias("total"),
        *[worth.alias(name) for name, worth in worths.items()],
        F.array(*alone).alias("alone"),
    )
    game = game.withColumn("q0", F.lit(0).cast("long"))
    for size in range(1, len(FILTERS) + 1):  # potentials of one size need those of the size below
        layer = {}
        for s in every:
            if s.bit_count() == size:
                smaller = [F.col(f"q{s ^ 1 << i}") for i in range(len(FILTERS)) if s >> i & 1]
                layer[f"q{s}"] = math.factorial(size - 1) * F.get("removed", F.lit(s)) + sum(smaller)
        game = game.withColumns(layer)
    grand = COALITIONS - 1
    shares = [
        F.col(f"q{grand}") - len(FILTERS) * F.col(f"q{grand ^ 1 << i}") for i in range(len(FILTERS))
    ]
    return game.select("part", "total", "removed", "good", "toxic", "alone",
                       F.array(*shares).alias("shares"))


def _steps() -> Column:
    """All steps of all orders as one constant: the filter, and the coalitions around it."""
    rows = []
    for order in ORDERS:
        before = 0
        for step, letter in enumerate(order, 1):
            at = FILTERS.index(letter)
            after = before | 1 << at
            rows.append(f"struct('{order}', {step}, {at}, {1 << at}, {before}, {after})")
            before = after
    fields = "filter_order:string, step:int, at:int, own:int, before:int, after:int"
    return F.expr(f"cast(array({', '.join(rows)}) as array<struct<{fields}>>)")


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per part, order of filters and step: what the step keeps, removes and costs."""
    rows = games(counts(docs, labels)).withColumn("s", F.explode(_steps()))
    at = F.col("s.at")

    def lost(name: str) -> Column:
        return F.get(name, F.col("s.after")) - F.get(name, F.col("s.before"))

    return rows.select(
        "part",
        "s.filter_order",
        "s.step",
        (F.col("total") - F.get("removed", F.col("s.after"))).alias("kept"),
        lost("removed").alias("removed"),
        (F.get("removed", F.col("s.own")) - lost("removed")).alias("redundant"),
        F.get("alone", at).alias("unique_fails"),
        lost("good").alias("good_lost"),
        lost("toxic").alias("toxic_lost"),
        F.get("shares", at).alias("shapley"),
    )


ORACLE_SQL = r"""
WITH docs AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
worded AS (
    SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM docs),
failed AS (
    SELECT doc_id, part, len(w) < 200 AS a, 100 * list_unique(w) < 50 * len(w) AS b,
           100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text) AS c,
           regexp_matches(text, '[#$%&*|]') AS d,
           coalesce(min(doc_id) OVER (PARTITION BY text) < doc_id, false) AS e
    FROM worded),
labelled AS (
    SELECT f.*, coalesce(l.quality = 1, false) AS good, coalesce(l.toxic = 1, false) AS bad
    FROM failed f LEFT JOIN (
        SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY 1) l
      ON l.doc_id = f.doc_id),
classes AS (
    SELECT part, a, b, c, d, e, count(*) AS n, count(*) FILTER (good) AS good,
           count(*) FILTER (bad) AS bad
    FROM labelled GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
    SELECT p.x || q.x || r.x || s.x || t.x AS o
    FROM letters p, letters q, letters r, letters s, letters t
    WHERE len(list_distinct([p.x, q.x, r.x, s.x, t.x])) = 5),
steps AS (SELECT o, k::INTEGER AS k, o[k:k] AS x FROM orders, range(1, 6) AS g(k)),
played AS (
    SELECT part, o, n, good, bad,
           [CASE x WHEN 'A' THEN a WHEN 'B' THEN b WHEN 'C' THEN c WHEN 'D' THEN d ELSE e END
            FOR x IN string_split(o, '')] AS fails
    FROM classes, orders),
firsts AS (SELECT *, coalesce(list_position(fails, true), 0) AS f FROM played),
told AS (
    SELECT t.part, s.o AS filter_order, s.k AS step, s.x,
           coalesce(sum(n) FILTER (f = 0 OR f > s.k), 0) AS kept,
           coalesce(sum(n) FILTER (f = s.k), 0) AS removed,
           coalesce(sum(n) FILTER (fails[s.k] AND f < s.k), 0) AS redundant,
           coalesce(sum(n) FILTER (fails[s.k]
                                   AND len(list_filter(fails, lambda y: y)) = 1), 0) AS unique_fails,
           coalesce(sum(good) FILTER (f = s.k), 0) AS good_lost,
           coalesce(sum(bad) FILTER (f = s.k), 0) AS toxic_lost
    FROM firsts t JOIN steps s ON s.o = t.o GROUP BY ALL)
SELECT part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed,
       redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails,
       good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, x))::BIGINT AS shapley
FROM told
"""
