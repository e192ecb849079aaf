"""Quality rules with a hashed n-gram log-likelihood ratio, with DataFrame functions only.

Words are reduced to *forms*: letters to their case pattern, digits to 0, other characters as
they are ("Hello," and "World," share one). Unigrams and bigrams of forms are hashed into
``BUCKETS`` classes each. Over all documents and over the trusted ones (label quality = 1)
their counts give two multinomials; a document's score is the mean over its n-grams of the log
ratio of the two, hence independent of its length (Xie, Santurkar, Ma, Liang: Data Selection
for Language Models via Importance Resampling, 2023). A document below ``THRESHOLD`` fails, as
does one that fails the base rules.

What is gathered are 2 * BUCKETS counts whatever the input, summed map-side first; scoring is a
pass without a shuffle. Trusted ids are broadcast if they are few, else joined.

Defined cases: null and empty texts have no words and fail the base rule; without trusted or
without any n-grams every score is 0; ``n_dup_lines`` compares whole lines as they are; rows
that repeat a doc_id are judged each.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from fallscan.llm.common import SPACE_CHARS, WORD, settle, small_side

BUCKETS = 1 << 14

#: Least mean log ratio (nats per n-gram) of a kept document.
THRESHOLD = -0.5

# Fixed values of the base rules.
SYMBOLS = r"[#*$%&|<>]"
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50

_LONGS = "array<bigint>"


def _forms(text: Column) -> Column:
    """Case patterns of words: digits 0, capitals 1, several capitals 9, other letters a."""
    for pattern, mark in (
        (r"\p{N}+", "0"), (r"\p{Lu}{2,}", "9"), (r"\p{Lu}", "1"), (r"[\p{Ll}\p{Lo}\p{Lm}]+", "a"),
    ):
        text = F.regexp_replace(text, pattern, mark)
    return text


def _words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def _hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def _windows(hashes: Column, width: int) -> Column:
    """A hash of every run of ``width`` elements.

    The array is bound to a lambda variable, so that it is computed once a row even where the
    optimizer copies its expression, as it does for a filter on the result.
    """

    def runs(h: Column) -> Column:
        return F.when(
            F.size(h) >= width,
            F.transform(
                F.sequence(F.lit(0), F.size(h) - width),
                lambda k: F.xxhash64(*[F.get(h, k + step) for step in range(width)]),
            ),
        ).otherwise(F.array().cast(_LONGS))

    return F.get(F.transform(F.array(hashes), runs), F.lit(0))


def _with_grams(rows: DataFrame) -> DataFrame:
    """``rows`` with ``grams``: the classes of all form unigrams and bigrams."""
    rows = rows.withColumn("_forms", _hashes(_words(_forms(F.col("text")))))
    n = F.lit(BUCKETS).cast("long")
    single = F.transform("_forms", lambda h: F.pmod(h, n).cast("int"))
    double = F.transform(_windows(F.col("_forms"), 2), lambda h: (F.pmod(h, n) + n).cast("int"))
    return rows.withColumn("grams", F.concat(single, double)).drop("_forms")


def log_ratios(docs: DataFrame, labels: DataFrame) -> list[float]:
    """The log ratio of trusted to raw probability of each class; zeros without trusted text."""
    trusted = settle(
        labels.where("quality = 1 and doc_id is not null")
        .select(F.col("doc_id").cast("long").alias("_trusted"))
        .distinct()
    )
    rows = docs.select(
        F.col("doc_id").cast("long").alias("_id"), F.coalesce("text", F.lit("")).alias("text")
    )
    rows = rows.join(small_side(trusted), F.col("_id") == F.col("_trusted"), "left")
    counts = (
        _with_grams(rows.select("text", F.col("_trusted").isNotNull().alias("good")))
        # the outer form: else a filter on the array's size would repeat its computation
        .select("good", F.explode_outer("grams").alias("gram"))
        .where("gram is not null")
        .groupBy("gram")
        .agg(F.count("*").alias("raw"), F.count_if("good").alias("target"))
        .collect()  # at most 2 * BUCKETS rows
    )
    raw, target = np.zeros((2, BUCKETS)), np.zeros((2, BUCKETS))
    for row in counts:
        order, place = divmod(row["gram"], BUCKETS)
        raw[order, place], target[order, place] = row["raw"], row["target"]
    if not target.sum():
        return [0.0] * (2 * BUCKETS)
    smoothed = lambda c: np.log((c + 1) / (c.sum(axis=1, keepdims=True) + BUCKETS))
    return (smoothed(target) - smoothed(raw)).ravel().tolist()


def _with_repeated_words(rows: DataFrame) -> DataFrame:
    """``rows`` with ``n_repeat_words``: words in windows of three that occur twice or more.

    Windows are sorted with their places; equal neighbours repeat. Places in order then cover
    three words each, less what the place before covered. Every step is a column of its own, so
    that it is computed once a row.
    """
    rows = rows.withColumn("_windows", _windows(F.col("hashes"), 3))
    some = F.size(F.array_distinct("_windows")) < F.size("_windows")
    placed = F.transform("_windows", lambda h, k: F.struct(h.alias("h"), k.alias("k")))
    rows = rows.withColumn("_placed", F.when(some, F.sort_array(placed))).drop("_windows")

    def repeated(p: Column) -> Column:
        same = lambda x, k: F.coalesce(F.get(p, k)["h"] == x["h"], F.lit(False))
        return F.filter(p, lambda x, k: same(x, k - 1) | same(x, k + 1))

    repeats = F.get(F.transform(F.array("_placed"), repeated), F.lit(0))
    starts = F.sort_array(F.transform(repeats, lambda x: x["k"]))
    zero = F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n"))
    covered = F.aggregate(
        starts,
        zero,
        lambda a, k: F.struct(
            k.alias("last"), (a["n"] + F.least(F.lit(3), k - a["last"])).alias("n")
        ),
        lambda a: a["n"],
    )
    return rows.withColumn(
        "n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")
    ).drop("_placed")


def judge(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per document: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept and the score."""
    # one folded literal: 2 * BUCKETS numbers
    written = ",".join(map(repr, log_ratios(docs, labels)))
    ratios = F.split(F.lit(written), ",", -1).cast("array<double>")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    )
    rows = _with_grams(rows.withColumn("hashes", _hashes(_words(F.col("text")))))
    rows = _with_repeated_words(rows)
    total = F.aggregate("grams", F.lit(0.0), lambda a, g: a + F.get(ratios, g))
    lines = F.filter(F.split("text", "\n", -1), lambda line: line.rlike(WORD))
    rows = rows.select(
        "doc_id",
        F.size("hashes").cast("long").alias("n_words"),
        F.length(F.translate("text", SPACE_CHARS, "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        (total / F.greatest(F.size("grams"), F.lit(1))).alias("score"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")
    )
    return rows.withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & (F.col("score") >= threshold)
    )
