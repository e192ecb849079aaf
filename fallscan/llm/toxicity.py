"""Toxicity by gradient-boosted trees over dense features, calibrated by isotonic regression.

A written lexicon of abuse is widened by terms (words and word beginnings) that labelled
documents use far more often when toxic. Features of a text are densities of both lexicons,
how near hits stand to a second person, capitals, punctuation and obfuscation rates. Boosted
trees score them, and an isotonic regression on other labelled rows turns scores into rates.

Labels come only from rows with crc32(doc_id) mod 5 <> 0. Of those, remainders 2 and 3 teach
the terms, 4 the trees and 1 the calibration, so that no step sees its own rows again. At most
``MAX_LABELLED`` labelled rows are used, chosen by a hash of doc_id; everything else covers all
documents. Label, language, source and doc_id are no inputs of a score.

Defined cases: null and empty texts get the score of a text without words; rows that repeat a
doc_id are scored each; a null doc_id never trains and is not held out; a doc_id labelled more
than once counts as toxic if one label says so; without rows of both labels the score is the
rate of toxic labels, without labels 0.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame, functions as F

from fallscan.llm.common import free_names, settle, small_side

#: Bound of the labelled rows that the classifier is fitted on.
MAX_LABELLED = 40_000

#: A term is taken if it occurs in so many toxic texts, so many times as often as in others.
MIN_SUPPORT = 3
MIN_LIFT = 10.0
MAX_TERMS = 4_000

TREES = 20
DEPTH = 4

#: Share of the raw score in the final one: it orders texts that the calibration ties.
RAW_SHARE = 0.01

WINDOW = 50
NEAR_WORDS = 6

#: Words of abuse in four languages.
LEXICON = frozenset(
    """
    idiot idiots idiotic moron morons moronic stupid stupidity dumb dumbass fool fools imbecile
    cretin scum scumbag trash garbage filth filthy vermin loser losers clown clowns pathetic
    worthless disgusting useless disgrace ugly fat pig pigs rat rats creep creeps freak freaks
    bastard bastards bitch bitches whore slut asshole assholes jerk jerks crap shit shitty
    bullshit fuck fucking fucked fucker damn dick dickhead prick cunt twat wanker retard
    retarded parasite parasites coward cowards liar liars hate hateful kill die rot shut
    idioten dumm dummkopf blöd blöde blödmann trottel depp deppen vollidiot arsch arschloch
    scheiße scheisse schwein schweine abschaum versager ekelhaft erbärmlich wertlos hure
    schlampe wichser missgeburt verrecke hasse lügner müll
    idiote idiots imbécile crétin crétins débile débiles abruti abrutis connard connards conne
    connasse salaud salope pute putain merde ordure ordures minable pathétique dégoûtant nul
    nulle raclure enculé crève haine menteur
    idiota idiotas imbécil imbéciles estúpido estúpida estúpidos tonto tonta gilipollas cabrón
    cabrones puta puto mierda basura escoria patético patética asqueroso asquerosa inútil
    perdedor payaso cerdo cerda maldito maldita muérete odio mentiroso
    """.split()
)

SECOND_PERSON = frozenset(
    """
    you your yours yourself yourselves u ur youre du dich dir dein deine deinen deiner euch euer
    eure tu te toi ton ta tes vous votre vos ti tus usted ustedes vosotros vuestro tuyo
    """.split()
)

# Characters that stand for letters in disguised words.
_DISGUISE = str.maketrans("013457@$!|+€", "oieastasiite")
_WORDS = re.compile(r"[^\W\d_]+")
_STRETCHED = re.compile(r"(.)\1{2,}")
_FILLERS = re.compile(r"[\W_]+")
_CAPITALS = bytes(range(65, 91))
_SMALL = bytes(range(97, 123))
_SYMBOLS = b"#*$%&|<>^~_="

FEATURES = (
    "written_density", "term_density", "term_weight", "distinct_terms", "hits", "densest_window",
    "near_second_person", "second_person_density", "capitals", "shouted", "exclamations",
    "questions", "symbols", "disguised", "disguised_hits", "stretched", "words", "word_length",
)


def _undisguised(token: str) -> str:
    plain = _FILLERS.sub("", token.lower().translate(_DISGUISE))
    return _STRETCHED.sub(r"\1", plain)


def features(text: str, terms: dict[str, float]) -> list[float]:
    """The dense features of one whole text, in the order of FEATURES."""
    words = _WORDS.findall(text.lower())
    n = len(words)
    per_word = 1.0 / max(n, 1)
    written = [k for k, w in enumerate(words) if w in LEXICON]
    weights, at, seen = 0.0, [], set()
    for k, w in enumerate(words):
        weight = terms.get(w) or terms.get(w[:6]) or terms.get(w[:4])
        if weight:
            weights += weight
            at.append(k)
            seen.add(w)
    hits = sorted({*written, *at})
    densest = low = 0
    for k, position in enumerate(hits):
        while position - hits[low] >= WINDOW:
            low += 1
        densest = max(densest, k - low + 1)
    second = [k for k, w in enumerate(words) if w in SECOND_PERSON]
    near, j = 0, 0
    for position in hits:
        while j < len(second) and second[j] < position - NEAR_WORDS:
            j += 1
        near += j < len(second) and second[j] <= position + NEAR_WORDS
    tokens = text.split()
    odd = [t for t in tokens if not t.isalpha() and any(c.isalpha() for c in t[1:-1])]
    inner = [t for t in odd if not t.strip(".,;:!?\"'()[]").replace("-", "").isalpha()]
    disguised_hits = 0
    for t in inner:
        plain = _undisguised(t)
        disguised_hits += plain in LEXICON or plain in terms
    raw = text.encode("utf-8", "replace")
    size = max(len(raw), 1)
    count = lambda chars: len(raw) - len(raw.translate(None, chars))
    capitals = count(_CAPITALS)
    return [
        len(written) * per_word,
        len(at) * per_word,
        weights * per_word,
        math.log1p(len(seen)),
        math.log1p(len(hits)),
        densest / WINDOW,
        near / max(len(hits), 1),
        len(second) * per_word,
        capitals / max(capitals + count(_SMALL), 1),
        sum(len(t) > 1 and t.isupper() for t in tokens) / max(len(tokens), 1),
        raw.count(b"!") / size,
        raw.count(b"?") / size,
        count(_SYMBOLS) / size,
        len(inner) / max(len(tokens), 1),
        math.log1p(disguised_hits),
        len(_STRETCHED.findall(text)) * per_word,
        math.log1p(n),
        sum(map(len, words)) * per_word,
    ]


def _beginnings(text: str) -> set[str]:
    words = set(_WORDS.findall(text.lower()))
    return (
        words | {w[:4] for w in words if len(w) > 4} | {w[:6] for w in words if len(w) > 6}
    )


def _terms_with(label: int, among: frozenset[str] | None = None):
    """Counts of (term, texts) per batch over texts of one label, of all terms or of some."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: Counter = Counter()
            for text, toxic in zip(batch.column("text"), batch.column("toxic").to_pylist()):
                if toxic == label:
                    found = _beginnings(text.as_py() or "")
                    counts.update(found if among is None else found & among)
            yield pa.RecordBatch.from_arrays(
                [pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())],
                ["term", "texts"],
            )

    return run


def remainder(doc_id):
    """crc32 of the id as text, modulo 5."""
    return F.crc32(F.col(doc_id).cast("string")) % 5


def usable_labels(labels: DataFrame, limit: int = MAX_LABELLED) -> DataFrame:
    """(doc_id, toxic, fold) of rows that may teach, at most about ``limit``, settled."""
    rows = (
        labels.where("doc_id is not null and toxic is not null")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
        .withColumn("fold", remainder("doc_id"))
        .where("fold <> 0 and toxic in (0, 1)")
    )
    rows = settle(rows)
    total = rows.count()
    if total <= limit:
        return rows
    share = int(limit / total * 1_000_000)
    return settle(rows.where(F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1_000_000)) < share))


def learn_terms(docs: DataFrame, labelled: DataFrame) -> dict[str, float]:
    """The terms of the folds 2 and 3 with their log lift; copies of a text count once."""
    teaching = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .join(F.broadcast(labelled.where("fold in (2, 3)")), "doc_id")  # at most MAX_LABELLED
        .where("text is not null")
        .groupBy(F.xxhash64("text").alias("text_hash"))
        .agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))
        .select("text", "toxic")
    )
    teaching = settle(teaching)
    sizes = dict(teaching.groupBy("toxic").count().collect())
    bad, good = sizes.get(1, 0), sizes.get(0, 0)
    if not bad or not good:
        return {}

    def counted(label: int, among: frozenset[str] | None = None) -> DataFrame:
        rows = teaching.mapInArrow(_terms_with(label, among), "term string, texts long")
        return rows.groupBy("term").agg(F.sum("texts").alias("texts"))

    # Both results are bounded by the labelled texts.
    often = counted(1).where(F.col("texts") >= MIN_SUPPORT).collect()
    clean = dict(counted(0, frozenset(row["term"] for row in often)).collect())
    weights = {}
    for term, texts in often:
        lift = ((texts + 0.5) / (bad + 1)) / ((clean.get(term, 0) + 0.5) / (good + 1))
        if lift >= MIN_LIFT:
            weights[term] = (math.log(lift), texts)
    best = sorted(weights, key=lambda t: (-weights[t][0] * weights[t][1], t))[:MAX_TERMS]
    return {term: weights[term][0] for term in best}


def featured(docs: DataFrame, terms: dict[str, float]) -> DataFrame:
    """(doc_id, row_no, features) of every document, settled: the texts are read once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [features(t.as_py() or "", terms) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("row_no"),
                    pa.array(rows, pa.list_(pa.float64())),
                ],
                ["doc_id", "row_no", "features"],
            )

    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.monotonically_increasing_id().alias("row_no"),
        "text",
    )
    return settle(narrow.mapInArrow(run, "doc_id long, row_no long, features array<double>"))


def _has_both(rows: DataFrame) -> bool:
    return rows.agg(F.countDistinct("toxic")).first()[0] == 2


def scored(found: DataFrame, labelled: DataFrame) -> DataFrame:
    """``found`` with a column ``score``: trees, then calibration."""
    rows = settle(
        found.join(labelled, "doc_id").select(
            array_to_vector("features").alias("vector"),
            F.col("toxic").cast("double").alias("toxic"),
            "fold",
        )
    )
    training, holding = rows.where("fold = 4"), rows.where("fold = 1")
    if not _has_both(training):
        training = rows.where("fold <> 1")
    if not _has_both(training):
        rate = rows.agg(F.avg("toxic")).first()[0] or 0.0
        return found.withColumn("score", F.lit(float(rate)))
    trees = GBTClassifier(
        featuresCol="vector", labelCol="toxic", maxIter=TREES, maxDepth=DEPTH, stepSize=0.2,
        maxBins=32, minInstancesPerNode=5, seed=17,
    )
    trees.setPredictionCol("_said").setRawPredictionCol("_margin").setProbabilityCol("_odds")
    trees = trees.fit(training.select("vector", "toxic"))

    def raw(frame: DataFrame) -> DataFrame:
        return (
            trees.transform(frame)
            .withColumn("raw", vector_to_array("_odds")[1])
            .drop("_said", "_margin", "_odds")
        )

    known = settle(raw(holding).select("raw", "toxic"))
    everything = raw(found.withColumn("vector", array_to_vector("features")))
    if not _has_both(known):
        return everything.withColumn("score", F.col("raw")).drop("vector", "raw")
    curve = IsotonicRegression(
        featuresCol="raw", labelCol="toxic", predictionCol="_rate"
    ).fit(known)
    score = (1 - RAW_SHARE) * F.col("_rate") + RAW_SHARE * F.col("raw")
    return (
        curve.transform(everything)
        .withColumn("score", F.least(F.lit(1.0), F.greatest(F.lit(0.0), score)))
        .drop("vector", "raw", "_rate")
    )


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    return _scored_rows(docs, labels).drop("row_no")


def _scored_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    labelled = usable_labels(labels)
    found = featured(docs, learn_terms(docs, labelled))
    return scored(found, labelled).select(
        "doc_id",
        "row_no",
        F.coalesce(remainder("doc_id") == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` with all its columns, without toxic documents.

    Rows that share a doc_id go together if one of them is toxic. Texts are not shuffled unless
    the rejected ids are too many to broadcast.
    """
    bad = _scored_rows(docs, labels).where("predicted = 1")
    (name,) = free_names(docs, "__bad")
    gone = small_side(settle(bad.select(F.col("doc_id").alias(name)).distinct()))
    return docs.join(gone, docs["doc_id"].cast("long").eqNullSafe(F.col(name)), "left_anti")
