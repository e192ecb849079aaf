"""Licence scans by ordered signature rules, with DataFrame functions only.

Base detections are places where the words of a phrase stand consecutively. The method adds the
hundreds of signatures of ``license_rules``: a document that has none of the gate's words is
done after one pass; otherwise only rules whose keyword it contains are tried, on normalised
text. Detections are intervals of it. One that lies within another is suppressed, the larger
wins; of equal ones the rule that comes first by priority and order wins. Of those left, ones that
overlap in part are suppressed by a better priority.

Everything happens within a row, hence there is no shuffle and no join, and rows with equal or
null ids do no harm. Positions and suppression follow from running sums and extremes, so a text
with n detections takes about n log n steps.

Defined cases: null and empty texts have no words, empty labels and score 0. Equal words at
several places all count; the same label is listed once. Very long texts are scanned whole; an
empty table gives an empty result; other columns of the table are not read.
"""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from fallscan.llm.license_rules import rules

# The characters between words on lower-cased text, and the base phrases.
SEPARATORS = "".join(
    chr(c) for c in range(128) if not (0x30 <= c <= 0x39 or 0x41 <= c <= 0x5A or 0x61 <= c <= 0x7A)
)
BASE = (
    ("cc by", "cc-by"),
    ("general public license", "gpl"),
    ("all rights reserved", "reserved"),
)

#: Confidence of a base phrase.
BASE_CONFIDENCE = 0.6

#: A document whose spaced text has none of these has no base place and no rule's match.
_GATE = (
    "licen", "spdx", "reserved", "gpl", " cc", "creative", "public", "copyright", "apache", "bsd", "mpl",
    "epl", "cddl", "proprietary", "confidential", "unauthori", "reproduced", "terms", "permi",
    "redistribution", "warrant", "commons", "beerware", "hereby", "wtfpl", "mulan", "eupl", " mit ",
)

def _spaced(text: Column) -> Column:
    """Text in lower case with a space for every character between words, and one at either end."""
    spaced = F.translate(
        text, SEPARATORS + string.ascii_uppercase, " " * len(SEPARATORS) + string.ascii_lowercase
    )
    return F.concat(F.lit(" "), spaced, F.lit(" "))


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often ``use`` refers to it."""
    return F.get(F.transform(F.array(value), lambda v: use(v)), F.lit(0))


def _running(values: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """For each element the combination of all up to it, by doubling: log n rounds over the array.

    A fold that appends to its state would copy the state at every element.
    """

    def scan(found: Column) -> Column:
        def doubled(a: Column, k: Column) -> Column:
            width = F.call_function("shiftleft", F.lit(1), k)
            return F.transform(
                a,
                lambda x, i: F.when(i >= width, combine(x, F.get(a, i - width))).otherwise(x),
            )

        rounds = F.sequence(F.lit(0), F.length(F.bin(F.size(found) - 1)) - 1)
        return F.when(F.size(found) > 1, F.aggregate(rounds, found, doubled)).otherwise(found)

    return _bound(values, scan)


def _places(words: Column, phrase: str) -> Column:
    """Starts of a phrase in an array of words, from 0."""
    parts = phrase.split(" ")

    def here(k: Column) -> Column:
        found = F.get(words, k) == parts[0]
        for step, part in enumerate(parts[1:], 1):
            found = found & F.coalesce(F.get(words, k + step) == part, F.lit(False))
        return found

    return F.when(
        F.size(words) >= len(parts),
        F.filter(F.sequence(F.lit(0), F.size(words) - len(parts)), here),
    ).otherwise(F.array().cast("array<int>"))


def intervals(text: Column, pattern: Column) -> Column:
    """(start, stop) of all matches of a pattern, left to right, in code points from 0.

    The pieces between the matches and the matches themselves add up to the positions.
    """
    pieces = F.transform(F.split(text, pattern, -1), F.length)
    matches = F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), F.length)
    # the last piece has no match behind it
    steps = F.filter(
        F.zip_with(pieces, matches, lambda p, m: F.struct((p + m).alias("stop"), m.alias("len"))),
        lambda s: s["len"].isNotNull(),
    )
    ends = _running(
        steps, lambda x, before: F.struct((x["stop"] + before["stop"]).alias("stop"), x["len"].alias("len"))
    )
    return F.transform(
        ends, lambda e: F.struct((e["stop"] - e["len"]).alias("start"), e["stop"].alias("stop"))
    )


def _rule_table() -> Column:
    return F.array(
        *[
            F.struct(
                F.lit(priority).alias("priority"), F.lit(order).alias("order"),
                F.lit(label).alias("label"), F.lit(keyword.split(";")[0]).alias("keyword"),
                F.lit(keyword.split(";")[-1]).alias("or_keyword"),
                F.lit(expression).alias("expression"), F.lit(confidence).alias("confidence"),
            )
            for order, (priority, label, keyword, expression, confidence) in enumerate(rules())
        ]
    )


def _detections(normal: Column) -> Column:
    """Unsuppressed matches of all rules whose keyword occurs."""
    every = sorted({word for _, _, keyword, _, _ in rules() for word in keyword.split(";")})
    heard = F.filter(F.array(*[F.lit(w) for w in every]), lambda w: F.contains(normal, w))

    def matches(r: Column) -> Column:
        return F.transform(
            intervals(normal, r["expression"]),
            lambda i: F.struct(
                i["start"].alias("start"), i["stop"].alias("stop"),
                r["priority"].alias("priority"), r["order"].alias("order"),
                r["label"].alias("label"), r["confidence"].alias("confidence"),
            ),
        )

    def of_heard(words: Column) -> Column:
        tried = F.filter(
            _rule_table(),
            lambda r: F.array_contains(words, r["keyword"]) | F.array_contains(words, r["or_keyword"]),
        )
        return F.flatten(F.transform(tried, matches))

    # one element, so that the heard keywords are found once
    found = F.flatten(F.transform(F.array(heard), lambda words: of_heard(words)))
    return F.when(normal.isNotNull(), found)


_PRIORITIES = (1, 2, 3, 4)


def _longest_first(d: Column) -> Column:
    return F.struct(
        d["start"].alias("start"), (-d["stop"]).alias("back"), d["priority"].alias("priority"),
        d["order"].alias("order"), d["label"].alias("label"), d["confidence"].alias("confidence"),
    )


def _plain(d: Column) -> Column:
    return F.struct(
        d["start"].alias("start"), (-d["back"]).alias("stop"), d["priority"].alias("priority"),
        d["order"].alias("order"), d["label"].alias("label"), d["confidence"].alias("confidence"),
    )


def _of_priority(field: str, priority: int, other: int) -> Column:
    """A field of the outer detections of one priority, ``other`` in place of the rest."""
    return F.transform("outer", lambda d: F.when(d["priority"] == priority, d[field]).otherwise(other))


def _unsuppressed(rows: DataFrame) -> DataFrame:
    """Replace the column ``all`` of detections by ``detections``, the ones that stay, by start.

    Sorted by start, longest first, then by precedence, a detection is contained if one before
    reaches as far. Those left are ordered by start and by stop alike: one before overlaps if the
    furthest stop of its priority lies beyond the start, one behind if the nearest start lies
    before the stop. What a lambda looks up is bound to a variable, so that it is computed once.
    """
    rows = rows.withColumn("all", F.when(F.size("all") > 0, F.sort_array(F.transform("all", _longest_first))))
    reach = _running(F.transform("all", lambda d: -d["back"]), F.greatest)

    def uncontained(reach: Column) -> Column:
        return F.filter("all", lambda d, i: (i == 0) | (F.get(reach, F.greatest(i - 1, F.lit(0))) < -d["back"]))

    rows = rows.withColumn("outer", F.transform(_bound(reach, uncontained), _plain)).drop("all")
    runs = []
    for p in _PRIORITIES[:-1]:
        far = _running(_of_priority("stop", p, -1), F.greatest)
        near = F.reverse(_running(F.reverse(_of_priority("start", p, 2**31 - 1)), F.least))
        runs += [far.alias(f"far{p}"), near.alias(f"near{p}")]

    def undisputed(run: Column) -> Column:
        def stays(d: Column, i: Column) -> Column:
            beaten = F.lit(False)
            for p in _PRIORITIES[:-1]:
                before = (i > 0) & (F.get(run[f"far{p}"], F.greatest(i - 1, F.lit(0))) > d["start"])
                behind = F.coalesce(F.get(run[f"near{p}"], i + 1) < d["stop"], F.lit(False))
                beaten = beaten | ((d["priority"] > p) & (before | behind))
            return ~beaten

        return F.filter("outer", stays)

    left = F.when(F.size("outer") > 1, _bound(F.struct(*runs), undisputed)).otherwise(F.col("outer"))
    return rows.withColumn("detections", left).drop("outer")


def scan(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score
    and ``detections`` (start, stop, priority, order, label, confidence in normalised text)."""
    none = F.array().cast("array<int>")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    rows = rows.select("doc_id", _spaced(F.col("text")).alias("spaced"))
    is_open = F.lit(False)
    for word in _GATE:
        is_open = is_open | F.contains("spaced", F.lit(word))
    rows = rows.select(
        "doc_id",
        F.regexp_count("spaced", F.lit("[^ ]+")).alias("n_words"),
        F.when(is_open, F.regexp_replace("spaced", " +", " ")).alias("normal"),
    )
    has_base = F.lit(False)
    for phrase, _ in BASE:
        has_base = has_base | F.contains("normal", F.lit(f" {phrase} "))
    rows = rows.withColumn("words", F.when(has_base, F.split(F.trim("normal"), " ", -1)))
    rows = rows.select(
        "*",
        *[
            F.coalesce(_places(F.col("words"), phrase), none).alias(f"base{k}")
            for k, (phrase, _) in enumerate(BASE)
        ],
        _detections(F.col("normal")).alias("all"),
    ).drop("words", "normal")
    rows = _unsuppressed(rows)
    places = F.concat(*[f"base{k}" for k in range(len(BASE))])
    base_labels = F.array_compact(
        F.array(
            *[F.when(F.size(f"base{k}") > 0, F.lit(label)) for k, (_, label) in enumerate(BASE)]
        )
    )
    rows = rows.select("*", places.alias("places"), base_labels.alias("base_found"))
    added = F.transform("detections", lambda d: d["label"])
    labels = F.concat("base_found", F.coalesce(added, F.array().cast("array<string>")))
    listed = lambda a: F.array_join(F.array_sort(F.array_distinct(a)), ",")
    best = F.array_max(F.transform("detections", lambda d: d["confidence"]))
    base_score = F.when(F.size("places") > 0, F.lit(BASE_CONFIDENCE)).otherwise(F.lit(0.0))
    return rows.select(
        "doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        F.size("places").cast("long").alias("n_base"),
        F.array_min("places").cast("long").alias("first_word"),
        F.array_max("places").cast("long").alias("last_word"),
        listed(F.col("base_found")).alias("base_labels"),
        listed(labels).alias("labels"),
        F.greatest(base_score, F.coalesce(best, F.lit(0.0))).alias("score"),
        "detections",
    )
