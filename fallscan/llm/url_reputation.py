"""URL filters: explicit rules, and the reputation of hosts behind them.

A rule names a host and the start of a path; it fits its host and all subdomains, and the longest
fitting rule decides. Pages without one are judged by their host's reputation: the share of good
pages among its labelled ones, shrunk by empirical Bayes along host, registered domain and suffix.
Each level is beta-binomial: a child's rate is drawn from a beta distribution around its parent's
rate, whose concentration is estimated from all children of the level by the method of moments
(over-dispersion of their counts). A suffix shrinks to the rate of all pages, a domain to its
suffix, a host to its domain; the parent's rate is taken without the child's own pages, so no page
counts twice. A host is blocked if even the upper bound of its posterior, mean plus ``BOUND``
standard deviations, lies below ``MIN_GOOD``: little evidence doesn't block.

Labelled outcomes: a page shows the document that its path names after the first segment
(``/en/123``); it is good if that document is labelled with quality 1 and not as toxic.

Scale: hosts are reduced to counts on the map side before anything moves, so a host with a third
of all pages is one row. The verdicts of hosts come back to the pages by a broadcast if their
measured bytes are few, else by a join that adaptive execution splits where it is skewed.
To the driver come four numbers per level.

Defined cases: null urls and urls without ``://`` have host and path ``""``; the host ``""`` is a
host like any other; page ids may be null or repeated, a row in gives a row out; hosts without
labelled pages take their domain's rate; only as many trailing labels of a host as the longest rule
host has are looked at, so a host of any length does no harm; of rules of equal length for one url,
which differ in their hosts' text, the greater text wins; empty tables give an empty result, empty
labels block nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from fallscan.llm.common import broadcast_bytes, settle


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str


# The rules of the registered query.
RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)

# Second-level words under which countries register domains.
COUNTRY_SECOND_LEVEL = ("ac", "co", "com", "edu", "gov", "net", "org")

#: The good rate that a host's upper bound must reach, and the bound's standard deviations
#: (one-sided 95 %).
MIN_GOOD = 0.6
BOUND = 1.645

#: Bounds of the correlation within a level, and its value where no child has two pages.
#: The concentration of the prior is 1 / correlation - 1.
LEAST_CORRELATION, MOST_CORRELATION, UNKNOWN_CORRELATION = 0.01, 0.5, 0.1

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 1)
    return F.translate(host, _UPPER, _UPPER.lower())


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 2)


def _last_labels(labels: Column, n: Column) -> Column:
    """The last n parts of a name, all if it has fewer."""
    n = F.least(n, F.size(labels))
    return F.array_join(F.slice(labels, F.size(labels) - n + 1, n), ".")


def with_domain(hosts: DataFrame) -> DataFrame:
    """Add ``domain`` and ``suffix`` of ``host``: a suffix is the last label, or the last two
    under a country; the registered domain has one label more. Addresses are their own domain."""
    name = F.regexp_replace("host", r"^.*@|:[0-9]*$|\.+$", "")
    labels = F.split("_name", r"\.", -1)
    country = (
        (F.size(labels) > 2)
        & (F.length(F.element_at(labels, -1)) == 2)
        & F.try_element_at(labels, F.lit(-2)).isin(*COUNTRY_SECOND_LEVEL)
    )
    depth = F.when(country, 2).otherwise(1)
    address = F.col("_name").rlike(r"^[0-9.]+$|^\[")
    return (
        hosts.withColumn("_name", name)
        .withColumn("domain", F.when(address, F.col("_name")).otherwise(_last_labels(labels, depth + 1)))
        .withColumn("suffix", F.when(address, "").otherwise(_last_labels(labels, depth)))
        .drop("_name")
    )


def outcomes(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(host, n, good): labelled pages and good ones per host, zeros included."""
    shown = F.regexp_extract(path_of(F.col("url")), r"^/[^/]+/([0-9]{1,18})", 1)
    per_item = (
        pages.select(host_of(F.col("url")).alias("host"), shown.alias("shown"))
        .groupBy("host", F.expr("try_cast(shown as bigint)").alias("item"))
        .agg(F.count("*").alias("pages"))
    )
    judged = (
        labels.where("doc_id is not null and quality is not null")
        .groupBy(F.col("doc_id").cast("long").alias("item"))
        .agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic"))
        .select("item", ((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) != 1)).alias("is_good"))
    )
    return (
        per_item.join(judged, "item", "left")
        .groupBy("host")
        .agg(
            F.sum(F.when(F.col("is_good").isNotNull(), F.col("pages")).otherwise(0)).alias("n"),
            F.sum(F.when(F.col("is_good"), F.col("pages")).otherwise(0)).alias("good"),
        )
    )


def _concentration(children: DataFrame) -> float:
    """The prior's strength from (n, good, prior): how far counts vary beyond binomial ones."""
    m = F.least(F.greatest("prior", F.lit(0.001)), F.lit(0.999))
    spread = F.pow(F.col("good") - F.col("n") * m, F.lit(2)) / (m * (1 - m))
    found = children.agg(
        F.sum(spread).alias("spread"),
        F.sum("n").alias("n"),
        F.sum(F.col("n") * (F.col("n") - 1)).alias("pairs"),
    ).first()
    correlation = UNKNOWN_CORRELATION
    if found.pairs:
        correlation = round((found.spread - found.n) / found.pairs, 9)
    correlation = min(max(correlation, LEAST_CORRELATION), MOST_CORRELATION)
    return 1 / correlation - 1


def reputations(counted: DataFrame) -> DataFrame:
    """(host, n, good, domain, suffix, prior, mean, upper) from (host, n, good), settled."""
    hosts = settle(with_domain(counted))
    total = hosts.agg(F.sum("n").alias("n"), F.sum("good").alias("good")).first()
    n, good = F.lit(total.n or 0), F.lit(total.good or 0)
    # all pages stand above the suffixes, with one good and one bad page as their own prior
    above, strength, prior = None, 2.0, F.lit(0.5)
    for level, parent in (("suffix", None), ("domain", "suffix"), ("host", "domain")):
        keys = [level] if parent is None else [level, parent]
        sums = hosts.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
        if parent is not None:
            totals = [F.col(c).alias(f"all_{c}") for c in ("n", "good", "prior")]
            sums = sums.join(above.select(parent, *totals), parent)
            n, good, prior = F.col("all_n"), F.col("all_good"), F.col("all_prior")
        others = (good - F.col("good") + strength * prior) / (n - F.col("n") + strength)
        above = settle(sums.select(*keys, "n", "good", others.alias("prior")))
        strength = _concentration(above)
    size = F.col("n") + strength
    mean = (F.col("good") + strength * F.col("prior")) / size
    judged = above.withColumn("mean", mean).withColumn(
        "upper", F.col("mean") + BOUND * F.sqrt(F.col("mean") * (1 - F.col("mean")) / (size + 1))
    )
    return settle(
        judged.join(hosts.select("host", "suffix"), "host")
        .select("host", "n", "good", "domain", "suffix", "prior", "mean", "upper")
    )


def _rules_of_hosts(hosts: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(host, rules): the rules that fit a host or one of its parents, by length."""
    spark = hosts.sparkSession
    table = spark.createDataFrame(
        [(r.host, len(r.host + r.path), r.host + r.path, r.path, r.verdict) for r in rules],
        "above string, length int, rule string, path string, verdict string",
    )
    deepest = max((r.host.count(".") + 1 for r in rules), default=1)
    labels = F.split("host", r"\.", -1)
    above = F.explode(F.sequence(F.lit(1), F.least(F.size(labels), F.lit(deepest))))
    parents = hosts.select("host", above.alias("k")).select(
        "host", _last_labels(labels, F.col("k")).alias("above")
    )
    entry = F.struct("length", "rule", "path", "verdict")
    return parents.join(table, "above").groupBy("host").agg(F.collect_list(entry).alias("rules"))


def judge(pages: DataFrame, labels: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Per page: page_id, host, path, rule, verdict, and the host's mean and upper bound."""
    scored = reputations(outcomes(pages, labels))
    fitting = _rules_of_hosts(scored, rules)
    hosts = settle(
        scored.join(fitting, "host", "left").select(
            F.col("host").alias("_host"), "rules", F.col("mean").alias("host_mean"),
            F.col("upper").alias("host_upper"),
        )
    )
    parsed = pages.select(
        "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")
    )
    known = broadcast_bytes(hosts, F.octet_length("_host") + F.coalesce(F.octet_length(F.to_json("rules")), F.lit(0)))
    best = F.array_max(F.filter("rules", lambda r: F.startswith("path", r["path"])))
    by_host = F.when(F.col("host_upper") < MIN_GOOD, "block").otherwise("allow")
    return (
        parsed.join(known, F.col("host") == F.col("_host"), "left")
        .withColumn("best", best)
        .select(
            "page_id",
            "host",
            "path",
            F.col("best.rule").alias("rule"),
            F.coalesce("best.verdict", by_host).alias("verdict"),
            "host_mean",
            "host_upper",
        )
    )


def _level_sql(name: str, keys: str, above: str) -> str:
    """CTEs of one level: counts with the prior rate, then the strength."""
    return f"""
{name}_sums AS (
    SELECT {keys}, sum(x.n)::DOUBLE AS n, sum(x.good)::DOUBLE AS good,
           (any_value(a.good) - sum(x.good) + any_value(a.s * a.prior))
             / (any_value(a.n) - sum(x.n) + any_value(a.s)) AS prior
    FROM named x JOIN {above} GROUP BY ALL),
{name}_level AS (
    SELECT t.*, 1 / least(greatest(CASE WHEN pairs > 0 THEN round((spread - total) / pairs, 9)
                                        ELSE {UNKNOWN_CORRELATION} END,
                                   {LEAST_CORRELATION}), {MOST_CORRELATION}) - 1 AS s
    FROM {name}_sums t, (
        SELECT sum(pow(good - n * m, 2) / (m * (1 - m))) AS spread, sum(n) AS total,
               sum(n * (n - 1)) AS pairs
        FROM (SELECT *, least(greatest(prior, 0.001), 0.999) AS m FROM {name}_sums)))"""


ORACLE_SQL = rf"""
WITH parsed AS (
    SELECT page_id,
           translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
                     '{_UPPER}', '{_UPPER.lower()}') AS host,
           regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
    FROM pages),
judged AS (
    SELECT doc_id, max(quality) = 1 AND coalesce(max(toxic), 0) <> 1 AS good
    FROM labels WHERE quality IS NOT NULL GROUP BY doc_id),
hosts AS (
    SELECT host, count(j.good) AS n, count(*) FILTER (j.good) AS good,
           regexp_replace(host, '^.*@|:[0-9]*$|\.+$', '', 'g') AS name
    FROM parsed p LEFT JOIN judged j
      ON j.doc_id = try_cast(regexp_extract(path, '^/[^/]+/([0-9]{{1,18}})', 1) AS BIGINT)
    GROUP BY host),
split AS (
    SELECT *, string_split(name, '.') AS l,
           regexp_matches(name, '^[0-9.]+$|^\[') AS address FROM hosts),
deep AS (
    SELECT *, CASE WHEN len(l) > 2 AND length(l[-1]) = 2
                    AND list_contains({list(COUNTRY_SECOND_LEVEL)}, l[-2]) THEN 2 ELSE 1 END AS d
    FROM split),
named AS (
    SELECT host, n, good,
           CASE WHEN address THEN name ELSE array_to_string(l[greatest(len(l) - d, 1):], '.') END
             AS domain,
           CASE WHEN address THEN '' ELSE array_to_string(l[greatest(len(l) - d + 1, 1):], '.') END
             AS suffix
    FROM deep),
overall AS (SELECT sum(n) AS n, sum(good) AS good, 0.5 AS prior, 2 AS s FROM named),
{_level_sql("suffix", "x.suffix", "overall a ON true")},
{_level_sql("domain", "x.domain, x.suffix", "suffix_level a ON a.suffix = x.suffix")},
{_level_sql("host", "x.host", "domain_level a ON a.domain = x.domain")},
rated AS (SELECT *, (good + s * prior) / (n + s) AS mean FROM host_level),
bounds AS (
    SELECT host, mean + {BOUND} * sqrt(mean * (1 - mean) / (n + s + 1)) AS upper FROM rated),
rules(verdict, h, p) AS (VALUES {", ".join(f"('{r.verdict}', '{r.host}', '{r.path}')" for r in RULES)}),
fits AS (
    SELECT DISTINCT p.host, p.path, r.verdict, h || r.p AS rule
    FROM parsed p JOIN rules r
      ON (p.host = r.h OR ends_with(p.host, '.' || r.h)) AND starts_with(p.path, r.p)),
best AS (
    SELECT * FROM fits
    QUALIFY row_number() OVER (PARTITION BY host, path ORDER BY length(rule) DESC, rule DESC) = 1)
SELECT p.page_id, p.host, p.path, b.rule,
       coalesce(b.verdict, CASE WHEN x.upper < {MIN_GOOD} THEN 'block' ELSE 'allow' END) AS verdict
FROM parsed p JOIN bounds x ON x.host = p.host
LEFT JOIN best b ON b.host = p.host AND b.path = p.path
"""
