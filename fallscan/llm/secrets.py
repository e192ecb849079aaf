"""Secret scans with multipart credential linking, with DataFrame functions only.

Base kinds are strong by themselves and always reported: an assignment to a telling name, an
access key, a long hexadecimal run. The method adds *parts* that are weak alone: identifiers (an
access key, a user or client id), secrets (runs of 40 characters, shorter hexadecimal runs,
assignments to vaguer names) and endpoints (addresses, hosts). A part is linked with parts of
other roles that lie within ``SCOPE`` characters, an interval join within the document, and
reported only if it found its complement: a secret needs an identifier or an endpoint, an
identifier or an endpoint needs a secret. A base assignment or hexadecimal run serves as secret,
a base access key as identifier.

Everything happens within a row, hence there is no shuffle and no join, and rows with equal or
null ids do no harm. A gate of one expression lets only documents with any part go on.

Defined cases: null and empty texts have no spans; equal spans of different kinds are listed
each; a part that overlaps a base span or a part listed before it is not reported again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from fallscan.llm.licenses import intervals

# The base kinds of the contract, in order.
ASSIGN = (
    r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ASSIGN_LENGTH = 6
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
BASE_KINDS = ("assign", "access", "hex")

#: Characters between two parts that still belong together.
SCOPE = 300

_VALUE = r"""["']?\x20*[:=]\x20*["']?"""

#: (kind, role, expression) of weak parts, in order.
PARTS = (
    ("user", "identifier", rf"(?i)(?<![a-z0-9])(?:user_?(?:name|id)?|login|client_?id|access_?key_?id|account_?(?:id|name)){_VALUE}[A-Za-z0-9@._+-]{{3,}}"),
    ("email", "identifier", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){1,4}"),
    ("url", "endpoint", r"""(?i)(?:https?|ftps?|jdbc:[a-z0-9]+|postgres(?:ql)?|mysql|mongodb(?:\+srv)?|redis|amqps?)://[^\x00-\x20"'<>]+"""),
    ("host", "endpoint", rf"(?i)(?<![a-z0-9])(?:host(?:name)?|endpoint|server|base_?url){_VALUE}[A-Za-z0-9.:/_-]{{4,}}"),
    ("vague", "secret", rf"(?i)(?<![a-z0-9])(?:pass|pwd|pw|auth|secret_?key|private_?key|access_?key|credential){_VALUE}[A-Za-z0-9+/_.=-]{{6,}}"),
    ("run40", "secret", r"(?<![A-Za-z0-9+/=_-])(?=[A-Za-z+/]{0,39}[0-9])(?=[a-z0-9+/]{0,39}[A-Z])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=_-])"),
    ("hex16", "secret", r"(?<![0-9A-Za-z])(?=[a-f]{0,22}[0-9])[0-9a-f]{16,23}(?![0-9A-Za-z])"),
)

#: A document without a match of this has neither a base span nor a part.
_GATE = (
    r"(?i:password|passwd|secret|token|api_?key|user|login|client_?id|access_?key|account|://|host"
    r"|endpoint|server|base_?url|pass|pwd|\bpw|auth|private_?key|credential)"
    r"|AKIA[A-Z0-9]{16}|[0-9a-f]{16}|@|[A-Za-z0-9+/]{40}"
)

_SPANS = "array<struct<start:int,stop:int,kind:string>>"


def _spans(text: Column, kind: str, pattern: str) -> Column:
    return F.transform(
        intervals(text, F.lit(pattern)),
        lambda i: F.struct(i["start"].alias("start"), i["stop"].alias("stop"), F.lit(kind).alias("kind")),
    )


def _assignments(text: Column) -> Column:
    values = F.transform(F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2)), F.length)
    pairs = F.zip_with(
        _spans(text, "assign", ASSIGN), values,
        lambda span, n: F.struct(span.alias("span"), n.alias("n")),
    )
    return F.transform(F.filter(pairs, lambda p: p["n"] >= ASSIGN_LENGTH), lambda p: p["span"])


def _overlaps(a: Column, b: Column) -> Column:
    return (a["start"] < b["stop"]) & (b["start"] < a["stop"])


def _apart(spans: Column, taken: Column) -> Column:
    return F.when(
        (F.size(spans) > 0) & (F.size(taken) > 0),
        F.filter(spans, lambda s: ~F.exists(taken, lambda o: _overlaps(s, o))),
    ).otherwise(spans)


def _near(a: Column, b: Column, scope: int) -> Column:
    return (a["start"] - b["stop"] <= scope) & (b["start"] - a["stop"] <= scope)


def _listed(spans: Column, kinds: tuple[str, ...]) -> Column:
    """``kind:start:end`` by start, then kind as listed, joined by commas."""
    order = F.array(*[F.lit(k) for k in kinds])
    keyed = F.transform(
        spans,
        lambda s: F.struct(s["start"], F.array_position(order, s["kind"]), s["stop"], s["kind"].alias("kind")),
    )
    texts = F.transform(
        F.array_sort(keyed),
        lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string")),
    )
    return F.array_join(texts, ",")


def scan(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans and ``found``
    (start, stop, kind), the reported spans."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    rows = rows.withColumn("text", F.when(F.col("text").rlike(_GATE), F.col("text")))
    text, none = F.col("text"), F.array().cast(_SPANS)
    base = {
        "assign": _assignments(text),
        "access": _spans(text, "access", ACCESS),
        "hex": _spans(text, "hex", HEX),
    }
    parts = {kind: _spans(text, kind, pattern) for kind, _, pattern in PARTS}
    rows = rows.select(
        "doc_id", *[F.coalesce(a, none).alias(k) for k, a in (base | parts).items()]
    )
    rows = rows.withColumn("base", F.concat(*BASE_KINDS))
    # a part that overlaps a base span, or a part of a kind listed before, is not a part
    taken = F.col("base")
    for kind, _, _ in PARTS:
        rows = rows.withColumn(kind, _apart(F.col(kind), taken))
        taken = F.concat(taken, F.col(kind))
    of_role = {
        role: F.concat(*[k for k, r, _ in PARTS if r == role])
        for role in ("identifier", "endpoint", "secret")
    }
    rows = rows.select(
        "*",
        *[a.alias(f"weak_{role}") for role, a in of_role.items()],
    ).select(
        "doc_id", *BASE_KINDS, "base", "weak_identifier", "weak_endpoint", "weak_secret",
        F.concat("weak_identifier", "weak_endpoint", "access").alias("for_secret"),
        F.concat("weak_secret", "assign", "hex").alias("for_other"),
    )

    def linked(weak: str, complements: str) -> Column:
        return F.when(
            (F.size(weak) > 0) & (F.size(complements) > 0),
            F.filter(
                F.col(weak),
                lambda s: F.exists(F.col(complements), lambda o: _near(s, o, scope)),
            ),
        ).otherwise(none)

    found = F.concat(
        "base",
        linked("weak_identifier", "for_other"),
        linked("weak_endpoint", "for_other"),
        linked("weak_secret", "for_secret"),
    )
    kinds = BASE_KINDS + tuple(k for k, _, _ in PARTS)
    return rows.withColumn("found", found).select(
        "doc_id",
        *[F.size(k).cast("long").alias(f"n_{k}") for k in BASE_KINDS],
        F.sha2(_listed(F.col("base"), BASE_KINDS), 256).alias("base_sha256"),
        _listed(F.col("found"), kinds).alias("spans"),
        "found",
    )
