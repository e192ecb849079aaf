"""Conversation trie, host reputation and filter audit against brute force and SQL."""

import hashlib
import itertools
import random
import zlib

import duckdb
import pytest

import __spark_entry__ as driver
from fallscan.llm import conversation_trie as ct, filter_audit, url_reputation as ur

TURNS = "conv_id long, turn long, role string, text string, key int, depth string"


# ---- trie ----------------------------------------------------------------------------------


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], TURNS)


def brute_trie(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn, role or "", text or ""))

    def digest(role, text):
        return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]

    for c, turns in convs.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, digest(*t[1:])))
        convs[c] = [t[1:] for t in turns]
    built = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = convs.get(c - c % 5, [])[:h] + own[h:]
    members = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out, subtree = [], {p: [0, 0] for p in members}
    children = {p: 0 for p in members}
    for p in members:
        if p:
            children[p[:-1]] += 1
    for p, m in members.items():
        saved = (len(m) - 1) * len(p[-1][1].encode()) if p else 0
        for d in range(len(p) + 1):
            subtree[p[:d]][0] += not children[p]
            subtree[p[:d]][1] += saved
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in m if len(built[c]) == len(p)))
        parent = min(members[p[:-1]]) if p else None
        out.append((min(m), len(p), parent, len(m), children[p], *subtree[p],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out)


def found_trie(table, **more):
    return sorted(tuple(r) for r in ct.conversation_trie(table, **more).collect())


def hot_rows():
    """A common opening, equal conversations, one long conversation, prefixes of others."""
    rng, rows = random.Random(3), []
    for c in range(90):
        opening = [("user", "hello"), ("assistant", "hi"), ("user", "help é")][: rng.randint(0, 3)]
        rest = [(rng.choice(("user", "assistant")), rng.choice("abc")) for _ in range(rng.randint(0, 4))]
        if c % 3 == 0:
            opening, rest = [("user", "hello")] * 9, [("assistant", "same")] * (c % 2)
        rows += [(c * 5 + c % 3, k, *t) for k, t in enumerate(opening + rest)]
    rows += [(1000, k, "user", f"turn {k % 40}") for k in range(300)]
    return rows


@pytest.mark.parametrize("shard_turns", [12, 100, ct.SHARD_TURNS])
def test_trie_equals_brute_force(spark, shard_turns):
    rows = hot_rows()
    assert found_trie(frame(spark, rows).repartition(5), shard_turns=shard_turns) == brute_trie(rows)


def test_trie_defined_cases(spark):
    rows = [
        (1, None, None, None), (1, 0, "user", None), (1, 0, "user", None), (1, 0, "a", "tie"),
        (None, 1, "user", "lost"), (7, 2, "", "x" * 100_000), (7, 1, None, "日本"), (5, 1, "user", "a"),
        (12, 3, "user", "a"), (-4, 1, "user", "minus"), (25, None, "r", "t"), (26, 1, "r", "t"),
    ]
    assert found_trie(frame(spark, rows)) == brute_trie(rows)
    assert found_trie(frame(spark, rows), shard_turns=2) == brute_trie(rows)
    assert found_trie(frame(spark, rows).limit(0)) == []
    lost = [(None, 1, "user", "x")]
    assert found_trie(frame(spark, lost)) == []


def test_double_array_packs_and_refuses():
    rng = random.Random(1)
    seqs = sorted({tuple(rng.randint(0, 30) for _ in range(rng.randint(0, 6))) for _ in range(400)})
    trie = ct.DoubleArray([list(s) for s in seqs])
    nodes = {s[:d] for s in seqs for d in range(len(s) + 1)}
    slots = {tuple(s): trie.walk(list(s))[-1] for s in nodes}
    assert len(set(slots.values())) == len(nodes) == len(trie.order)
    assert all(trie.check[slots[s]] == slots[s[:-1]] for s in nodes if s)
    assert len(trie.check) < 1.5 * len(nodes) + 31
    absent = next(s + (k,) for s in seqs for k in range(31) if s + (k,) not in nodes)
    with pytest.raises(KeyError):
        trie.walk(list(absent))
    assert ct.DoubleArray([]).walk([]) == [0]


# ---- url reputation ------------------------------------------------------------------------

PAGES = "page_id long, url string, html string, host string, mean int"
LABELS = "doc_id long, quality int, toxic int, extra string"


def pages_of(spark, urls):
    return spark.createDataFrame([(k, u, "", "clash", 1) for k, u in enumerate(urls)], PAGES)


def labels_of(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], LABELS)


def test_urls_and_rules(spark):
    urls = {
        None: ("", "", None), "": ("", "", None), "no scheme.org/x": ("", "", None),
        "HTTP://WWW.Example.ORG/ES/": ("www.example.org", "/ES/", "org/"),
        "http://example.org/es/x?y#z": ("example.org", "/es/x", "example.org/es/"),
        "http://a.b.example.org/en/12": ("a.b.example.org", "/en/12", "example.org/en/1"),
        "http://notexample.org/en/12": ("notexample.org", "/en/12", "org/"),
        "https://org?x=/": ("org", "", None), "https://org#": ("org", "", None),
        "x://a.com/fr/1": ("a.com", "/fr/1", "com/fr/"), "x://a.com/fr": ("a.com", "/fr", None),
        "x://a.com/de/": ("a.com", "/de/", "com/de/"), "x://acom/de/": ("acom", "/de/", None),
        "a://b://c.com/de/": ("b:", "//c.com/de/", None), "x://ÄB.com/": ("Äb.com", "/", None),
        "x://" + "a." * 20_000 + "org/": ("a." * 20_000 + "org", "/", "org/"),
        "x://two\nlines.org/a\nb?c": ("two\nlines.org", "/a\nb", "org/"),
    }
    empty = labels_of(spark, []).limit(0)
    found = {r.page_id: r for r in ur.judge(pages_of(spark, urls), empty).collect()}
    allowed = {f"{r.host}{r.path}": r.verdict for r in ur.RULES}
    for k, (host, path, rule) in enumerate(urls.values()):
        row = found[k]
        assert (row.host, row.path, row.rule) == (host, path, rule)
        assert row.verdict == allowed.get(rule, "allow")
    assert ur.judge(pages_of(spark, urls).limit(0), empty).isEmpty()
    no_rules = ur.judge(pages_of(spark, urls), empty, rules=()).collect()
    assert {(r.rule, r.verdict) for r in no_rules} == {(None, "allow")}


def test_domains(spark):
    names = {
        "a.b.example.com": ("example.com", "com"), "x.y.co.uk": ("y.co.uk", "co.uk"),
        "co.uk": ("co.uk", "uk"), "localhost": ("localhost", "localhost"), "": ("", ""),
        "10.0.0.1": ("10.0.0.1", ""), "u@w.example.org:80": ("example.org", "org"),
        "example.org.": ("example.org", "org"), "[::1]": ("[::1]", ""),
    }
    hosts = spark.createDataFrame([(h,) for h in names], "host string")
    found = {r.host: (r.domain, r.suffix) for r in ur.with_domain(hosts).collect()}
    assert found == names


def test_shrinkage_follows_the_evidence(spark):
    """A bad host with much evidence is blocked, with little it is not; a silent host of a bad
    domain takes its domain's rate."""
    urls, labels, doc = [], [], 0
    plan = [("good.a.net", 60, 57), ("bad.b.net", 60, 3), ("few.c.net", 1, 0), ("fine.d.net", 40, 36)]
    for host, n, good in plan:
        for k in range(n):
            urls.append(f"http://{host}/en/{doc}")
            labels.append((doc, int(k < good), 0))
            doc += 1
    urls += ["http://silent.b.net/en/x", "http://silent.a.net/en/x"]
    rows = ur.judge(pages_of(spark, urls), labels_of(spark, labels)).collect()
    by_host = {r.host: (r.verdict, r.host_mean, r.host_upper) for r in rows}
    assert by_host["bad.b.net"][0] == "block"
    assert {by_host[h][0] for h in ("good.a.net", "few.c.net", "fine.d.net")} == {"allow"}
    assert by_host["silent.b.net"][1] < 0.5 < by_host["silent.a.net"][1]
    toxic = [(d, 1, 1) for d, _, _ in labels]
    worse = ur.judge(pages_of(spark, urls), labels_of(spark, toxic)).collect()
    assert {r.verdict for r in worse if r.host == "good.a.net"} == {"block"}
    doubled = ur.judge(pages_of(spark, urls + urls), labels_of(spark, labels + labels))
    assert doubled.count() == 2 * len(urls)


# ---- filter audit --------------------------------------------------------------------------

DOCS = "doc_id long, text string, source string, mask int, part string"


def brute_audit(rows, labels):
    parts = {}
    for i, text, source in rows:
        body = (text or "").encode()
        words = body.split()
        fails = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * sum(c in b"ABCDEFGHIJKLMNOPQRSTUVWXYZ" for c in body) > 2 * len(text or ""),
            "D": any(c in (text or "") for c in "#$%&*|"),
            "E": any(j is not None and i is not None and j < i and (t or "") == (text or "") for j, t, _ in rows),
        }
        parts.setdefault(source or "", []).append((fails, labels.get(i, (None, None))))
    out = set()
    for part, docs in parts.items():
        shapley, found = dict.fromkeys("ABCDE", 0), []
        for order in itertools.permutations("ABCDE"):
            left = docs
            for step, x in enumerate(order, 1):
                gone = [d for d in left if d[0][x]]
                left = [d for d in left if not d[0][x]]
                shapley[x] += len(gone)
                found.append((x, (
                    part, "".join(order), step, len(left), len(gone),
                    sum(d[0][x] for d in docs) - len(gone),
                    sum(d[0][x] and sum(d[0].values()) == 1 for d in docs),
                    sum(d[1][0] == 1 for d in gone), sum(d[1][1] == 1 for d in gone),
                )))
        out |= {(*row, shapley[x]) for x, row in found}
    return out


def test_audit_equals_brute_force(spark):
    rng, rows = random.Random(5), []
    for k in range(60):
        words = [rng.choice(("Word", "word", "é", "x#", "b")) + str(rng.randint(0, 300)) for _ in range(rng.choice((3, 210, 400)))]
        text = "same text" if k % 3 == 0 else " ".join(words if k % 4 else ["rep"] * 250)
        rows.append((k, text, rng.choice(("s", "t", None))))
    rows += [(None, "same text", "t"), (None, None, "s"), (3, "same text", "t"), (99, "", ""), (100, None, "u"),
             (101, "longword " * 30_000, "u"), (102, "\u00a0".join("ab"), "u")]
    labels = {k: (rng.randint(0, 1), rng.choice((0, 1, None))) for k in range(0, 60, 2)}
    docs = spark.createDataFrame([(*r, 9, "clash") for r in rows], DOCS)
    told = labels_of(spark, [(k, *v) for k, v in labels.items()] + [(None, 1, 1)])
    found = filter_audit.audit(docs, told).collect()
    assert len(found) == 600 * len({r[2] or "" for r in rows})
    assert {tuple(r) for r in found} == brute_audit(rows, labels)
    assert filter_audit.audit(docs.limit(0), told).isEmpty()
    assert filter_audit.audit(docs, told.limit(0)).count() == len(found)


# ---- against SQL ---------------------------------------------------------------------------


@pytest.mark.parametrize(
    "name", ["op11_conversation_trie", "op12_host_reputation", "op13_removal_potential"]
)
def test_query_equals_sql(spark, name):
    sf_dir, con = "/root/testdata/sf0.01", duckdb.connect()
    for table in ("documents", "conversations", "pages", "labels"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    found = driver.queries()[name](spark, sf_dir)
    columns = ", ".join(sorted(found.columns))
    expected = con.sql(f"SELECT {columns} FROM ({driver.oracle_sql()[name]})").fetchall()
    assert sorted(map(str, map(tuple, found.select(*sorted(found.columns)).collect()))) == sorted(map(str, expected))
