"""The BPE automaton against the tokenizers library, edited counts against whole encoding."""

import hashlib
import random
from array import array

import public_tokenizers
import pyarrow as pa
import pytest
import tokenizers

from fallscan.llm import bpe, token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [
    "", "plain words and more words", "a<|endoftext|> b<|endoftext|><|endoftext|>", "a" * 70,
    "  \n\n  x \t y", "don't we'll I'd 'sx 'S", "日本語 😀😀 مرحبا", "\x00\x01 x", "x" * 3000,
    "1234567 12,3.4", "ſ K İ", "ab" * 900, "word " * 60_000,
]


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(PATH)


def test_automaton_equals_the_library(library):
    machine, rng = bpe.automaton(PATH), random.Random(2)
    texts = TEXTS + [
        "".join(rng.choice("abcdehilnorst ,.'\n  AEé日😀0123#") for _ in range(rng.randint(1, 60)))
        for _ in range(500)
    ]
    for text in texts:
        ids = machine.encode(text)
        assert list(array("I", ids)) == library.encode(text, add_special_tokens=False).ids
        assert machine.decode(ids) == text


def test_a_word_is_looked_up_by_states_not_by_all_its_parts():
    class Counted(dict):
        asked = 0

        def get(self, key):
            self.asked += 1
            return super().get(key)

    machine, rng = bpe.Automaton(PATH), random.Random(6)
    plain = machine.states
    machine.states = counted = Counted(plain)
    words = ["".join(rng.choices("aeinorstld", k=16)).encode() for _ in range(500)]
    for word in words:
        assert b"".join(machine.labels[state] for state in machine.path(word)) == word
    assert counted.asked < 2 * sum(map(len, words))  # 1.7 a byte; all parts from their ends were 7.6


def test_encoded_documents(spark, library):
    rows = [(k, t, 3) for k, t in enumerate(TEXTS)] + [(None, None, 4), (1, TEXTS[1], 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    found = bpe.encode_documents(docs, PATH, keep_ids=True).collect()
    assert len(found) == len(rows)
    for row in found:
        text = "" if row.doc_id is None else TEXTS[row.doc_id]
        ids = library.encode(text, add_special_tokens=False).ids
        assert (row.ids, row.n_tokens) == (ids, len(ids))
        assert row.ids_sha256 == hashlib.sha256(array("I", ids).tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert bpe.encode_documents(docs.limit(0), PATH).isEmpty()


def test_edits_equal_whole_encoding():
    machine, rng = bpe.automaton(PATH), random.Random(6)
    pieces = ["", "a", " the", "'s", "re", " \n\n ", "<|endoftext|>", "<|endof", "text|>", "12", "é日", "l" * 90]
    for _ in range(60):
        text = "".join(rng.choice(["word ", "it's ", "\n", "x<|endoftext|>", "42 "]) for _ in range(rng.randint(0, 300)))
        tree = token_counts.Tree(text, machine)
        for _ in range(8):
            a = rng.randint(0, len(text) + 2)
            b = a + rng.choice([0, 1, 3, 40])
            insert = rng.choice(pieces) + rng.choice(pieces)
            tree.edit(a, b, insert)
            a = min(a, len(text))
            text = text[:a] + insert + text[max(a, min(b, len(text))) :]
            assert tree.text() == text and tree.characters == len(text)
            assert tree.tokens == len(machine.encode(text)) // 4


def test_an_edit_encodes_little_of_a_long_text():
    tree = token_counts.Tree("some words of a text " * 5000, bpe.automaton(PATH))
    before = tree.encoded
    tree.edit(50_000, 50_010, "new")
    assert tree.encoded - before < 300


def test_counted_edits(spark):
    rows = [
        (1, "one two three", [(3, 3, " more"), (0, 3, None)], 0), (2, None, [(0, 9, "x")], 0),
        (3, "same", None, 0), (3, "same", [(99, 120, " end")], 0),
    ]
    docs = spark.createDataFrame(rows, f"doc_id long, text string, edits {token_counts.EDITS}, n_chars int")
    machine = bpe.automaton(PATH)
    n = lambda t: len(machine.encode(t)) // 4
    found = sorted((r.doc_id, r.n_tokens, r.edited_tokens, r.edited_chars) for r in token_counts.count_edited(docs, PATH).collect())
    assert found == sorted(
        [(1, 3, n(" more two three"), 15), (2, 0, n("x"), 1), (3, 1, 1, 4), (3, 1, n("same end"), 8)]
    )
    assert token_counts.count_edited(docs.limit(0), PATH).isEmpty()


def test_query_edits_equal_whole_encoding(spark, sf_dir):
    from pyspark.sql import functions as F

    from fallscan.llm.queries import QUERIES

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    edits = docs.select("doc_id", "text", token_counts.sample_edits(F.col("text")).alias("edits"))
    machine, expected = bpe.automaton(PATH), {}
    for row in edits.collect():
        text = row.text
        for start, stop, insert in row.edits:
            text = text[:start] + insert + text[stop:]
        expected[row.doc_id] = (len(machine.encode(row.text)) // 4, len(machine.encode(text)) // 4, len(text))
    found = QUERIES["op3_edit_aware_counts"](spark, sf_dir).collect()
    assert {r.doc_id: (r.n_tokens, r.edited_tokens, r.edited_chars) for r in found} == expected


def test_null_edits_and_bounds(spark, library):
    edits = [
        None, [], [None], [(None, None, " end")], [(2, None, "XY")], [(1, 3, None)], [(5, 2, "q")],
        [None, (0, 1, "Z"), (None, 9, None)], [(10**6, 10**6 + 5, "tail")],
    ]
    expected = ["abc def"] * 3 + ["abc def end", "abXYc def", "a def", "abc dqef", "Zbc def", "abc deftail"]
    rows = [(k, "abc def", e) for k, e in enumerate(edits)] + [(99, None, [(0, 0, "new")])]
    docs = spark.createDataFrame(rows, f"doc_id long, text string, edits {token_counts.EDITS}")
    found = {r.doc_id: r for r in token_counts.count_edited(docs, PATH).collect()}
    for k, text in [*enumerate(expected), (99, "new")]:
        assert found[k].edited_chars == len(text)
        assert found[k].edited_tokens == len(library.encode(text, add_special_tokens=False).ids)
    assert token_counts.count_edited(docs.limit(0), PATH).isEmpty()


def test_a_worker_holds_no_words_or_arcs_once_its_task_has_ended(spark):
    texts = [(k, f"unheard{k}ofword another{k}strangeword") for k in range(80)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(8)
    assert bpe.encode_documents(docs, PATH).where("n_tokens > 4").count() == 80

    def held(batches):
        for _ in batches:
            known = [len(m.words) + len(m.older) + len(m.arcs) for m in bpe._automata.values()]
            yield pa.RecordBatch.from_arrays([pa.array([sum(known)], pa.int64())], ["held"])

    rows = spark.range(0, 80, 1, 8).mapInArrow(held, "held long").collect()
    assert [row["held"] for row in rows] == [0] * 8
