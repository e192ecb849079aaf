"""Byte-level BPE by a deterministic automaton over tokens.

The automaton reads a sequence of tokens and accepts it exactly if BPE would produce it. It is
compiled by one merge gadget after the other, in the order of the merges (after Berglund,
Martens, van der Merwe: Constructing a BPE Tokenization DFA, 2024; Cognetta, Okazaki:
Tokenization as Finite-State Transduction, 2024). A state is the token read last. At first
every byte token has an arc to every byte token. The gadget of a merge ``(a, b) -> c``

* removes the arc from ``a`` to ``b``: the merge would have been made;
* adds the state ``c``: what may follow ``b`` may follow ``c`` (as it was before the removal,
  because that ``b`` is used up), and ``c`` may follow what ``a`` may follow (as it is after
  the removal, because the leftmost pair is merged first).

The arcs of 50,000 states are not written out. A gadget is kept as ``(left, right, step)``, and
whether an arc exists is read off the gadgets once and then kept in the transition table.
For every prefix of a word exactly one path is accepted; encoding follows it from state to state, the
longest first, and steps back from places that lead nowhere. Decoding emits the bytes that label the
arcs.

Texts are split first as the vocabulary's pre-tokenizer does; special tokens in a text are
tokens of their own.
"""

from __future__ import annotations

import hashlib
import json
from array import array
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

# The pre-tokenizer's pattern of byte-level BPE.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Words whose tokens a worker keeps in each of two generations, and the longest kept.
CACHED_WORDS = 200_000
CACHED_LENGTH = 64

#: Arcs that a worker keeps.
CACHED_ARCS = 200_000

#: First bytes of a state by which its possible lengths are looked up.
HEAD = 3

#: Characters of a very long text that are split and encoded at a time.
PIECE = 1 << 18


def _byte_alphabet() -> dict[str, int]:
    """The printable characters that stand for bytes in vocabulary files: printable Latin-1
    stands for itself, the other bytes follow from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Automaton:
    """The token automaton of one vocabulary, with its labels and transition table."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        alphabet = _byte_alphabet()
        spelled = lambda token: bytes(alphabet[c] for c in token)
        vocabulary = described["model"]["vocab"]
        self.labels: dict[int, bytes] = {i: spelled(t) for t, i in vocabulary.items()}
        self.special = {t["content"]: t["id"] for t in described.get("added_tokens", [])}
        self.labels |= {i: content.encode() for content, i in self.special.items()}
        #: state -> (left, right, step); bytes have step 0
        self.gadgets: dict[int, tuple[int, int, int]] = {}
        #: removed arcs -> step
        self.removed: dict[tuple[int, int], int] = {}
        self.states: dict[bytes, int] = {}
        for token, state in vocabulary.items():
            if len(token) == 1:
                self._add_byte(state)
        for step, merge in enumerate(described["model"]["merges"], 1):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            self._add_gadget(
                vocabulary[left], vocabulary[right], vocabulary[left + right], step
            )
        #: first bytes -> lengths of the states that begin with them, longest first
        sizes: dict[bytes, set[int]] = {}
        for label in self.states:
            if len(label) >= HEAD:
                sizes.setdefault(label[:HEAD], {2, 1}).add(len(label))
        self.starts = {head: tuple(sorted(some, reverse=True)) for head, some in sizes.items()}
        self.arcs: dict[tuple[int, int], bool] = {}
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        special = "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))
        self.special_pattern = regex.compile(f"({special})") if special else None
        self.pattern = regex.compile(PATTERN)

    def _add_byte(self, state: int) -> None:
        self.gadgets[state] = (state, state, 0)
        self.states[self.labels[state]] = state

    def _add_gadget(self, left: int, right: int, merged: int, step: int) -> None:
        self.removed.setdefault((left, right), step)
        if merged not in self.gadgets:
            self.gadgets[merged] = (left, right, step)
            self.states[self.labels[merged]] = merged

    def arc(self, before: int, after: int) -> bool:
        """Whether the finished automaton has the arc."""
        known = self.arcs.get((before, after))
        if known is None:
            if len(self.arcs) >= CACHED_ARCS:
                self.arcs.clear()
            known = self.arcs[(before, after)] = self._arc_at(before, after, 1 << 60)
        return known

    def _arc_at(self, before: int, after: int, step: int) -> bool:
        """Whether the arc exists once the gadgets up to ``step`` were added.

        It came with the younger of its states, as a copy of an arc of one of the parts.
        """
        while True:
            if self.removed.get((before, after), step + 1) <= step:
                return False
            made_before, made_after = self.gadgets[before][2], self.gadgets[after][2]
            if made_before == made_after == 0:
                return True
            if made_before >= made_after:
                # leaves `before` as it left its right part before the removal
                before, step = self.gadgets[before][1], made_before - 1
                if made_before == made_after:
                    after = self.gadgets[after][0]
            else:
                # enters `after` as it entered its left part after the removal
                after, step = self.gadgets[after][0], made_after

    def path(self, word: bytes) -> list[int]:
        """The accepted path that spells ``word``."""
        whole = self.states.get(word)
        if whole is not None:
            return [whole]
        states, arcs, starts, n = self.states, self.arcs, self.starts, len(word)
        before = None
        # Of every prefix there is one path, so a place that led nowhere once is dead for good.
        found: list[int] = []
        places, dead = [0], set()
        while True:
            at = places[-1]
            for size in starts.get(word[at : at + HEAD], (2, 1)):  # longest state first
                end = at + size
                if end > n or end in dead:
                    continue
                state = states.get(word[at:end])
                if state is None:
                    continue
                if before is None:
                    break
                known = arcs.get((before, state))
                if known or known is None and self.arc(before, state):
                    break
            else:
                dead.add(at)
                places.pop()
                found.pop()
                before = found[-1] if found else None
                continue
            found.append(state)
            before = state
            if end == n:
                return found
            places.append(end)

    def __getitem__(self, word: str) -> bytes:
        """Ids of a pre-split word, as little-endian unsigned 32-bit integers."""
        known = self.words.get(word)
        if known is not None:
            return known
        known = self.older.get(word)
        if known is None:
            known = array("I", self.path(word.encode())).tobytes()
        if len(word) <= CACHED_LENGTH:
            if len(self.words) >= CACHED_WORDS:
                self.older, self.words = self.words, {}
            self.words[word] = known
        return known

    def forget(self) -> None:
        """Give up all kept words and arcs; a worker outlives its task and holds them else."""
        self.words, self.older, self.arcs = {}, {}, {}

    def _plain(self, text: str) -> Iterator[bytes]:
        """Ids of a text without special tokens, piece by piece."""
        if len(text) <= PIECE:
            yield b"".join(map(self.__getitem__, self.pattern.findall(text)))
            return
        held, size = [], 0
        for match in self.pattern.finditer(text):
            held.append(match.group())
            size += len(held[-1])
            if size > PIECE:
                yield b"".join(map(self.__getitem__, held))
                held, size = [], 0
        yield b"".join(map(self.__getitem__, held))

    def encode(self, text: str) -> bytes:
        """Ids of a whole text, as little-endian unsigned 32-bit integers."""
        if self.special_pattern is None:
            return b"".join(self._plain(text))
        parts = []
        for k, part in enumerate(self.special_pattern.split(text)):
            if k % 2:
                parts.append(self.special[part].to_bytes(4, "little"))
            elif part:
                parts.extend(self._plain(part))
        return b"".join(parts)

    def decode(self, ids: bytes) -> str:
        """The text of the arc labels; bytes that are not UTF-8 become U+FFFD."""
        states = array("I", ids)
        return b"".join(map(self.labels.__getitem__, states)).decode("utf-8", "replace")


_automata: dict[str, Automaton] = {}


def automaton(path: str) -> Automaton:
    """The automaton of a vocabulary file, compiled once per worker."""
    if path not in _automata:
        _automata[path] = Automaton(path)
    return _automata[path]


def encode_documents(docs: DataFrame, path: str, keep_ids: bool = False) -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256, decoded_sha256, with ``keep_ids`` also ids.

    ``path`` names a vocabulary file that every executor can read. One pass without a shuffle,
    a text at a time. Null texts count as empty and have no tokens.
    """
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    schema += ", ids array<long>" if keep_ids else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton(path)
        for batch in batches:
            rows: list[tuple] = []
            for text in batch.column("text"):
                ids = machine.encode(text.as_py() or "")
                decoded = machine.decode(ids).encode("utf-8", "surrogatepass")
                rows.append(
                    (
                        len(ids) // 4,
                        hashlib.sha256(ids).hexdigest(),
                        hashlib.sha256(decoded).hexdigest(),
                        array("I", ids).tolist() if keep_ids else None,
                    )
                )
            counts, ids_hash, text_hash, lists = zip(*rows) if rows else ((), (), (), ())
            columns = [
                batch.column("doc_id"),
                pa.array(counts, pa.int64()),
                pa.array(ids_hash, pa.string()),
                pa.array(text_hash, pa.string()),
            ]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if keep_ids:
                columns.append(pa.array(lists, pa.list_(pa.int64())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)
        machine.forget()

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return narrow.mapInArrow(run, schema)
