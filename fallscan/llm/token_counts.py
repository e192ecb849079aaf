"""Edit-aware token counts: a segment tree over the pre-tokens of each document.

Leaves hold runs of pre-tokens (the pieces that byte-level BPE splits a text into) with their
characters and tokens; inner nodes hold the sums of their subtrees. An edit finds the leaves it
touches by character offsets, splits and encodes the text again only there, and updates the
sums on the way up. A little more than the edit is split again: a pre-token depends on its own
characters and at most ``LOOKAHEAD`` after it, so the work starts at the last pre-token that
ends far enough before the edit, and it ends where the new boundaries meet an old one behind
the edit, because splitting looks only ahead.

A document is one row, so the tree of a text is built and used within one call; what leaves it
are sums. Edits come as an array per document, pre-aggregated by document, and apply in order,
each to the text that the edits before it left.

Defined cases: null texts count as empty; an edit beyond the end is clamped to it; a null edit
list and a null edit in a list change nothing; a null start means the end of the text, a null stop
an insertion, a null insert nothing inserted; rows that repeat a doc_id are counted each with their
own edits; a very long text is one tree, kept as its pre-tokens; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from fallscan.llm.bpe import Automaton, automaton

#: Pre-tokens in a fresh leaf; a leaf is split when it grows beyond twice as many.
LEAF = 32

#: Characters behind a pre-token that its end can depend on.
LOOKAHEAD = 3

EDITS = "array<struct<start:int,stop:int,insert:string>>"


class Pieces(dict):
    """Pre-token -> (pre-token, tokens), one object per word however often texts repeat it."""

    MOST, LONGEST = 200_000, 64

    def __init__(self, machine: Automaton):
        super().__init__()
        self.machine = machine

    def __missing__(self, word: str) -> tuple[str, int]:
        piece = (word, len(self.machine[word]) // 4)
        if len(word) <= self.LONGEST:
            if len(self) >= self.MOST:
                self.clear()
            self[word] = piece
        return piece


class Tree:
    """Pre-tokens of one text in leaves under a binary tree of (characters, tokens) sums.

    ``pieces`` may be shared by the trees of many texts.
    """

    def __init__(self, text: str, machine: Automaton, pieces: Pieces | None = None):
        self.machine = machine
        self.piece = (Pieces(machine) if pieces is None else pieces).__getitem__
        self.encoded = 0  # pre-tokens encoded so far
        pieces = self._encode(text)
        self.leaves = [pieces[k : k + LEAF] for k in range(0, len(pieces), LEAF)] or [[]]
        self._build()

    def _encode(self, text: str) -> list[tuple[str, int]]:
        """(pre-token, tokens) of a text; a special token is one of its own."""
        machine = self.machine
        parts = machine.special_pattern.split(text) if machine.special_pattern else [text]
        found: list[tuple[str, int]] = []
        for k, part in enumerate(parts):
            if k % 2:
                found.append((part, 1))
            elif part:
                found.extend(map(self.piece, machine.pattern.findall(part)))
        self.encoded += len(found)
        return found

    def _build(self) -> None:
        size = 1
        while size < len(self.leaves):
            size *= 2
        self.size = size
        self.sums = [(0, 0)] * (2 * size)
        for k, leaf in enumerate(self.leaves):
            self.sums[size + k] = self._sum(leaf)
        for k in range(size - 1, 0, -1):
            self._pull(k)

    @staticmethod
    def _sum(leaf: list[tuple[str, int]]) -> tuple[int, int]:
        return sum([len(w) for w, _ in leaf]), sum([n for _, n in leaf])

    def _pull(self, k: int) -> None:
        (a, b), (c, d) = self.sums[2 * k], self.sums[2 * k + 1]
        self.sums[k] = (a + c, b + d)

    @property
    def characters(self) -> int:
        return self.sums[1][0]

    @property
    def tokens(self) -> int:
        return self.sums[1][1]

    def text(self) -> str:
        return "".join(w for leaf in self.leaves for w, _ in leaf)

    def find(self, offset: int) -> tuple[int, int]:
        """(leaf, offset at which it starts) of the leaf that holds a character."""
        k, start = 1, 0
        while k < self.size:
            left = self.sums[2 * k][0]
            # past the last character: the last leaf in use
            if offset < start + left or k * 2 + 1 >= 2 * self.size or not self._used(2 * k + 1):
                k = 2 * k
            else:
                start += left
                k = 2 * k + 1
        return k - self.size, start

    def _used(self, k: int) -> bool:
        while k < self.size:
            k *= 2
        return k - self.size < len(self.leaves)

    def edit(self, start: int, stop: int, insert: str) -> None:
        """Replace the characters from start to stop."""
        total = self.characters
        start = min(max(start, 0), total)
        stop = min(max(stop, start), total)
        special = max((len(s) for s in self.machine.special), default=0)
        # an edit can complete or break a special token that begins before it
        reach = max(LOOKAHEAD, special)
        first, at = self.find(max(start - reach, 0))
        begin = at
        kept: list[tuple[str, int]] = []  # pre-tokens of the first leaf before the work
        for place, (word, n) in enumerate(self.leaves[first]):
            if begin + len(word) + reach > start:
                break
            kept.append((word, n))
            begin += len(word)
        while not kept and first > 0 and begin + reach > start:
            # the work starts at a boundary that was found before the edit could matter
            first -= 1
            begin -= self.sums[self.size + first][0]
            at = begin
            for word, n in self.leaves[first]:
                if begin + len(word) + reach > start:
                    break
                kept.append((word, n))
                begin += len(word)
        old = [piece for piece in self.leaves[first][len(kept) :]]
        held = begin + sum(len(w) for w, _ in old)
        last = first
        while held < stop and last + 1 < len(self.leaves):
            last += 1
            old.extend(self.leaves[last])
            held += self.sums[self.size + last][0]
        while True:
            fresh, rest = self._rework(old, begin, start, stop, insert)
            if rest is not None or last + 1 >= len(self.leaves):
                break
            last += 1
            old.extend(self.leaves[last])
        self._replace(first, last, kept + fresh + (rest or []))

    def _rework(self, old, begin, start, stop, insert):
        """(new pre-tokens, old ones that stay) of the reworked run; the second is None if no
        old boundary was met before its end."""
        source = "".join(w for w, _ in old)
        changed = source[: start - begin] + insert + source[stop - begin :]
        shift = len(insert) - (stop - start)
        ends, at = {}, begin
        for k, (word, _) in enumerate(old):
            at += len(word)
            ends[at + shift] = k + 1
        least = start + len(insert)
        pieces = self._encode(changed)
        done = begin
        # the last pieces may still depend on what follows the run
        safe = begin + len(changed) - max(LOOKAHEAD, max(map(len, self.machine.special), default=0))
        for k, (word, _) in enumerate(pieces):
            done += len(word)
            if least <= done <= safe and done in ends:
                return pieces[: k + 1], old[ends[done] :]
        return pieces, None

    def _replace(self, first: int, last: int, pieces: list[tuple[str, int]]) -> None:
        n_old = last - first + 1
        if len(pieces) <= 2 * LEAF * n_old:
            step = max(-(-len(pieces) // n_old), 1)
            for k in range(n_old):
                leaf = pieces[k * step : (k + 1) * step]
                self.leaves[first + k] = leaf
                self.sums[self.size + first + k] = self._sum(leaf)
            changed = {(self.size + first + k) // 2 for k in range(n_old)}
            while changed and 0 not in changed:
                for k in changed:
                    self._pull(k)
                changed = {k // 2 for k in changed}
        else:
            self.leaves[first : last + 1] = [
                pieces[k : k + LEAF] for k in range(0, len(pieces), LEAF)
            ]
            self._build()


def sample_edits(text: Column) -> Column:
    """Three edits of a text by its own length and words: an insertion after a third, a
    replacement in the middle, a deletion before the end."""
    n = F.length(text)
    third, half, late = F.floor(n / 3), F.floor(n / 2), F.floor(n * 4 / 5)
    word = F.substring_index(text, " ", 1)
    edit = lambda a, b, s: F.struct(
        a.cast("int").alias("start"), b.cast("int").alias("stop"), s.alias("insert")
    )
    return F.array(
        edit(third, third, F.concat(F.lit(" "), F.substring(word, 1, 40), F.lit("'s 42"))),
        edit(half, half + 7, F.lit("re\n\n  new")),
        edit(late, late + F.least(F.floor(n / 10), F.lit(50)), F.lit("")),
    )


def count_edited(docs: DataFrame, path: str, edits: str = "edits") -> DataFrame:
    """Per document: doc_id, n_tokens, n_chars before and after the edits in column ``edits``
    (see EDITS), n_pretokens of the text and n_reencoded, the pre-tokens encoded for the edits."""
    schema = (
        "doc_id long, n_tokens long, n_chars long, n_pretokens long, edited_tokens long, "
        "edited_chars long, n_reencoded long"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton(path)
        pieces = Pieces(machine)
        for batch in batches:
            rows = []
            for text, changes in zip(batch.column("text"), batch.column("edits")):
                tree = Tree(text.as_py() or "", machine, pieces)
                before = (tree.tokens, tree.characters, tree.encoded)
                for change in changes.as_py() or ():
                    if change is None:
                        continue
                    start = tree.characters if change["start"] is None else change["start"]
                    stop = start if change["stop"] is None else change["stop"]
                    tree.edit(start, stop, change["insert"] or "")
                rows.append(
                    (*before, tree.tokens, tree.characters, tree.encoded - before[2])
                )
            columns = zip(*rows) if rows else ((),) * 6
            names = [f.split()[0] for f in schema.split(", ")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in columns)], names
            )

    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "text",
        F.col(edits).cast(EDITS).alias("edits"),
    )
    return narrow.mapInArrow(run, schema)
