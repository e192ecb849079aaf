"""Hashed word shingles of whole texts, vectorised over the bytes of an Arrow batch.

Words are ``[^\\x20\\x09-\\x0D]+`` after A-Z became a-z. A word is hashed as a polynomial over
random byte values, modulo 2^64, taken as a difference of running sums; five word hashes make
a shingle hash of 64 bits. All delimiters are single bytes in UTF-8, so no text is decoded.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Words in a shingle.
WIDTH = 5

#: Bytes hashed at a time; a longer document is taken in several pieces.
PIECE = 1 << 18

_U64 = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64 (public domain)."""
    x = (x ^ (x >> _U64(30))) * _U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U64(27))) * _U64(0x94D049BB133111EB)
    return x ^ (x >> _U64(31))


def seeded(seed: int, n: int) -> np.ndarray:
    """``n`` fixed 64-bit numbers."""
    start = _U64((seed * 0x9E3779B97F4A7C15) % 2**64)
    step = _U64(0xD1B54A32D192ED03)
    return _mix(start + step * np.arange(1, n + 1, dtype=_U64))


def _byte_values() -> np.ndarray:
    values = seeded(1, 256)
    values[65:91] = values[97:123]
    return values


_VALUES = _byte_values()
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x5851F42D4C957F2D  # odd, hence invertible modulo 2^64
_BASE_INVERSE = pow(_BASE, -1, 2**64)
_WEIGHTS = seeded(2, WIDTH) | _U64(1)
_powers: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers["up"]) < n:
        size = max(n, PIECE + 1)
        for name, base in (("up", _BASE), ("down", _BASE_INVERSE)):
            steps = np.full(size, _U64(base))
            steps[0] = 1
            _powers[name] = np.cumprod(steps, dtype=_U64)
    return _powers["up"], _powers["down"]


def _words_of_piece(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words in a piece and the byte at which each starts."""
    solid = np.zeros(len(data) + 2, bool)
    solid[1:-1] = ~_IS_SPACE[data]
    edges = np.flatnonzero(solid[1:] != solid[:-1])
    starts, ends = edges[0::2], edges[1::2]
    up, down = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, _U64)
    np.cumsum(_VALUES[data] * up[: len(data)], out=sums[1:])
    return _mix((sums[ends] - sums[starts]) * down[starts]), starts


def word_hashes(data: np.ndarray) -> np.ndarray:
    """Hashes of the words of one text, given as bytes."""
    if len(data) <= PIECE:
        return _words_of_piece(data)[0]
    parts, at = [], 0
    while at < len(data):
        end = min(at + PIECE, len(data))
        if end < len(data):
            spaces = np.flatnonzero(_IS_SPACE[data[at:end]])
            # a piece ends at white space; a word longer than a piece is taken whole
            while not len(spaces) and end < len(data):
                spaces = np.flatnonzero(_IS_SPACE[data[end : end + PIECE]]) + (end - at)
                end = min(end + PIECE, len(data))
            end = at + int(spaces[-1]) + 1 if len(spaces) else len(data)
        parts.append(_words_of_piece(data[at:end])[0])
        at = end
    return np.concatenate(parts)


def shingle_set(words: np.ndarray) -> np.ndarray:
    """Sorted distinct shingle hashes; fewer than five words make one shingle, none make none."""
    n = len(words)
    if not n:
        return np.empty(0, _U64)
    width = min(n, WIDTH)
    total = np.full(n - width + 1, _U64(width * 0xA24BAED4963EE407 % 2**64))
    for k in range(width):
        total += words[k : n - width + 1 + k] * _WEIGHTS[k]
    return np.unique(_mix(total))


def texts_of(column: pa.Array) -> Iterator[np.ndarray | None]:
    """The UTF-8 bytes of each text in an Arrow string column, without copies; None for null."""
    if pa.types.is_large_string(column.type):
        width = np.int64
    else:
        width = np.int32
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, width)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    nulls = column.is_null().to_numpy(zero_copy_only=False)
    for k in range(len(column)):
        yield None if nulls[k] else raw[ends[k] : ends[k + 1]]


def word_groups(column: pa.Array) -> Iterator[np.ndarray]:
    """Word hashes of each text in a column; short texts are hashed together, PIECE at a time."""
    pending: list[np.ndarray] = []
    held = 0

    def flush():
        if not pending:
            return
        gap = np.array([32], np.uint8)
        joined = np.concatenate([x for text in pending for x in (text, gap)])
        hashes, starts = _words_of_piece(joined)
        bounds = np.cumsum([len(text) + 1 for text in pending])
        cuts = np.searchsorted(starts, bounds)
        at = 0
        for cut in cuts:
            yield hashes[at:cut]
            at = cut
        pending.clear()

    for text in texts_of(column):
        text = np.empty(0, np.uint8) if text is None else text
        if len(text) > PIECE // 4:
            yield from flush()
            held = 0
            yield word_hashes(text)
            continue
        if held + len(text) + 1 > PIECE:
            yield from flush()
            held = 0
        pending.append(text)
        held += len(text) + 1
    yield from flush()


def digest_of(shingles: np.ndarray) -> bytes | None:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if len(shingles) else None
