"""Word hashes and shingle sets of many texts at once, with numpy inside a task.

Words are the maximal runs of bytes other than space and tab to carriage return, after A-Z
is lower-cased.  A word's hash is a 64-bit polynomial over its UTF-8 bytes, taken from one
running sum per piece of text, so no Python code runs per word.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np

LOWER = bytes(range(256)).lower()
SEPARATORS = b" \t\n\r\x0b\x0c"
#: Bytes hashed at once; a task holds about a hundred times as much for it.
PIECE = 256 << 10

_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[list(SEPARATORS)] = True
_GAP = re.compile(b"[" + SEPARATORS + b"]")
_BASE = 0x9E3779B97F4A7C15
_LETTER = np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.uint64)
_PLACE = np.random.default_rng(20240608).integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)
_powers: tuple[np.ndarray, np.ndarray] = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _power_tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) < size:
        inverse = pow(_BASE, -1, 1 << 64)
        tables = []
        for factor in (_BASE, inverse):
            steps = np.full(size, factor, np.uint64)
            steps[0] = 1
            tables.append(np.multiply.accumulate(steps))
        _powers = (tables[0], tables[1])
    return _powers


def _hash_block(block: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of ``block``, and where each word starts."""
    data = np.frombuffer(b" " + block + b" ", np.uint8)
    gap = _SEPARATOR[data]
    starts = np.flatnonzero(gap[:-1] & ~gap[1:]) + 1
    ends = np.flatnonzero(~gap[:-1] & gap[1:]) + 1
    power, inverse = _power_tables(len(data))
    sums = np.cumsum(_LETTER[data] * power[: len(data)], dtype=np.uint64)
    hashes = (sums[ends - 1] - sums[starts - 1]) * inverse[starts]
    return mix(hashes + (ends - starts).astype(np.uint64)), starts - 1


def _pieces(text: bytes) -> Iterator[bytes]:
    begin = 0
    while len(text) - begin > PIECE:
        cut = _GAP.search(text, begin + PIECE)
        if cut is None:
            break
        yield text[begin : cut.start()]
        begin = cut.end()
    yield text[begin:] if begin else text


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts in order, and the place of each text's first word (one more at the end)."""
    hashes: list[np.ndarray] = []
    counts = np.zeros(len(texts), np.int64)
    held: list[bytes] = []
    owners: list[int] = []
    held_bytes = 0

    def flush() -> None:
        nonlocal held, owners, held_bytes
        if not held:
            return
        found, starts = _hash_block(b" ".join(held))
        bounds = np.cumsum([0] + [len(p) + 1 for p in held])
        np.add.at(counts, owners, np.diff(np.searchsorted(starts, bounds)))
        hashes.append(found)
        held, owners, held_bytes = [], [], 0

    for i, text in enumerate(texts):
        if not text:
            continue
        for piece in _pieces(text.encode("utf-8", "replace").translate(LOWER)):
            if held_bytes + len(piece) > PIECE:
                flush()
            held.append(piece)
            owners.append(i)
            held_bytes += len(piece) + 1
    flush()
    return (np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)), np.concatenate([[0], np.cumsum(counts)])


def shingle_sets(texts: list[str | None], size: int) -> list[np.ndarray]:
    """Sorted distinct hashes of the runs of ``size`` words of each text; a shorter text is one run."""
    hashes, offsets = word_hashes(texts)
    runs = np.zeros(max(len(hashes) - size + 1, 0), np.uint64)
    for place in range(size):
        runs += hashes[place : place + len(runs)] * _PLACE[place]
    runs = mix(runs)
    sets = []
    for begin, end in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        if end - begin >= size:
            sets.append(np.unique(runs[begin : end - size + 1]))
        elif end > begin:
            whole = np.sum(hashes[begin:end] * _PLACE[: end - begin], dtype=np.uint64)
            sets.append(mix(np.array([whole + np.uint64(end - begin)], np.uint64)))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets
