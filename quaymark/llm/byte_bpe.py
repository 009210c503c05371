"""Byte-level BPE encoding and decoding by replaying merges over the words of a corpus.

Encoding.  A task takes its texts ``PIECE`` bytes at a time (a longer text a bounded number of
words at a time), splits them into words with the vocabulary's pattern, and encodes each
distinct word once.  About ``CHAIN`` bytes of new words lie in one chain of byte tokens, which
takes about 170 times as much memory; an inverted index names, for each merge rank, the places whose
token pair merges at that rank.  The lowest rank is taken first, its places from left to
right, and a merge looks only at the two pairs it touches; a new pair of a lower rank is
done before anything else.  Encoded words are kept for the task's next pieces, up to about
``REMEMBERED`` of them and ``REMEMBERED_CHARACTERS`` in all.  Nothing is shuffled: a word that two tasks meet is encoded twice,
which costs less than moving every occurrence.

Defined results: null and empty texts have no tokens; special tokens are ordinary text; a
word that is itself in the vocabulary is that token.  Ids outside the vocabulary fail in
decoding.  Columns other than the text pass through; a column named as a result is
replaced.
"""

from __future__ import annotations

import base64
import heapq
import sys
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from quaymark.llm.batches import bound_batches, map_texts

#: Bytes of text split at once.
PIECE = 512 << 10
#: Bytes of new words merged at once; a longer word lies in a chain of its own.
CHAIN = 128 << 10
REMEMBERED = 300_000
REMEMBERED_CHARACTERS = 8 << 20
MOST_VOCABULARY = 1 << 20


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens and ranks of a rank file: one base64 token and its rank per line."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}
    if len(ranks) > MOST_VOCABULARY:
        raise ValueError(f"a vocabulary of {len(ranks)} tokens is too large to send to every task")
    return ranks


@dataclass
class Merges:
    """A vocabulary as merges: the token of each byte, and the token that each mergeable pair becomes."""

    ranks: dict[bytes, int]
    byte_tokens: np.ndarray
    byte_pairs: np.ndarray
    pairs: dict[int, int]


def merges_of(ranks: dict[bytes, int]) -> Merges:
    """Every way to put a token together from two others."""
    pairs = {}
    for token, rank in ranks.items():
        for cut in range(1, len(token)):
            left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
            if left is not None and right is not None:
                pairs[left * MOST_VOCABULARY + right] = rank
    byte_pairs = np.full(1 << 16, -1, np.int64)
    for token, rank in ranks.items():
        if len(token) == 2:
            byte_pairs[token[0] * 256 + token[1]] = rank
    return Merges(ranks, np.array([ranks[bytes([b])] for b in range(256)], np.int64), byte_pairs, pairs)


def replay(words: list[bytes], merges: Merges) -> list[bytes]:
    """The token ids of each word, as packed 32-bit integers."""
    if not words:
        return []
    whole = [merges.ranks.get(word) for word in words]
    split = [word for word, token in zip(words, whole) if token is None]
    ends = np.cumsum([len(word) for word in split], dtype=np.int64)
    packed, bounds = b"", [0]
    if len(ends) and ends[-1]:
        tokens = _merged(np.frombuffer(b"".join(split), np.uint8), ends, merges)
        alive = tokens >= 0
        packed = tokens[alive].astype(np.int32).tobytes()
        bounds = [0, *(4 * np.cumsum(alive)[ends - 1]).tolist()]
    elif len(ends):
        bounds = [0] * (len(ends) + 1)
    slots = zip(bounds[:-1], bounds[1:])
    parts = (packed[a:b] for a, b in slots)
    return [next(parts) if token is None else token.to_bytes(4, sys.byteorder) for token in whole]


def _merged(data: np.ndarray, ends: np.ndarray, merges: Merges) -> np.ndarray:
    """One chain of byte tokens after all merges; a token that went into the one before it is -1."""
    size, get = len(data), merges.pairs.get
    starts = np.concatenate([[0], ends[:-1]])[np.diff(ends, prepend=0) > 0]
    lasts = ends[np.diff(ends, prepend=0) > 0] - 1
    before, after = np.arange(-1, size - 1), np.arange(1, size + 1)
    before[starts], after[lasts] = -1, -1
    rank_at = np.full(size, -1, np.int64)
    rank_at[:-1] = merges.byte_pairs[data[:-1].astype(np.int64) * 256 + data[1:]]
    rank_at[lasts] = -1
    # The inverted index: for each rank, the places of its pairs from left to right.
    found = np.flatnonzero(rank_at >= 0)
    found = found[np.argsort(rank_at[found], kind="stable")]
    ranks, first = np.unique(rank_at[found], return_index=True)
    places = {rank: part.tolist() for rank, part in zip(ranks.tolist(), np.split(found, first[1:]))}
    waiting = sorted(places)
    token = merges.byte_tokens[data].tolist()
    before, after, rank_at = before.tolist(), after.tolist(), rank_at.tolist()
    while waiting:
        rank = heapq.heappop(waiting)
        todo = places.pop(rank)
        todo.sort()
        for done, i in enumerate(todo, 1):
            if rank_at[i] != rank:
                continue  # an earlier merge took one of the two
            j = after[i]
            token[i], token[j], rank_at[j] = rank, -1, -1
            after[i] = k = after[j]
            lowest = rank
            if k >= 0:
                before[k] = i
                rank_at[i] = new = get(rank * MOST_VOCABULARY + token[k], -1)
                if new >= 0:
                    lowest = min(lowest, new)
                    if new in places:
                        places[new].append(i)
                    else:
                        places[new] = [i]
                        heapq.heappush(waiting, new)
            else:
                rank_at[i] = -1
            b = before[i]
            if b >= 0:
                rank_at[b] = new = get(token[b] * MOST_VOCABULARY + rank, -1)
                if new >= 0:
                    lowest = min(lowest, new)
                    if new in places:
                        places[new].append(b)
                    else:
                        places[new] = [b]
                        heapq.heappush(waiting, new)
            if lowest < rank and done < len(todo):
                # A pair of a lower rank came up: it goes before the rest of this rank.
                places[rank] = todo[done:]
                heapq.heappush(waiting, rank)
                break
    return np.array(token, np.int64)


def _chains(words: list[str]) -> Iterator[tuple[list[str], list[bytes]]]:
    """The words with their bytes, about ``CHAIN`` bytes at a time."""
    some, packed, size = [], [], 0
    for word in words:
        data = word.encode("utf-8")
        if some and size + len(data) > CHAIN:
            yield some, packed
            some, packed, size = [], [], 0
        some.append(word)
        packed.append(data)
        size += len(data)
    if some:
        yield some, packed


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, column: str = "text") -> DataFrame:
    """``docs`` with ``ids array<int>`` in place of ``column``."""
    bound_batches(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(merges_of(ranks))
    split = regex.compile(pattern)
    known: dict[str, bytes] = {}
    known_characters = 0

    def pack(lines: list[list[str]]) -> list[bytes]:
        nonlocal known_characters
        if len(known) > REMEMBERED or known_characters > REMEMBERED_CHARACTERS:
            known.clear()
            known_characters = 0
        for new, data in _chains(list(set().union(*lines).difference(known))):
            known.update(zip(new, replay(data, held.value)))
            known_characters += sum(map(len, new))
        return [b"".join(map(known.__getitem__, line)) for line in lines]

    def pack_long(text: str) -> bytes:
        found = (match.group() for match in split.finditer(text))
        return b"".join(pack([line])[0] for line in iter(lambda: list(islice(found, PIECE // 4)), []))

    def run(texts: list[str | None]) -> dict:
        if len(texts) == 1 and len(texts[0] or "") > PIECE:
            packed = [pack_long(texts[0])]
        else:
            packed = pack([split.findall(text) if text else [] for text in texts])
        offsets = np.concatenate([[0], np.cumsum([len(p) // 4 for p in packed])]).astype(np.int32)
        return {"ids": pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(packed), np.int32)))}

    others = [c for c in docs.columns if c != "ids"]
    return map_texts(docs.select(*others), run, "ids array<int>", column, PIECE)


def decode(encoded: DataFrame, ranks: dict[bytes, int], column: str = "ids") -> DataFrame:
    """``encoded`` with ``decoded binary``, the bytes that its ids stand for; null ids give no bytes."""
    tokens: list[bytes | None] = [None] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    held = encoded.sparkSession.sparkContext.broadcast(tokens)
    others = [c for c in encoded.columns if c != "decoded"]
    out = encoded.select(*others).schema.add("decoded", "binary")

    def run(batches):
        for batch in batches:
            table, lists = held.value, batch.column(column)
            ids, ends, there = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy(), lists.is_valid().to_pylist()
            if len(ids) and not ids.min() >= 0:
                raise ValueError("ids have to be numbers of tokens")
            for place in range(0, batch.num_rows, 256):
                part = batch.slice(place, 256)
                made = [b"".join(map(table.__getitem__, ids[ends[i] : ends[i + 1]].tolist())) if there[i] else b"" for i in range(place, place + part.num_rows)]
                arrays = [*part.columns, pa.array(made, pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, names=out.names)

    return encoded.select(*others).mapInArrow(run, out)
