"""Language-model scoring with a log-frequency Bloom filter.

Method.  Counts of words and of word pairs are quantised to levels (a level is a power of
``BASE``), and a word or pair of level q enters a Bloom filter q times, once with each level
up to q.  The filter is sent to every task; a count comes back by probing level after level
until one is missing.  A pair is probed only if both its words are known, and counts for no
more than they do, which removes most false answers.  The score interpolates:
``P(w | v) = (c(v, w) + GAMMA * P(w)) / (c(v) + GAMMA)``, with the context's count rounded up
to its level's end and all others down, so that the model never gives out more than one.

The filter has ten to twenty bits an entry at every size and holds all words and pairs.  It is
split by segments of the hash: as many segments as ``MOST_BITS`` bits hold are sent to every
task, or none where that is a small share.  Keys of the other segments are asked for: their
levels come back from the segment's block of the filter.  Which segments are sent changes the
work only, not a score.

The base score needs exact counts of every word.  Words with more than a millionth of all
training tokens, at most a million by definition, are sent to every task with their levels; the
others are asked for.  A piece, some megabytes of text, sends each distinct key that it lacks once
to the key's segment, packed; the answers meet the piece's packed tokens.  Both are shuffled only,
not written besides, and pieces are named by their place and tokens, so that a task run again after a loss sends the same.
A segment gets a packet from nearly every piece, so packets are made and read many at once,
and a segment's keys are looked up together.

Counts are collected alike: a task counts some megabytes of text, sorts its hashes
and packs them by segments, so a frequent word is one entry a task.  The number of segments
grows with the text.  The merged counts are deleted once the filter is written.

Words are 64-bit hashes, pairs 48-bit ones in their segments; the rate of equal hashes is far
below the filter's error.

Defined results: a null or empty text is its end token alone; the end token is counted like a
word; ids, also null or repeated ones, pass through with all rows, other columns do not;
with no training text every probability is the base formula's, 1.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, functions as F

from quaymark.llm.batches import bound_batches, slices
from quaymark.llm.text import mix, word_hashes
from quaymark.session import materialize, scratch_path, shuffles_dropped
from quaymark.sinks.storage import delete

BASE = 1.5
GAMMA = 10.0
HASHES = 4
BITS_PER_ENTRY = 10
MOST_BITS = 1 << 29
LEAST_SHARE = 8
LEVELS = 64
#: Keys looked at together in a filter, so few that what is computed for them stays in the processor's cache.
AT_ONCE = 1 << 14
FREQUENT = 1_000_000
COUNT_CHARS = 8 << 20
SCORE_CHARS = 3 << 20
SEGMENT_CHARS = 16 << 20
#: Packed keys of a segment that are answered at once, about a million.
ANSWER_BYTES = 4 << 20
LEAST_SEGMENTS = 64

END = np.uint64(0x2545F4914F6CDD1D)
START = np.uint64(0x9E6C63D0876A9A47)
_PAIR = (np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F))
_PROBE = np.random.default_rng(99).integers(1, 2**63, HASHES, dtype=np.uint64) | np.uint64(1)


@dataclass
class Filter:
    bits: np.ndarray
    block: int
    held: int
    segments: int
    tokens: int
    words: int
    frequent: np.ndarray
    frequent_counts: np.ndarray
    frequent_levels: np.ndarray


@dataclass
class Model:
    filter: Broadcast
    table: DataFrame
    segments: int
    tokens: int
    words: int


def _pack(values: np.ndarray) -> bytes:
    """The number of bytes that the largest value needs, then the lowest byte of each value, the next one of each, and so on.

    Bytes of a kind lie together, so that the highest, mostly zeros, shrink when Spark compresses them.
    """
    width = max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 1
    return bytes([width]) + values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.copy().tobytes()


def _pack_parts(values: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    """``_pack`` of each part of the values; no part is empty."""
    if not len(values):
        return []
    widths = [max(1, (most.bit_length() + 7) // 8) for most in np.maximum.reduceat(values, bounds[:-1]).tolist()]
    raw = values.astype("<u8", copy=False).view(np.uint8).reshape(-1, 8)
    planes = [raw[:, i].tobytes() for i in range(max(widths))]
    ends = bounds.tolist()
    return [b"".join([bytes([w]), *[plane[a:b] for plane in planes[:w]]]) for a, b, w in zip(ends[:-1], ends[1:], widths)]


def _unpack_parts(packets: list[bytes], skip: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The values of packed parts one after another, and where each part begins (one more at the end)."""
    widths = [p[skip] for p in packets]
    sizes = [(len(p) - skip - 1) // w for p, w in zip(packets, widths)]
    bounds = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    whole, nothing = np.zeros((bounds[-1], 8), np.uint8), bytes(max(sizes, default=0))
    for i in range(max(widths, default=0)):
        at = skip + 1
        plane = [p[at + i * n : at + i * n + n] if i < w else nothing[:n] for p, n, w in zip(packets, sizes, widths)]
        whole[:, i] = np.frombuffer(b"".join(plane), np.uint8)
    return whole.view("<u8").ravel(), bounds


def _unpack(packed: bytes) -> np.ndarray:
    return _unpack_parts([packed])[0]


def _pack_sorted(keys: np.ndarray) -> bytes:
    """The first key, and steps to each sorted key from the one before; low 16 bits are left out where no key has any."""
    return _pack_sorted_parts(keys, np.array([0, len(keys)]))[0]


def _pack_sorted_parts(keys: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    """``_pack_sorted`` of each part of the keys; no part is empty."""
    shift = 0 if (keys & np.uint64(0xFFFF)).any() else 16
    short = keys >> np.uint64(shift)
    steps = np.diff(short, prepend=short[:1])
    steps[bounds[:-1]] = 0
    firsts = short[bounds[:-1]].astype("<u8").tobytes()
    return [bytes([shift]) + firsts[8 * i : 8 * i + 8] + packed for i, packed in enumerate(_pack_parts(steps, bounds))]


def _unpack_sorted_parts(packets: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The keys of packed parts one after another, and where each part begins (one more at the end)."""
    steps, bounds = _unpack_parts(packets, skip=9)
    if not len(steps):
        return steps, bounds
    keys = np.cumsum(steps, dtype=np.uint64)
    sizes = np.diff(bounds)
    firsts = np.frombuffer(b"".join([p[1:9] for p in packets]), "<u8").astype(np.uint64)
    keys += np.repeat(firsts - keys[bounds[:-1]], sizes)
    shifts = np.array([p[0] for p in packets], np.uint64)
    return keys << (shifts[0] if (shifts == shifts[0]).all() else np.repeat(shifts, sizes)), bounds


def _unpack_sorted(packed: bytes) -> np.ndarray:
    return _unpack_sorted_parts([packed])[0]


def _distinct(keys: np.ndarray) -> np.ndarray:
    """Sorted distinct keys; ``np.unique`` alone goes through a hash table, which takes many times as long."""
    keys = np.sort(keys)
    return keys[np.flatnonzero(np.diff(keys, prepend=~keys[:1]))]


def _segment_of(keys: np.ndarray, segments: int) -> np.ndarray:
    return (keys >> np.uint64(64 - int(math.log2(segments)))).astype(np.int64)


def _first_of(keys: np.ndarray, segment: int, segments: int) -> int:
    """Where the segment begins among sorted keys."""
    return len(keys) if segment >= segments else int(np.searchsorted(keys, np.uint64(segment << (64 - int(math.log2(segments))))))


def _cuts(keys: np.ndarray, segments: int) -> tuple[list[int], np.ndarray]:
    """The segments that have any of the sorted keys, and where each begins (one more at the end)."""
    lowest = np.arange(segments, dtype=np.uint64) << np.uint64(64 - int(math.log2(segments)))
    bounds = np.append(np.searchsorted(keys, lowest), len(keys))
    found = np.flatnonzero(np.diff(bounds))
    return found.tolist(), np.append(bounds[found], len(keys))


def _tokens(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens with an end after each text, and the offsets of the texts."""
    hashes, offsets = word_hashes(texts)
    ends = offsets[1:] + np.arange(len(texts))
    tokens = np.empty(len(hashes) + len(texts), np.uint64)
    is_end = np.zeros(len(tokens), bool)
    is_end[ends] = True
    tokens[is_end] = END
    tokens[~is_end] = hashes
    return tokens, np.concatenate([[0], ends + 1])


def _contexts(tokens: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    before = np.concatenate([[START], tokens[:-1]])
    before[offsets[:-1]] = START
    return before


def _pair_keys(before: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """48-bit keys of word pairs, in the upper bits."""
    return mix(before * _PAIR[0] + tokens * _PAIR[1] + np.uint64(1)) & np.uint64(0xFFFFFFFFFFFF0000)


def _levels(counts: np.ndarray) -> np.ndarray:
    return np.minimum(1 + np.floor(np.log(counts.astype(float)) / math.log(BASE) + 1e-9), LEVELS).astype(np.int64)


def _count(segments: int):
    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in slices(batches, "text", COUNT_CHARS):
            tokens, offsets = _tokens(part["text"].tolist())
            rows: dict[int, list] = {}
            for place, keys in ((0, tokens), (2, _pair_keys(_contexts(tokens, offsets), tokens))):
                keys, counts = np.unique(keys, return_counts=True)
                found, bounds = _cuts(keys, segments)
                for s, packed, amounts in zip(found, _pack_sorted_parts(keys, bounds), _pack_parts(counts, bounds)):
                    rows.setdefault(s, [None] * 4)[place : place + 2] = packed, amounts
            yield pd.DataFrame([(s, *row) for s, row in rows.items()], columns=["segment", "words", "counts", "pairs", "levels"])

    return run


def _merge(part: pd.DataFrame) -> pd.DataFrame:
    """Total counts of one segment; pairs keep their level only."""
    row: dict[str, list] = {"segment": [part["segment"].iloc[0]]}
    per_level = np.zeros(LEVELS + 1, np.int64)
    for kind, amounts in (("words", "counts"), ("pairs", "levels")):
        keys, _ = _unpack_sorted_parts(part[kind].dropna().tolist())
        counts, _ = _unpack_parts(part[amounts].dropna().tolist())
        order = np.argsort(keys)
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.diff(keys, prepend=~keys[:1]))
        keys, counts = keys[first], np.add.reduceat(counts, first) if len(first) else counts
        levels = _levels(counts)
        per_level += np.bincount(levels, minlength=LEVELS + 1)
        if kind == "words":
            row |= {"n": [len(keys)], "total": [int(counts.sum())]}
        else:
            counts = levels.astype(np.uint64)
        row |= {kind: [_pack_sorted(keys) if len(keys) else None], amounts: [_pack(counts) if len(keys) else None]}
    return pd.DataFrame(row | {"per_level": [per_level.tolist()]})


def _positions(keys: np.ndarray, level: int, which: int, block: int) -> np.ndarray:
    """The bit of each key at one level and hash, inside the block of the key's segment; a block's size is a power of two."""
    return (mix(keys * _PROBE[which] + np.uint64(level)) & np.uint64(block - 1)).view(np.int64)


def _build(segments: int, block: int, line: float):
    """For each segment its filter block and its words, with levels of those that occur more than ``line`` times."""

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            for segment, *packed in part[["segment", "words", "counts", "pairs", "levels"]].itertuples(index=False):
                made = np.zeros(block, bool)
                words, counts, pairs, levels = _some(packed[0]), _amounts(packed[1]), _some(packed[2]), _amounts(packed[3])
                for keys, held in ((words, _levels(counts)), (pairs, levels.astype(np.int64))):
                    for level in range(1, int(held.max(initial=0)) + 1):
                        keys, held = keys[held >= level], held[held >= level]
                        for a in range(0, len(keys), AT_ONCE):
                            for which in range(HASHES):
                                made[_positions(keys[a : a + AT_ONCE], level, which, block)] = True
                bits = np.packbits(made, bitorder="little")
                often = counts > line
                levels = _levels_in(bits, segment, words[often], segments, block).astype(np.uint8).tobytes()
                rows = [(segment, *packed[:2], bits.tobytes(), words[often].astype("<u8").tobytes(), counts[often].astype("<i8").tobytes(), levels)]
                yield pd.DataFrame(rows, columns=["segment", "words", "counts", "block", "often", "often_counts", "often_levels"])

    return run


def _some(packed: bytes | None) -> np.ndarray:
    return np.zeros(0, np.uint64) if packed is None else _unpack_sorted(packed)


def _amounts(packed: bytes | None) -> np.ndarray:
    return np.zeros(0, np.uint64) if packed is None else _unpack(packed)


def learn(docs: DataFrame) -> Model:
    """Counts and filter from the texts of ``docs``."""
    spark = docs.sparkSession
    bound_batches(spark, COUNT_CHARS)
    texts = docs.select(F.col("text").cast("string").alias("text"))
    chars = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    segments = max(LEAST_SEGMENTS, 1 << math.ceil(math.log2(max(chars / SEGMENT_CHARS, 1))))
    packets = texts.mapInPandas(_count(segments), "segment int, words binary, counts binary, pairs binary, levels binary")
    schema = "segment int, n long, total long, per_level array<long>, words binary, counts binary, pairs binary, levels binary"
    merged = packets.groupBy("segment").applyInPandas(_merge, schema)
    path = scratch_path(spark, "lm_counts")
    with shuffles_dropped(spark):
        merged.write.parquet(path)
    merged = spark.read.schema(merged.schema).parquet(path)
    sums = merged.agg(F.sum("n").alias("n"), F.sum("total").alias("total")).first()
    tokens, words = sums["total"] or 0, sums["n"] or 0
    by_level = {r["level"]: r["n"] for r in merged.select(F.posexplode("per_level").alias("level", "n")).groupBy("level").agg(F.sum("n").alias("n")).collect()}
    entries = sum(level * n for level, n in by_level.items())
    block = (1 << math.ceil(math.log2(max(entries * BITS_PER_ENTRY, segments * 64)))) // segments
    held = min(segments, MOST_BITS // block)
    # A small share saves little asking, and every worker would hold its bits.
    held = held if held * LEAST_SHARE >= segments else 0
    built = merged.select("segment", "words", "counts", "pairs", "levels").mapInPandas(
        _build(segments, block, tokens / FREQUENT), "segment int, words binary, counts binary, block binary, often binary, often_counts binary, often_levels binary"
    )
    table = materialize(built, "lm_filter")
    # The pairs are in the filter now.
    delete(spark, path)
    size = block // 8
    sent_bits = np.zeros(held * size, np.uint8)
    for row in table.where(F.col("segment") < held).select("segment", "block").toLocalIterator():
        sent_bits[row["segment"] * size : (row["segment"] + 1) * size] = np.frombuffer(row["block"], np.uint8)
    often = table.select("often", "often_counts", "often_levels").collect()
    keys, counts, levels = (np.frombuffer(b"".join(r[i] for r in often), kind) for i, kind in enumerate(("<u8", "<i8", np.uint8)))
    order = np.argsort(keys)
    sent = Filter(sent_bits, block, held, segments, tokens, words, keys[order], counts[order], levels[order])
    return Model(spark.sparkContext.broadcast(sent), table.select("segment", "words", "counts", "block"), segments, tokens, words)


def _levels_in(bits: np.ndarray, first: int, keys: np.ndarray, segments: int, block: int) -> np.ndarray:
    """The level of each key: how many levels in a row the filter has.  ``bits`` are the blocks from segment ``first`` on."""
    level = np.zeros(len(keys), np.int64)
    for a in range(0, len(keys), AT_ONCE):
        left = keys[a : a + AT_ONCE]
        alive = np.arange(a, a + len(left))
        base = (_segment_of(left, segments) - first) * block
        for step in range(1, LEVELS + 1):
            for which in range(HASHES):
                at = _positions(left, step, which, block) + base
                found = np.flatnonzero((bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1)
                left, alive, base = left[found], alive[found], base[found]
            if not len(alive):
                break
            level[alive] = step
    return level


def _probe(keys: np.ndarray, model: Filter) -> np.ndarray:
    """The level of each key, all of segments that were sent."""
    return _levels_in(model.bits, 0, keys, model.segments, model.block)


def _log_probabilities(tokens: np.ndarray, before: np.ndarray, model: Filter) -> np.ndarray:
    """log10 of the model's probability of each token after its context."""
    words, where = np.unique(tokens, return_inverse=True)
    pairs, at = np.unique(_pair_keys(before, tokens), return_inverse=True)
    return _logs(before == START, _probe(words, model)[where], _probe(pairs, model)[at], int(_probe(np.array([END]), model)[0]), model)


def _logs(started: np.ndarray, own: np.ndarray, level: np.ndarray, end: int, model: Filter) -> np.ndarray:
    """log10 of the model's probability of each token from its level and its pair's, with that of the end token."""
    down = np.concatenate([[0.0], np.ceil(BASE ** np.arange(LEVELS) - 1e-9)])
    up = np.concatenate([[0.0], np.ceil(BASE ** np.arange(1, LEVELS + 1) - 1e-9)])
    single = (down + 0.1) / (model.tokens + 0.1 * (model.words + 1))
    logs = np.empty(len(own))
    for a in range(0, len(own), AT_ONCE):
        at = slice(a, a + AT_ONCE)
        start, word = started[at], own[at]
        context = np.where(start, LEVELS, np.concatenate([own[a - 1 : a] if a else [0], word[:-1]]))
        # A pair counts for no more than its words, so not at all if one of them is unknown.
        joint = down[np.minimum(np.minimum(level[at], word), context)]
        # Texts begin as often as they end.
        times = np.where(start, up[end], up[context])
        logs[at] = np.log10((joint + GAMMA * single[word]) / (times + GAMMA))
    return logs


_ASKED = pa.schema([("batch", pa.string()), ("segment", pa.int32()), ("words", pa.binary()), ("pairs", pa.binary())])
_TEXTS = pa.schema([("batch", pa.string()), ("ids", pa.binary()), ("missing", pa.binary()), ("words", pa.binary()), ("places", pa.binary()), ("sizes", pa.binary())])


def _pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[str, pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Name, rows, tokens and offsets of a few megabytes of text at a time; the same rows get the same name again."""
    number, task = 0, TaskContext.get().partitionId()
    for batch in batches:
        sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)) // SCORE_CHARS
        bounds = np.flatnonzero(np.diff(sizes, prepend=-1)).tolist() + [batch.num_rows]
        for a, b in zip(bounds[:-1], bounds[1:]):
            part = batch.slice(a, b - a)
            tokens, offsets = _tokens(part.column("text").to_pylist())
            yield f"{task}-{number}-{zlib.crc32(tokens):x}", part, tokens, offsets
            number += 1


def _frequent(words: np.ndarray, model: Filter) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which words are frequent, and the counts and levels of those."""
    at = np.minimum(np.searchsorted(model.frequent, words), max(len(model.frequent) - 1, 0))
    hit = model.frequent[at] == words if len(model.frequent) else np.zeros(len(words), bool)
    return hit, model.frequent_counts[at[hit]], model.frequent_levels[at[hit]]


def _asks(held: Broadcast):
    """The keys a piece has to ask for, by segment: words that are not frequent, and pairs of segments that were not sent."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Filter = held.value
        for name, _, tokens, offsets in _pieces(batches):
            words = _distinct(tokens)
            kinds = [words[~_frequent(words, model)[0]]]
            if model.held < model.segments:
                pairs = _distinct(_pair_keys(_contexts(tokens, offsets), tokens))
                kinds.append(pairs[_first_of(pairs, model.held, model.segments) :])
            asked: dict[int, list] = {}
            for place, keys in enumerate(kinds):
                found, bounds = _cuts(keys, model.segments)
                for s, packed in zip(found, _pack_sorted_parts(keys, bounds)):
                    asked.setdefault(s, [None, None])[place] = packed
            columns = [[name] * len(asked), list(asked), [k[0] for k in asked.values()], [k[1] for k in asked.values()]]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ASKED)], schema=_ASKED)

    return run


def _texts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The ids and packed tokens of each piece."""
    for name, part, tokens, offsets in _pieces(batches):
        words, places = np.unique(tokens, return_inverse=True)
        ids = part.column("doc_id")
        known, missing = pc.fill_null(ids, 0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False)
        values = [name, known.astype("<i8").tobytes(), missing.tobytes(), _pack_sorted(words), _pack(places), _pack(np.diff(offsets))]
        yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, _TEXTS)], schema=_TEXTS)


def _answer(segments: int, block: int, held: int):
    """Counts of the words and, for a segment that was not sent, levels of the keys that pieces ask of it."""

    def parts(packets: Iterable[bytes | None], answer: Callable[[np.ndarray, np.ndarray], Iterable[list[bytes]]], n: int) -> list[list[bytes | None]]:
        """``n`` lists of the answers to the keys of all packets at once, with nothing where there is no packet."""
        packets = list(packets)
        there = [p for p in packets if p is not None]
        answers = map(iter, answer(*_unpack_sorted_parts(there)) if there else [()] * n)
        return [[None if p is None else next(each) for p in packets] for each in answers]

    def run(own: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        made = {c: [] for c in ("batch", "segment", "counts", "words", "pairs")}
        if asked.empty:
            return pd.DataFrame()
        segment = int(asked["segment"].iloc[0])
        far = segment >= held
        keys, amounts = (f(own[c].iloc[0] if len(own) else None) for f, c in ((_some, "words"), (_amounts, "counts")))
        bits = np.frombuffer(own["block"].iloc[0], np.uint8) if far and len(own) else np.zeros(block // 8, np.uint8)

        def levels(wanted: np.ndarray) -> np.ndarray:
            return _levels_in(bits, segment, wanted, segments, block).astype(np.uint8)

        known = levels(keys) if far else None

        def of_words(words: np.ndarray, bounds: np.ndarray) -> list[list[bytes]]:
            at = np.minimum(np.searchsorted(keys, words), max(len(keys) - 1, 0))
            hit = keys[at] == words if len(keys) else np.zeros(len(words), bool)
            counts = np.zeros(len(words), np.uint64)
            counts[hit] = amounts[at[hit]]
            if not far:
                return [_pack_parts(counts, bounds), [None] * (len(bounds) - 1)]
            found = np.zeros(len(words), np.uint8)
            found[hit], found[~hit] = known[at[hit]], levels(words[~hit])
            return [_pack_parts(counts, bounds), _bytes(found, bounds)]

        def of_pairs(pairs: np.ndarray, bounds: np.ndarray) -> list[list[bytes]]:
            pairs, back = np.unique(pairs, return_inverse=True)
            return [_bytes(levels(pairs)[back], bounds)]

        sizes = np.cumsum([len(words or b"") + len(pairs or b"") for words, pairs in zip(asked["words"], asked["pairs"])])
        for _, part in asked.groupby(sizes // ANSWER_BYTES, sort=False):
            made["batch"] += part["batch"].tolist()
            made["segment"] += part["segment"].tolist()
            for column, found in zip(("counts", "words", "pairs"), parts(part["words"], of_words, 2) + parts(part["pairs"], of_pairs, 1)):
                made[column] += found
        return pd.DataFrame(made)

    return run


def _bytes(levels: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    whole, ends = levels.tobytes(), bounds.tolist()
    return [whole[a:b] for a, b in zip(ends[:-1], ends[1:])]


def _combine(sent: Broadcast):
    """Scores of a piece's texts from its tokens and the answers for its keys."""

    def run(texts: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        model: Filter = sent.value
        if len(texts) != 1:
            raise ValueError("the documents were not read alike twice; write them first (steady=False)")
        # Segments are the upper bits of the keys, so answers in their order are in the order of the keys.
        row, answers = texts.iloc[0], answers.sort_values("segment")
        words = _unpack_sorted(row["words"])
        where, sizes = _unpack(row["places"]).astype(np.int64), _unpack(row["sizes"]).astype(np.int64)
        tokens, doc = words[where], np.repeat(np.arange(len(sizes)), sizes)
        before = _contexts(tokens, np.concatenate([[0], np.cumsum(sizes)]))
        pairs, pair = np.unique(_pair_keys(before, tokens), return_inverse=True)
        hit, often, often_levels = _frequent(words, model)
        asked = words[~hit]
        counts, _ = _unpack_parts(answers["counts"].dropna().tolist())
        far = [np.frombuffer(b"".join(answers[c].dropna()), np.uint8) for c in ("words", "pairs")]
        near = [_first_of(keys, model.held, model.segments) for keys in (asked, pairs)]
        if [len(counts), *map(len, far)] != [len(asked), len(asked) - near[0], len(pairs) - near[1]]:
            raise ValueError("the documents were not read alike twice; write them first (steady=False)")
        amounts, levels = np.zeros(len(words)), np.zeros(len(words), np.int64)
        amounts[hit], amounts[~hit] = often, counts
        found = [np.concatenate([_probe(keys[:n], model), levels_]) for keys, n, levels_ in zip((asked, pairs), near, far)]
        levels[hit], levels[~hit] = often_levels, found[0]
        end = int(levels[np.searchsorted(words, END)])
        logs = _logs(before == START, levels[where], found[1][pair], end, model)
        total = math.log10(model.tokens + 0.1 * (model.words + 1))
        ids = pd.arrays.IntegerArray(np.frombuffer(row["ids"], "<i8").copy(), np.frombuffer(row["missing"], bool).copy())
        return pd.DataFrame(
            {
                "doc_id": ids,
                "n_tokens": sizes,
                "n_known": np.bincount(doc, (amounts > 0)[where], len(sizes)).astype(np.int64),
                "train_tokens": model.tokens,
                "base_score": np.bincount(doc, np.log10(amounts + 0.1)[where], len(sizes)) - sizes * total,
                "score": np.bincount(doc, logs, len(sizes)),
            }
        )

    return run


def score(docs: DataFrame, model: Model, steady: bool = False) -> DataFrame:
    """``(doc_id, n_tokens, n_known, train_tokens, base_score, score)`` of each row of ``docs``.

    The texts are read twice, for the keys they ask for and for their tokens.  ``steady`` says that
    ``docs`` gives the same rows in the same order each time, as a table does; otherwise it is
    written first.  Should the two readings differ all the same, the job fails.
    """
    bound_batches(docs.sparkSession, COUNT_CHARS)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    if not steady:
        rows = materialize(rows, "lm_texts")
    sent = model.filter.value
    # Blocks that were sent need not be there again.
    own = model.table.withColumn("block", F.when(F.col("segment") >= sent.held, F.col("block")))
    asked = rows.mapInArrow(_asks(model.filter), "batch string, segment int, words binary, pairs binary")
    answered = own.groupBy("segment").cogroup(asked.groupBy("segment"))
    answers = answered.applyInPandas(_answer(sent.segments, sent.block, sent.held), "batch string, segment int, counts binary, words binary, pairs binary")
    texts = rows.mapInArrow(_texts, "batch string, ids binary, missing binary, words binary, places binary, sizes binary")
    schema = "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return texts.groupBy("batch").cogroup(answers.groupBy("batch")).applyInPandas(_combine(model.filter), schema)
