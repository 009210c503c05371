"""Exact top-k search by inner product, with multi-resolution segment statistics.

Method.  A vector is cut into segments, and each segment gives its mean and its deviation, once for
each row.  From these alone the squared distance of two vectors is at least the sum over
segments of ``length * ((difference of means)^2 + (difference of deviations)^2)``, so their
inner product, which is half of ``|q|^2 + |x|^2 - distance^2``, has an upper bound.  Bounds are
taken from few segments to many; after the finest level they are refined from the front, by exact
products of the first half of the components, then of three quarters, and so on, with the bound of the rest.
Pairs that no bound excludes get their exact integer product.

Queries and rows meet in blocks, a level for a whole tile at a time.  A first search among about
``SAMPLE`` rows gives each query a score that its k-th result reaches at least, so every block
excludes with it from its first tile on.  How much the bounds exclude depends on the vectors: where
all directions are equally likely, only the refined levels do.

Defined results: vectors that are null or hold null or non-finite components take no part;
only vectors of equal length are compared; a query has fewer than k rows if there are fewer
candidates; ties go to the smaller id; a repeated row is a candidate as often as it occurs
and a query once; rows with a null id take no part; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from quaymark.llm.blocks import compare_blocks
from quaymark.session import materialize

RESOLUTIONS = (4, 16, 32)
SAMPLE = 4096
QUERY_BLOCK = 2048
QUERY_TILE, ROW_TILE = 256, 2048


def usable(vector: str) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    return F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))), F.lit(False))


def segment_bounds(dims: int, segments: int) -> np.ndarray:
    return np.linspace(0, dims, min(segments, dims) + 1).astype(int)


def statistics(x: np.ndarray) -> np.ndarray:
    """For each resolution the means and deviations of its segments, times the root of their lengths."""
    parts = []
    for segments in RESOLUTIONS:
        bounds = segment_bounds(x.shape[1], segments)
        sizes = np.diff(bounds)
        means = np.add.reduceat(x, bounds[:-1], axis=1) / sizes
        apart = np.add.reduceat((x - np.repeat(means, sizes, axis=1)) ** 2, bounds[:-1], axis=1)
        parts += [means * np.sqrt(sizes), np.sqrt(apart)]
    return np.concatenate(parts, axis=1)


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors and their statistics, as packed numbers."""
    for batch in batches:
        lists, vectors, made = batch.column("v"), [], []
        flat, ends = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
        for start, end in zip(ends[:-1], ends[1:]):
            own = flat[start:end]
            vectors.append(own.astype("<i8").tobytes())
            made.append(statistics(own.astype(float)[None]).astype("<f8").tobytes() if end > start else b"")
        columns = [batch.column(c) for c in batch.schema.names if c != "v"] + [pa.array(vectors, pa.binary()), pa.array(made, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=[c for c in batch.schema.names if c != "v"] + ["v", "stats"])


class Side:
    """The vectors of a block and what bounds need of them."""

    def __init__(self, whole: np.ndarray, stats: np.ndarray) -> None:
        self.whole, self.exact = whole, whole.astype(float)
        self.norms = np.sqrt((self.exact**2).sum(1))
        dims, at, self.levels = whole.shape[1], 0, []
        for segments in RESOLUTIONS:
            n = len(segment_bounds(dims, segments)) - 1
            self.levels.append((stats[:, at : at + n], stats[:, at + n : at + 2 * n]))
            at += 2 * n


def candidates(q: Side, x: Side, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs whose product may reach ``least`` of the query, after all levels."""
    slack = 1e-9 * (q.norms * x.norms.max(initial=0) + 1)
    line = (least - slack)[:, None]
    columns = np.arange(len(x.whole))
    alive = np.ones((len(q.whole), len(columns)), bool)

    def exclude(bound: np.ndarray) -> None:
        nonlocal alive, columns
        alive &= bound >= line
        some = alive.any(0)
        if some.sum() < 0.5 * len(some):
            alive, columns = alive[:, some], columns[some]

    for (m, d), (n, e) in zip(q.levels, x.levels):
        if len(columns):
            exclude(m @ n[columns].T + d @ e[columns].T)
    dims = q.whole.shape[1]
    bounds = segment_bounds(dims, RESOLUTIONS[-1])
    (m, d), (n, e) = q.levels[-1], x.levels[-1]
    start, partial = 0, np.zeros(1)
    for share in (2, 4, 8):
        cut = len(bounds) - 1 - (len(bounds) - 1) // share
        end = bounds[cut]
        if len(columns) and start < end < dims:
            before = len(columns)
            partial = partial + q.exact[:, start:end] @ x.exact[columns, start:end].T
            held = columns
            exclude(partial + m[:, cut:] @ n[columns][:, cut:].T + d[:, cut:] @ e[columns][:, cut:].T)
            if len(columns) < before:
                partial = partial[:, np.isin(held, columns)]
            start = end
    i, j = np.nonzero(alive)
    return i, columns[j]


def products(q: Side, x: Side, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Exact integer products of pairs."""
    made = np.empty(len(i), np.int64)
    for at in range(0, len(i), 1 << 15):
        part = slice(at, at + (1 << 15))
        made[part] = np.einsum("ij,ij->i", q.whole[i[part]], x.whole[j[part]])
    return made


def _side(part: pd.DataFrame) -> Side:
    whole, stats = (np.frombuffer(b"".join(part[c]), t).reshape(len(part), -1) for c, t in (("v", "<i8"), ("stats", "<f8")))
    return Side(whole, stats)


def _cut(side: Side, at: slice) -> Side:
    cut = object.__new__(Side)
    cut.whole, cut.exact, cut.norms = side.whole[at], side.exact[at], side.norms[at]
    cut.levels = [(m[at], d[at]) for m, d in side.levels]
    return cut


def _search(k: int):
    def run(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        q, x = _side(queries), _side(rows)
        own, ids, keys = (c.to_numpy() for c in (queries["query_id"], rows["vec_id"], queries["query_key"]))
        floor = queries["least"].to_numpy(float, na_value=-np.inf)
        found = []
        for a in range(0, len(own), QUERY_TILE):
            part = slice(a, a + QUERY_TILE)
            some = _cut(q, part)
            least = floor[part].copy()
            kept = [np.zeros(0, np.int64)] * 3
            for b in range(0, len(ids), ROW_TILE):
                tile = _cut(x, slice(b, b + ROW_TILE))
                i, j = candidates(some, tile, least)
                other = own[part][i] != ids[b + j]
                i, j = i[other], j[other]
                scores = products(some, tile, i, j)
                best = scores >= least[i]
                i, scores, place = (np.concatenate([old, new[best]]) for old, new in zip(kept, (i, scores, b + j)))
                # The k best of each query so far, ties by id.
                order = np.lexsort((ids[place], -scores, i))
                i, scores, place = i[order], scores[order], place[order]
                nth = np.arange(len(i)) - np.searchsorted(i, i)
                full = nth == k - 1
                least[i[full]] = np.maximum(least[i[full]], scores[full])
                kept = [c[nth < k] for c in (i, scores, place)]
            i, scores, place = kept
            found.append(pd.DataFrame({"query_id": own[part][i], "query_key": keys[part][i], "vec_id": ids[place], "score": scores}))
        return pd.concat(found)

    return run


def top_k(rows: DataFrame, queries: DataFrame, k: int = 20, scale: int = 64) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k rows with the largest inner products for each query.

    Both sides have ``(vec_id, embedding)``.  Components count as ``floor(scale * x)``; a
    row with the query's own id is no candidate for it.
    """

    def whole(df: DataFrame) -> DataFrame:
        cut = df.where(usable("embedding") & F.col("vec_id").isNotNull())
        v = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("long"))
        cut = cut.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).select("vec_id", F.size("v").alias("dims"), F.xxhash64("v").alias("key"), "v")
        return cut.mapInArrow(_measured, "vec_id long, dims int, key long, v binary, stats binary")

    asked = whole(queries).dropDuplicates(["vec_id", "dims", "key"]).select(F.col("vec_id").alias("query_id"), F.col("key").alias("query_key"), "v", "stats", "dims")
    asked, given = materialize(asked, "search_asked"), materialize(whole(rows).drop("key"), "search_given")
    parts = max(1, math.ceil(given.count() / SAMPLE))
    order = Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id")

    def best(queries: DataFrame, rows: DataFrame) -> DataFrame:
        made = compare_blocks(queries, rows, ["dims"], ["salt", "v"], _search(k), "query_id long, query_key long, vec_id long, score long", "search", QUERY_BLOCK)
        return made.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    asked, given = asked.withColumn("salt", F.col("query_id")), given.withColumn("salt", F.col("vec_id"))
    least = F.lit(None).cast("long")
    if parts > 1:
        first = best(asked.withColumn("least", least), given.where(F.pmod(F.xxhash64("vec_id", F.lit(7)), F.lit(parts)) == 0))
        known = first.where(F.col("rank") == k).select("query_id", "query_key", F.col("score").alias("least"))
        asked = asked.join(known, ["query_id", "query_key"], "left")
    else:
        asked = asked.withColumn("least", least)
    return best(asked, given).select("query_id", "rank", "vec_id", "score")
