"""Ranked lexical search over a length-stratified index.

Method.  Documents with the same normaliser ``m`` form a stratum.  A stratum is dealt into
blocks of about ``BLOCK`` documents; a block's postings are in order of term and, within a
term, of falling term frequency, so an impact is computed once per frequency of a
stratum, not per posting.  A stratum's bound for an item sums the impacts of the largest
frequency each of its terms has there.  Bounds order the visits: the strata with the
highest bounds, with ``FIRST`` documents or more, are scored first and give a lower limit
for the last score that counts; then only strata whose bound reaches that limit are
visited, and in them only blocks whose own bound reaches it.  In a block, terms whose
bounds together stay below the limit cannot bring a document in by themselves: their
postings are read only if some document can reach the limit through the other terms.

Sizes.  The index holds every document's postings for the terms of the query set.  Items are
searched in parts of about ``MOST_PAIRS`` distinct (item, term) pairs, so what is sent to
the tasks is bounded; more items take more parts.  Strata are split into blocks by a
hash, so the most frequent length is no hot group.  A task holds one block and the best
rows found so far, ``k`` for each item.

Terms are known by 64-bit hashes.  Defined results: null texts and texts without a term have
no terms and count in neither N nor L; documents with a null id count in the statistics
but are never returned; a repeated id is ranked once for each of its rows; rows that
repeat an item_id are one item with the terms of all its texts; items with a null id, and
items without a known term, return nothing; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from quaymark.llm.batches import groups, map_texts
from quaymark.llm.text import word_hashes
from quaymark.session import materialize

BLOCK = 1024
FIRST = 1024
MOST_PAIRS = 1 << 20
MOST_VISITS = 1 << 22
#: Lower-cases A-Z; every other ASCII character that is no digit or letter becomes a space.
_TERMS = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in bytes(range(256)).lower())


def _term_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    return word_hashes([t and t.encode("utf-8", "replace").translate(_TERMS).decode("utf-8", "replace") for t in texts])


def item_terms(items: DataFrame) -> DataFrame:
    """Distinct ``(item_id, term)`` of ``items (item_id, text)``; terms are hashes."""

    def run(texts: list[str | None]) -> dict:
        hashes, offsets = _term_hashes(texts)
        return {"terms": [np.unique(hashes[a:b]).view(np.int64) for a, b in zip(offsets[:-1], offsets[1:])]}

    rows = items.where("item_id is not null").select("item_id", F.col("text").cast("string").alias("text"))
    return materialize(map_texts(rows, run, "terms array<long>").select("item_id", F.explode("terms").alias("term")).distinct(), "item_terms")


def count_terms(docs: DataFrame, known: np.ndarray) -> DataFrame:
    """``(doc_id, n, terms, tfs)`` of each row of ``docs (doc_id, text)``: all its terms, and those known by their place in ``known``."""
    sent = docs.sparkSession.sparkContext.broadcast(known)

    def run(texts: list[str | None]) -> dict:
        sorted_terms = sent.value
        hashes, offsets = _term_hashes(texts)
        counts = np.diff(offsets)
        owner = np.repeat(np.arange(len(texts)), counts)
        place = np.minimum(np.searchsorted(sorted_terms, hashes), max(len(sorted_terms) - 1, 0))
        hit = sorted_terms[place] == hashes if len(sorted_terms) else np.zeros(len(hashes), bool)
        keys, tfs = np.unique(owner[hit] * max(len(sorted_terms), 1) + place[hit], return_counts=True)
        owners, terms = np.divmod(keys, max(len(sorted_terms), 1))
        ends = np.searchsorted(owners, np.arange(len(texts) + 1)).astype(np.int32)
        lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(v.astype(np.int32))) for v in (terms, tfs)]
        return {"n": counts, "terms": lists[0], "tfs": lists[1]}

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return materialize(map_texts(rows, run, "n long, terms array<int>, tfs array<int>"), "counted")


def impact(tf: np.ndarray, m: int) -> np.ndarray:
    return 1_000_000_000 * tf // (1000 * tf + 20 * m)


def _blocks(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row for each block: its documents, and its postings by term and falling frequency."""
    for part in groups(batches, ["m", "shard"]):
        sizes = part["terms"].map(len).to_numpy()
        term, tf = (np.concatenate(part[c].tolist()).astype(np.int32) for c in ("terms", "tfs"))
        place = np.repeat(np.arange(len(part), dtype=np.int32), sizes)
        order = np.lexsort((place, -tf, term))
        row = {"m": part["m"].iloc[0], "docs": part["doc_id"].to_numpy(np.int64).tobytes()}
        row |= {"terms": term[order].tobytes(), "tfs": tf[order].tobytes(), "places": place[order].tobytes()}
        yield pd.DataFrame([row])


def strata(counted: DataFrame, block: int) -> tuple[DataFrame, DataFrame, int]:
    """The index, the documents and largest frequencies of each stratum, and N."""
    documents, length = counted.where("n > 0").agg(F.count("*"), F.sum("n")).first()
    m = F.expr(f"50 + (50 * n * {documents}L) div {length or 1}L")
    rows = counted.where("size(terms) > 0 and doc_id is not null").withColumn("m", m)
    held = materialize(rows.groupBy("m").agg(F.count("*").alias("documents")), "stratum_sizes")
    shard = F.pmod(F.xxhash64("doc_id", "n", "terms"), F.ceil(F.col("documents") / block)).cast("int")
    dealt = rows.join(held, "m").select("m", shard.alias("shard"), "doc_id", "terms", "tfs")
    dealt = dealt.repartition("m", "shard").sortWithinPartitions("m", "shard")
    index = materialize(dealt.mapInPandas(_blocks, "m long, docs binary, terms binary, tfs binary, places binary"), "strata")
    pairs = rows.select("m", F.explode(F.arrays_zip("terms", "tfs")).alias("t")).select("m", "t.terms", "t.tfs")
    tops = pairs.groupBy("m", F.col("terms").alias("place")).agg(F.max("tfs").cast("long").alias("tf"))
    top = tops.select("m", "place", F.expr("(1000000000L * tf) div (1000L * tf + 20L * m)").alias("impact"))
    return index, top.join(held, "m"), documents


def _visit(weights: pd.DataFrame, k: int):
    """Best documents of each item in the blocks a task visits; ``weights`` has (item, place, weight) by item."""
    items = weights["item"].to_numpy()
    terms, weight = weights["place"].to_numpy(), weights["weight"].to_numpy()
    starts = np.concatenate([[0], np.flatnonzero(np.diff(items)) + 1, [len(items)]]) if len(items) else np.zeros(1, int)
    places = int(terms.max()) + 1 if len(items) else 0
    order = {int(item): i for i, item in enumerate(items[starts[:-1]])}

    def score(block: pd.Series, asked: np.ndarray, limits: dict[int, int], best: dict) -> None:
        m, docs = int(block["m"]), np.frombuffer(block["docs"], np.int64)
        term, tf, place = (np.frombuffer(block[c], np.int32) for c in ("terms", "tfs", "places"))
        # Impacts are computed once for each frequency of a term and handed to its postings.
        new = np.concatenate([[True], (term[1:] != term[:-1]) | (tf[1:] != tf[:-1])])
        group = np.flatnonzero(new)
        worth = np.repeat(impact(tf[group].astype(np.int64), m), np.diff(np.append(group, len(term))))
        begins = np.flatnonzero(np.concatenate([[True], term[1:] != term[:-1]]))
        ends = np.append(begins[1:], len(term))
        top = np.zeros(places, np.int64)
        top[term[begins]] = worth[begins]
        slot = np.zeros(places, np.int64)
        slot[term[begins]] = np.arange(len(begins))
        bounds = np.add.reduceat(weight * top[terms], starts[:-1])
        for item in asked:
            i, limit = order[int(item)], limits[int(item)]
            if bounds[i] < max(limit, 1):
                continue
            mine = terms[starts[i] : starts[i + 1]]
            most = weight[starts[i] : starts[i + 1]] * top[mine]
            rank = np.argsort(most)
            rank = rank[most[rank] > 0]
            below = np.cumsum(most[rank])
            weak = int(np.searchsorted(below, max(limit, 1), "left"))
            total = np.zeros(len(docs), np.int64)

            def add(which: np.ndarray) -> None:
                for r in which:
                    a, b = begins[slot[mine[r]]], ends[slot[mine[r]]]
                    total[place[a:b]] += weight[starts[i] + r] * worth[a:b]

            add(rank[weak:])
            rest = int(below[weak - 1]) if weak else 0
            if total.max() + rest < limit or not total.any():
                continue
            hopeful = np.flatnonzero((total > 0) & (total + rest >= limit))
            add(rank[:weak])
            hopeful = hopeful[total[hopeful] >= max(limit, 1)]
            if not len(hopeful):
                continue
            found = pd.DataFrame({"doc_id": docs[hopeful], "score": total[hopeful]})
            if int(item) in best:
                found = pd.concat([best[int(item)], found])
            found = found.sort_values(["score", "doc_id"], ascending=[False, True]).head(k)
            best[int(item)] = found
            if len(found) == k:
                limits[int(item)] = max(limit, int(found["score"].iloc[-1]))

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        limits: dict[int, int] = {}
        best: dict[int, pd.DataFrame] = {}
        for batch in batches:
            for _, block in batch.iterrows():
                for item, limit in zip(block["items"], block["limits"]):
                    limits[int(item)] = max(int(limit), limits.get(int(item), 0))
                score(block, block["items"], limits, best)
        for item, found in best.items():
            yield found.assign(item=item)

    return run


def _search_part(docs: DataFrame, pairs: DataFrame, k: int, block: int, first: int) -> DataFrame:
    spark = docs.sparkSession
    # At most about MOST_PAIRS rows, see search.
    rows = pairs.toPandas()
    known = np.unique(rows["term"].to_numpy().view(np.uint64)) if len(rows) else np.zeros(0, np.uint64)
    counted = count_terms(docs, known)
    index, top, documents = strata(counted, block)
    df = np.zeros(max(len(known), 1), np.int64)
    for r in counted.select(F.explode("terms").alias("place")).groupBy("place").count().toLocalIterator():
        df[r["place"]] = r["count"]
    names, codes = np.unique(rows["item_id"].to_numpy(), return_inverse=True)
    place = np.searchsorted(known, rows["term"].to_numpy().view(np.uint64))
    weight = [math.floor(1000 * math.log((2 * documents + 2) / (2 * df[p] + 1))) for p in place]
    weights = pd.DataFrame({"item": codes.astype(np.int64), "place": place.astype(np.int64), "weight": np.array(weight, np.int64)})
    weights = weights.sort_values(["item", "place"], ignore_index=True)
    table = spark.createDataFrame(weights, "item long, place long, weight long")
    bounds = top.join(table, "place").groupBy("item", "m").agg(F.sum(F.col("weight") * F.col("impact")).alias("bound"), F.first("documents").alias("documents"))
    falling = Window.partitionBy("item").orderBy(F.desc("bound"), "m").rowsBetween(Window.unboundedPreceding, -1)
    bounds = materialize(bounds.where("bound > 0").withColumn("before", F.coalesce(F.sum("documents").over(falling), F.lit(0))), "bounds")

    def visit(chosen: DataFrame, label: str) -> DataFrame:
        asked = materialize(chosen.groupBy("m").agg(F.collect_list("item").alias("items"), F.collect_list("limit").alias("limits")), "visits")
        pairs_asked = asked.agg(F.coalesce(F.sum(F.size("items")), F.lit(0))).first()[0]
        rows = index.join(F.broadcast(asked) if pairs_asked <= MOST_VISITS else asked, "m")
        return materialize(rows.mapInPandas(_visit(weights, k), "doc_id long, score long, item long"), label)

    order = Window.partitionBy("item").orderBy(F.desc("score"), "doc_id")
    start = visit(bounds.where(F.col("before") < first).withColumn("limit", F.lit(0).cast("long")), "first_visit")
    last = start.withColumn("rank", F.row_number().over(order)).where(F.col("rank") == k).select("item", F.col("score").alias("limit"))
    rest = bounds.where(F.col("before") >= first).join(last, "item", "left").withColumn("limit", F.coalesce("limit", F.lit(0).cast("long")))
    found = start.union(visit(rest.where("bound >= limit"), "second_visit"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    named = spark.createDataFrame(pd.DataFrame({"item": np.arange(len(names)), "item_id": names}), f"item long, item_id {pairs.schema['item_id'].dataType.simpleString()}")
    return ranked.join(named, "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = 50, block: int = BLOCK, first: int = FIRST, most_pairs: int = MOST_PAIRS) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``k`` best rows of ``docs (doc_id, text)`` for each of ``items (item_id, text)``."""
    pairs = item_terms(items)
    docs = docs.withColumn("doc_id", F.col("doc_id").cast("long"))
    parts = max(1, math.ceil(pairs.count() / most_pairs))
    found = None
    for part in range(parts):
        own = pairs.where(F.pmod(F.xxhash64("item_id"), F.lit(parts)) == part) if parts > 1 else pairs
        more = _search_part(docs, own, k, block, first)
        found = more if found is None else found.union(more)
    return found


def oracle(k: int = 50) -> str:
    """The search as DuckDB SQL over ``documents`` and ``benchmark``, without strata or bounds."""
    split = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    return f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, w, len(w)::HUGEINT AS n FROM (SELECT doc_id, {split} AS w FROM documents) WHERE len(w) > 0),
totals AS (SELECT count(*)::HUGEINT AS docs, sum(n)::HUGEINT AS length FROM docs),
asked AS (SELECT DISTINCT item_id, unnest({split}) AS term FROM benchmark WHERE item_id IS NOT NULL),
postings AS (
  SELECT r, term, count(*)::HUGEINT AS tf FROM (SELECT r, unnest(w) AS term FROM docs)
  WHERE term IN (SELECT term FROM asked) GROUP BY r, term),
weights AS (
  SELECT term, floor(1000 * ln((2 * any_value(docs)::DOUBLE + 2) / (2 * count(*)::DOUBLE + 1)))::HUGEINT AS w
  FROM postings, totals GROUP BY term),
scored AS (
  SELECT item_id, r, sum(weights.w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // length)))) AS score
  FROM asked JOIN weights USING (term) JOIN postings USING (term) JOIN (SELECT r, n FROM docs) USING (r), totals
  GROUP BY item_id, r)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score::BIGINT AS score
FROM scored JOIN (SELECT r, doc_id FROM docs) USING (r) WHERE score > 0 AND doc_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= {k}"""
