"""Near-duplicate documents by a chosen-path set similarity join over word shingles.

Method.  Every distinct shingle set gets a vector of minwise tokens.  A number of
independent trees branch the sets: at a node the tree picks one coordinate of that vector
(the pick depends on the node alone) and sends each set to the child named by its token
there, so two sets stay together with a probability equal to their Jaccard similarity at
each step.  Nodes of at most ``LEAF`` sets are compared exhaustively on the token vectors;
larger ones are compared with one pivot each and branch on: a large root node several times
over, with other coordinates, so that more trees are grown for the sets of large nodes only.
A pair that is together in no leaf or last node is the method's only loss; the number of
branches follows from the threshold and ``DEPTH``, so that a pair at the threshold is lost
with a probability of at most ``MISS`` (``miss``, over the tokens that such a pair shares).

What is proposed is confirmed on full shingle sets.  Pairs with anchors (for each member of a
leaf the smallest that looks alike, for one of a large node its pivot) come first.  Other
pairs matter only between components: the members of leaves with more pairs that look alike, and
of large nodes left after ``DEPTH`` steps, are compared on full sets in rounds.  In a round
each member outside its node's most frequent component looks for one link to another
component; what is found joins components, and members without a link are done.  That
leaves the components as they would be with all links, and the rows of a round are at most one
for each member and block.

A pair is looked at in leaves and with pivots only if ``_floor`` of its tokens agree, which
loses a pair at the threshold with a probability of about 1.4e-5 (0.8) and 3.0e-5 (0.85) more.

Defined results: null or wordless texts have an empty set and link with nothing; texts
with fewer words than a shingle are one shingle; exact copies are linked through their
common set; rows with a null id are kept and take no part; a repeated id gives a row for
each of its rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from quaymark.llm.batches import bound_batches, groups, map_texts, slices
from quaymark.llm.components import connected_components
from quaymark.llm.text import mix, shingle_sets
from quaymark.session import materialize

TOKENS = 64
TREES = 12
LEAF = 32
DEPTH = 2
MISS = 1e-4
ANCHOR_GROUP = 256
#: Shingles of a block of sets that are compared with another block, about.
ENTRIES = 1 << 19

_SEEDS = np.random.default_rng(7).integers(1, 2**63, (2, TOKENS), dtype=np.uint64) | np.uint64(1)
_NODE = np.uint64(0xA0761D6478BD642F)


def _tokens(sets: list[np.ndarray]) -> np.ndarray:
    """One row of minwise tokens for each set, none of which may be empty."""
    out = np.empty((len(sets), TOKENS), np.uint32)
    flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    starts = np.cumsum([0] + [len(s) for s in sets])[:-1]
    for i in range(TOKENS) if len(sets) else ():
        out[:, i] = np.minimum.reduceat((flat ^ _SEEDS[0, i]) * _SEEDS[1, i], starts) >> np.uint64(32)
    return out


def _fingerprints(sets: list[np.ndarray]) -> np.ndarray:
    """Two 64-bit sums that identify each set."""
    out = np.zeros((len(sets), 2), np.uint64)
    for i, s in enumerate(sets):
        out[i] = np.sum(mix(s ^ _SEEDS[0, 0]), dtype=np.uint64), np.sum(mix(s ^ _SEEDS[0, 1]), dtype=np.uint64)
    return out.view(np.int64)


def _child(nodes: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """The child of each node that its set's token in the node's coordinate names."""
    coordinate = (mix(nodes ^ _NODE) % np.uint64(TOKENS)).astype(np.int64)
    chosen = tokens[np.arange(len(tokens)), coordinate].astype(np.uint64)
    return mix(nodes * np.uint64(3) + mix(chosen + np.uint64(1)))


def _children(nodes: np.ndarray, tokens: np.ndarray, branches: int) -> Iterator[np.ndarray]:
    """The child of each node in each of so many branches."""
    for branch in range(branches):
        yield _child(mix(nodes + np.uint64(branch)) if branch else nodes, tokens)


def miss(percent: int, branches: int) -> float:
    """Probability that a pair at the threshold shares no last node: the mean over how many of its tokens agree."""
    s, total = percent / 100, 0.0
    for equal in range(TOKENS + 1):
        p = equal / TOKENS
        below = 1 - (1 - p**DEPTH) ** branches
        total += math.comb(TOKENS, equal) * s**equal * (1 - s) ** (TOKENS - equal) * (1 - p * below) ** TREES
    return total


def branches_needed(percent: int) -> int:
    """Fewest branches of a large root node that lose a pair at the threshold with ``MISS`` at most."""
    branches = 1
    # No number of branches does better than the roots alone.
    while miss(percent, branches) > max(MISS, 1.01 * miss(percent, 1 << 20)):
        branches += 1
    return branches


def _unpack(packed: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(packed), np.uint32).reshape(len(packed), TOKENS)


def _floor(percent: int) -> int:
    """Fewest equal tokens at which a pair is looked at in full: over four deviations below the threshold."""
    s = percent / 100
    return int(TOKENS * s - 4.2 * (TOKENS * s * (1 - s)) ** 0.5)


def signatures(docs: DataFrame, words: int) -> DataFrame:
    """``(doc_id, n_shingles, fp1, fp2, tokens)`` of every row."""

    def run(texts: list[str | None]) -> dict:
        sets = shingle_sets(texts, words)
        prints = _fingerprints(sets)
        full = [i for i, s in enumerate(sets) if len(s)]
        packed: list[bytes | None] = [None] * len(sets)
        for i, row in zip(full, _tokens([sets[i] for i in full])):
            packed[i] = row.tobytes()
        return {"n_shingles": [len(s) for s in sets], "fp1": prints[:, 0], "fp2": prints[:, 1], "tokens": packed}

    return map_texts(docs.select("doc_id", "text"), run, "n_shingles long, fp1 long, fp2 long, tokens binary")


def _roots(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for part in batches:
        tokens = _unpack(part["tokens"])
        for tree in range(TREES):
            start = mix(np.full(len(part), 1000 + tree, np.uint64))
            yield pd.DataFrame({"node": _child(start, tokens).view(np.int64), "rep": part["rep"]})


def _leaf_pairs(percent: int):
    """For each member of a leaf a pair with the smallest that looks alike; then the members of all other pairs that do."""
    floor = _floor(percent)

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for leaf in groups(batches, ["node"]):
            leaf = leaf.sort_values("rep")
            tokens, sizes, reps = _unpack(leaf["tokens"]), leaf["n"].to_numpy(), leaf["rep"].to_numpy()
            same = (tokens[:, None, :] == tokens[None, :, :]).sum(2)
            fits = 100 * np.minimum.outer(sizes, sizes) >= percent * np.maximum.outer(sizes, sizes)
            i, j = np.nonzero(np.triu((same >= floor) & fits, 1))
            if len(i):
                order = np.lexsort((i, j))
                i, j = i[order], j[order]
                first = np.concatenate([[True], j[1:] != j[:-1]])
                yield pd.DataFrame({"pair": True, "a": reps[i[first]], "b": reps[j[first]]})
                more = np.unique(np.concatenate([i[~first], j[~first]]))
                yield pd.DataFrame({"pair": False, "a": leaf["node"].iloc[0], "b": reps[more]})

    return run


def _grow(percent: int, branches: int):
    """Rows of large nodes: a pair with the pivot, and the row's place in the next level."""
    floor = _floor(percent)

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            if part.empty:
                continue
            tokens, pivots = _unpack(part["tokens"]), _unpack(part["pivot_tokens"])
            n, m = part["n"].to_numpy(), part["pivot_n"].to_numpy()
            near = ((tokens == pivots).sum(1) >= floor) & (100 * np.minimum(n, m) >= percent * np.maximum(n, m)) & (part["rep"] != part["pivot"]).to_numpy()
            one, other = part["rep"].to_numpy()[near], part["pivot"].to_numpy()[near]
            yield pd.DataFrame({"pair": True, "a": np.minimum(one, other), "b": np.maximum(one, other)})
            for child in _children(part["node"].to_numpy().view(np.uint64), tokens, branches):
                yield pd.DataFrame({"pair": False, "a": child.view(np.int64), "b": part["rep"]})

    return run


def candidates(reps: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Pairs ``(a, b)`` with anchors, and ``(node, rep)`` of the nodes that may hold other pairs."""
    frontier = materialize(reps.select("rep", "tokens").mapInPandas(_roots, "node long, rep long"), "roots")
    # No rows, as a plan of Spark's own: a frame made of a Python list starts Python workers of another kind on each executor.
    proposed = reps.where(F.lit(False)).select(F.col("rep").alias("a"), F.col("rep").alias("b"))
    suspects = proposed.select(F.col("a").alias("node"), F.col("b").alias("rep"))
    for step in range(DEPTH):
        sizes = frontier.groupBy("node").agg(F.count("*").alias("members"), F.min("rep").alias("pivot")).where("members > 1")
        nodes = materialize(frontier.join(sizes, "node"), "nodes")
        rows = nodes.join(reps, "rep")
        leaves = rows.where(F.col("members") <= LEAF).select("node", "rep", "n", "tokens")
        leaves = leaves.repartition("node").sortWithinPartitions("node")
        alike = materialize(leaves.mapInPandas(_leaf_pairs(percent), "pair boolean, a long, b long"), "leaf_pairs")
        proposed = proposed.union(alike.where("pair").select("a", "b"))
        suspects = suspects.union(alike.where("not pair").select(F.col("a").alias("node"), F.col("b").alias("rep")))
        pivots = reps.select(F.col("rep").alias("pivot"), F.col("n").alias("pivot_n"), F.col("tokens").alias("pivot_tokens"))
        large = rows.where(F.col("members") > LEAF)
        if nodes.where(F.col("members") > LEAF).isEmpty():
            return proposed, suspects
        pivot_of = sizes.where(F.col("members") > LEAF).select("node", "pivot").join(pivots, "pivot")
        large = large.drop("pivot", "members").join(pivot_of, "node")
        grown = materialize(large.mapInPandas(_grow(percent, 1 if step else branches_needed(percent)), "pair boolean, a long, b long"), "grown")
        proposed = proposed.union(grown.where("pair").select("a", "b"))
        frontier = grown.where("not pair").select(F.col("a").alias("node"), F.col("b").alias("rep"))
    sizes = frontier.groupBy("node").agg(F.count("*").alias("members")).where("members > 1")
    return proposed, suspects.union(frontier.join(sizes.select("node"), "node"))


def _confirm(words: int, percent: int):
    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        route, anchor, own = None, None, None
        for part in slices(batches, "text"):
            sets = shingle_sets(part["text"].tolist(), words)
            found = []
            for key, rep, s in zip(zip(part["pivot"], part["part"]), part["rep"], sets):
                if key != route:  # the anchor is the first row of its group
                    route, anchor, own = key, rep, s
                    continue
                if 100 * min(len(s), len(own)) < percent * max(len(s), len(own)):
                    continue
                common = len(np.intersect1d(s, own, assume_unique=True))
                if 100 * common >= percent * (len(s) + len(own) - common):
                    found.append((anchor, rep))
            yield pd.DataFrame(found, columns=["u", "v"], dtype="int64")

    return run


def confirmed(pairs: DataFrame, reps: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """The distinct ``pairs`` ``(a, b)`` whose full sets reach the threshold, as ``(u, v)``.

    The members paired with one anchor are dealt into groups of about ``ANCHOR_GROUP``, each
    with its own copy of the anchor, so an anchor of very many members is no hot group.
    """
    groups_of = pairs.groupBy("a").agg(F.ceil(F.count("*") / ANCHOR_GROUP).cast("int").alias("parts"))
    member = pairs.join(groups_of, "a").select(F.col("b").alias("rep"), F.col("a").alias("pivot"), F.pmod(F.xxhash64("b"), "parts").cast("int").alias("part"), F.lit(1).alias("role"))
    anchor = groups_of.select(F.col("a").alias("rep"), F.col("a").alias("pivot"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("role"))
    routes = materialize(member.union(anchor), "routes")
    needed = routes.select("rep").distinct()
    texts = docs.select(F.col("doc_id").alias("rep"), "text").join(needed, "rep", "left_semi")
    rows = routes.join(texts, "rep").repartition("pivot", "part").sortWithinPartitions("pivot", "part", "role", "rep")
    return materialize(rows.mapInPandas(_confirm(words, percent), "u long, v long"), "confirmed")


def _one_link_each(words: int, percent: int):
    """For each query of a block one row of another component that its full set links it with."""

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block in groups(batches, ["node", "q", "r"]):
            asks = block["asks"].to_numpy()
            if asks.all() or not asks.any():
                continue
            sets = shingle_sets(block["text"].tolist(), words)
            label, rep = block["component"].to_numpy(), block["rep"].to_numpy()
            rows = np.flatnonzero(~asks)
            sizes = np.array([len(sets[k]) for k in rows])
            known, place = np.unique(np.concatenate([sets[k] for k in rows]), return_inverse=True)
            starts = np.cumsum(sizes) - sizes
            found = []
            for q in np.flatnonzero(asks):
                own = sets[q]
                at = np.minimum(np.searchsorted(known, own), len(known) - 1)
                mark = np.zeros(len(known), np.int32)
                mark[at[known[at] == own]] = 1
                common = np.add.reduceat(mark[place], starts)
                linked = np.flatnonzero((100 * common >= percent * (len(own) + sizes - common)) & (label[rows] != label[q]))
                if len(linked):
                    found.append((block["node"].iloc[0], rep[q], label[q], label[rows[linked[0]]]))
            yield pd.DataFrame(found, columns=["node", "rep", "u", "v"], dtype="int64")

    return run


def _dealt(rows: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """``rows (node, rep, n)`` with a block of about ``ENTRIES`` shingles, and the number of blocks of each node."""
    blocks = rows.groupBy("node").agg(F.ceil(F.sum("n") / ENTRIES).cast("int").alias(f"{name}s"))
    return rows.join(blocks, "node").withColumn(name, F.pmod(F.xxhash64("rep"), F.col(f"{name}s")).cast("int")).drop(f"{name}s"), blocks


def joined_components(suspects: DataFrame, single: DataFrame, components: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The components after all links inside the nodes of ``suspects`` are taken in, see the rounds above."""
    label = F.coalesce("component", "rep").alias("component")
    rows = suspects.distinct().join(components.withColumnRenamed("node", "rep"), "rep", "left").select("node", "rep", label)
    rows = materialize(rows, "suspects")
    counts = rows.groupBy("node", "component").agg(F.count("*").alias("members"))
    homes = counts.groupBy("node").agg(F.max_by("component", F.struct("members", "component")).alias("home"), F.count("*").alias("kinds")).where("kinds > 1")
    rows = materialize(rows.join(homes.select("node", "home"), "node").join(single.select("rep", "n"), "rep"), "mixed_nodes")
    queries = rows.where("component <> home").select("node", "rep")
    rows = rows.drop("home")
    while not queries.isEmpty():
        asking = rows.join(queries, ["node", "rep"])
        asked, q_blocks = _dealt(asking, "q")
        others, r_blocks = _dealt(rows.join(queries.select("node").distinct(), "node"), "r")
        every = lambda number: F.explode(F.sequence(F.lit(0), F.col(number) - 1))
        left = asked.join(r_blocks, "node").select("node", "rep", "component", "q", every("rs").alias("r"), F.lit(True).alias("asks"))
        right = others.join(q_blocks, "node").select("node", "rep", "component", every("qs").alias("q"), "r", F.lit(False).alias("asks"))
        routes = materialize(left.union(right), "block_routes")
        needed = texts.join(routes.select("rep").distinct(), "rep", "left_semi")
        blocks = routes.join(needed, "rep").repartition("node", "q", "r").sortWithinPartitions("node", "q", "r")
        found = materialize(blocks.mapInPandas(_one_link_each(words, percent), "node long, rep long, u long, v long"), "bridges")
        if found.isEmpty():
            break
        moved = materialize(connected_components(found.select("u", "v").distinct()), "moved")
        new = moved.select(F.col("node").alias("component"), F.col("component").alias("new"))
        relabelled = components.join(new, "component", "left").select("node", F.coalesce("new", "component").alias("component"))
        components = materialize(relabelled.union(moved.join(components, "node", "left_anti").select("node", "component")), "components")
        rows = materialize(rows.join(new, "component", "left").select("node", "rep", F.coalesce("new", "component").alias("component"), "n"), "mixed_nodes")
        queries = found.select("node", "rep").distinct()
    return components


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` of each row of ``docs (doc_id, text)``.

    Documents are linked if the Jaccard similarity of their sets of ``words``-word shingles
    is at least ``percent`` in a hundred; a component's id is its smallest doc_id.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    bound_batches(docs.sparkSession)
    signed = materialize(signatures(docs, words), "signatures")
    linked = signed.where("n_shingles > 0 and doc_id is not null")
    reps = linked.groupBy("fp1", "fp2").agg(F.min("doc_id").alias("rep"), F.min_by("tokens", "doc_id").alias("tokens"), F.min("n_shingles").alias("n"))
    reps = materialize(reps, "sets")
    # Ids are meant to be unique; one with several texts stands for the first of its sets.
    single = reps.groupBy("rep").agg(F.min_by("tokens", F.struct("fp1", "fp2")).alias("tokens"), F.min_by("n", F.struct("fp1", "fp2")).alias("n"))
    single = materialize(single, "nodes_of_sets")
    pairs, suspects = candidates(single, percent)
    # The text of a set is that of its smallest document.  Whole texts are shuffled once, for those that
    # are compared in full at all; every later join reads these only.
    pairs = materialize(pairs.distinct(), "pairs")
    compared = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).union(suspects.select("rep")).distinct()
    texts = materialize(docs.join(compared, "doc_id", "left_semi"), "texts")
    links = confirmed(pairs, single, texts, words, percent)
    components = materialize(connected_components(links), "components")
    components = joined_components(suspects, single, components, texts.withColumnRenamed("doc_id", "rep"), words, percent)
    named = reps.select("fp1", "fp2", "rep").join(components.withColumnRenamed("node", "rep"), "rep", "left")
    named = named.select("fp1", "fp2", F.coalesce("component", "rep").alias("component_id"))
    result = signed.drop("tokens").join(named, ["fp1", "fp2"], "left")
    component = F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("component_id")).otherwise(F.col("doc_id"))
    return result.select("doc_id", "n_shingles", component.alias("component_id"), (F.col("doc_id").isNull() | (component == F.col("doc_id"))).alias("kept"))


def keep_one_of_each(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: one document of each group.

    Of rows that repeat the kept document's id, one stays.  Rows with a null id all stay.
    """
    kept = near_duplicates(docs, words, percent).where("kept and doc_id is not null").select("doc_id").distinct()
    some = docs.where("doc_id is not null").join(kept, "doc_id", "left_semi")
    order = Window.partitionBy("doc_id").orderBy(F.xxhash64("text"))
    first = some.withColumn("_place", F.row_number().over(order)).where("_place = 1").drop("_place")
    return first.unionByName(docs.where("doc_id is null"))
