"""Near-duplicate embeddings by NN-descent within labels.

Method.  Equal vectors of a label become one node.  A first neighbour graph comes from
sorting the nodes by the signs of random projections, several times, and taking each
node's nearest in windows of the sorted order.  Then rounds of NN-descent: the neighbours
of a node, forward and backward, are compared with each other, and each keeps the
``NEIGHBOURS`` nearest it has seen.  These steps work on half-precision unit vectors and
only propose; a link needs a cosine of at least the threshold in double precision.

A node whose whole list lies at the threshold is saturated: it may have more links than a
list holds.  Its list is enlarged to everything by an exact comparison, in blocks, with all
nodes of its label.  Of a block pair only each node's number of links and a spanning forest
of the links come back, so a group of many near copies is never expanded into its pairs.

The number of sorted orders follows from the label's size: two vectors at the threshold
share the first ``k`` signs with probability ``(1 - angle / pi)**k``, and orders are added
until such a pair is in no common window with a probability of at most ``MISS``.

Signs that crowd together can break that rule, so each label is audited: about ``AUDITED`` of
its unsaturated nodes (all, if it has no more) are compared exactly with the whole label, and
each of them with links counts alike.  A label fails if one of them lacks a link, unless at
least ``ENOUGH`` have links and have ``RECALL`` of them on average.  A failed label gets more
orders and rounds, and if it fails ``EXTRA`` times more, or has no more than ``AUDITED`` nodes,
the exact comparison of all its nodes.  A large label of which no audited node lacks a link
rests on ``MISS``.

Defined results: a vector that is null, has length zero or holds null or non-finite components, or whose
label is null, links with nothing; so do vectors of different lengths; equal vectors are linked; a row with a null
id takes no part and is kept; a repeated id gives a row for each of its rows, of which
none links to another; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from quaymark.llm.batches import groups
from quaymark.llm.blocks import compare_blocks
from quaymark.llm.components import connected_components
from quaymark.llm.segment_search import usable
from quaymark.session import materialize

NEIGHBOURS = 8
ORDERS = 6
WINDOW = 256
ROUNDS = 2
MISS = 1e-3
AUDITED = 1000
ENOUGH = 100
RECALL = 0.99
EXTRA = 2
#: Half-precision cosines differ from exact ones by less than this.
MARGIN = 0.005

_GRAPH = "label string, u long, v long, s float"


def _half(arrays: Iterable) -> list[bytes]:
    out = []
    for a in arrays:
        x = np.asarray(a, float)
        x = x / np.abs(x).max()
        out.append((x / np.linalg.norm(x)).astype(np.float16).tobytes())
    return out


def _vectors(packed: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(packed), np.float16).reshape(len(packed), -1).astype(np.float32)


def orders_needed(sizes: np.ndarray, threshold: float) -> np.ndarray:
    """Sorted orders for labels of so many nodes."""
    signs = np.ceil(np.log2(np.maximum(2 * sizes / WINDOW, 1)))
    # Rows with equal signs are about half a window at most; a border parts a quarter of them at most.
    together = 0.75 * (1 - np.arccos(np.clip(threshold, -1, 1)) / np.pi) ** signs
    return np.maximum(ORDERS, np.ceil(np.log(MISS) / np.log1p(-np.maximum(together, 1e-9)))).astype(np.int64)


def _orders(seed: int, first: int, threshold: float):
    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            for _, same in part.groupby(part["half"].str.len()):
                needed = orders_needed(same["label_size"].to_numpy(), threshold)
                for order in range(first, min(first + ORDERS, int(needed.max()))):
                    some = same[needed > order]
                    x = _vectors(some["half"])
                    planes = np.random.default_rng([seed, order, x.shape[1]]).standard_normal((x.shape[1], 62))
                    code = ((x @ planes > 0) * (1 << np.arange(61, -1, -1, dtype=np.int64))).sum(1)
                    yield pd.DataFrame({"label": some["label"], "round": order, "code": code, "u": some["u"], "half": some["half"]})

    return run


def _windows(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for place in range(0, len(batch), WINDOW):
            part = batch.iloc[place : place + WINDOW]
            for key, same in part.groupby([part["label"], part["round"], part["half"].str.len()], sort=False):
                if len(same) > 1:
                    yield from _nearest(key[0], same["u"].to_numpy(), _vectors(same["half"]))


def _nearest(label: str, ids: np.ndarray, x: np.ndarray) -> Iterator[pd.DataFrame]:
    s = x @ x.T
    np.fill_diagonal(s, -2)
    k = min(NEIGHBOURS, len(ids) - 1)
    top = np.argpartition(-s, k - 1, axis=1)[:, :k]
    u = np.repeat(np.arange(len(ids)), k)
    v = top.ravel()
    yield pd.DataFrame({"label": label, "u": ids[u], "v": ids[v], "s": s[u, v]})


def _best(edges: DataFrame) -> DataFrame:
    """The nearest ``NEIGHBOURS`` of each node."""
    order = Window.partitionBy("label", "u").orderBy(F.desc("s"), "v")
    one = edges.groupBy("label", "u", "v").agg(F.max("s").alias("s"))
    return one.withColumn("place", F.row_number().over(order)).where(F.col("place") <= NEIGHBOURS).drop("place")


def _local_joins(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Neighbours of one node, compared with each other; a pair helps if it beats the worst of either's list."""
    made = []
    for part in groups(batches, ["label", "centre"]):
        if len(part) < 2:
            continue
        x, ids, worst = _vectors(part["half"]), part["v"].to_numpy(), part["worst"].to_numpy()
        s = x @ x.T
        i, j = np.nonzero((s > worst[:, None]) & (ids[:, None] != ids[None, :]))
        made.append((part["label"].iloc[0], ids[i], ids[j], s[i, j]))
        if len(made) == 512:
            yield _edges(made)
            made = []
    if made:
        yield _edges(made)


def _edges(made: list) -> pd.DataFrame:
    label = np.repeat(np.array([m[0] for m in made], object), [len(m[1]) for m in made])
    u, v, s = (np.concatenate([m[i] for m in made]) for i in (1, 2, 3))
    return pd.DataFrame({"label": label, "u": u, "v": v, "s": s})


def _descend(graph: DataFrame, nodes: DataFrame) -> DataFrame:
    """One round of neighbours-of-neighbours joins."""
    backward = graph.select("label", F.col("v").alias("centre"), F.col("u").alias("v"))
    chosen = Window.partitionBy("label", "centre").orderBy(F.xxhash64("v", "centre"))
    backward = backward.withColumn("place", F.row_number().over(chosen)).where(F.col("place") <= NEIGHBOURS).drop("place")
    around = graph.select("label", F.col("u").alias("centre"), "v").union(backward).distinct()
    worst = graph.groupBy("label", "u").agg(F.when(F.count("*") >= NEIGHBOURS, F.min("s")).otherwise(F.lit(-2.0)).cast("float").alias("worst"))
    ends = nodes.join(worst, ["label", "u"]).select("label", F.col("u").alias("v"), "half", "worst")
    rows = around.join(ends, ["label", "v"]).repartition("label", "centre").sortWithinPartitions("label", "centre")
    return _best(graph.union(rows.mapInPandas(_local_joins, _GRAPH)))


def neighbour_graph(nodes: DataFrame, seed: int, threshold: float) -> DataFrame:
    """``(label, u, v, s)``: about the nearest ``NEIGHBOURS`` of each node of ``(label, u, half)``."""
    sizes = materialize(nodes.groupBy("label").agg(F.count("*").alias("label_size")), "label_sizes")
    sized = nodes.select("label", "u", "half").join(sizes, "label")
    most = sizes.agg(F.max("label_size")).first()[0] or 0
    keys = ["label", "round", "code", "u"]
    graph = None
    # A few orders at a time, which bounds what is shuffled at once.
    for first in range(0, int(orders_needed(np.array([most]), threshold)[0]), ORDERS):
        spread = sized.mapInPandas(_orders(seed, first, threshold), "label string, round int, code long, u long, half binary")
        ordered = materialize(spread, "orders").repartitionByRange(*keys).sortWithinPartitions(*keys)
        found = ordered.mapInPandas(_windows, _GRAPH)
        graph = materialize(_best(found if graph is None else graph.union(found)), "graph")
    for _ in range(ROUNDS):
        graph = materialize(_descend(graph, nodes), "graph")
    return graph


def _exact(threshold: float, mode: str):
    """Per block pair: links of each query, a spanning forest, and links to unsaturated rows."""

    def unit(arrays: pd.Series) -> np.ndarray:
        x = np.array(arrays.tolist(), float)
        x /= np.abs(x).max(1)[:, None]
        return x / np.linalg.norm(x, axis=1)[:, None]

    def run(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        u, v = queries["u"].to_numpy(), rows["u"].to_numpy()
        hits = unit(queries["x"]) @ unit(rows["x"]).T >= threshold
        hits &= u[:, None] != v[None, :]
        kinds = []
        linked = hits @ rows["m"].to_numpy().astype(float)
        some = np.flatnonzero(linked)
        kinds.append((0, u[some], u[some], linked[some].astype(np.int64)))
        if mode == "links":
            # Components of this block pair: each query takes the smallest row component it touches, until nothing changes.
            own = np.arange(len(v))
            while len(some):
                low = np.where(hits, own[None, :], len(v)).min(1)
                new = np.minimum(own, np.where(hits, low[:, None], len(v)).min(0))
                if (new == own).all():
                    break
                own = new
            touched = np.flatnonzero(hits.any(0))
            kinds.append((1, v[touched], v[own[touched]], np.ones(len(touched), np.int64)))
            if len(some):
                kinds.append((1, u[some], v[low[some]], np.ones(len(some), np.int64)))
            i, j = np.nonzero(hits & ~rows["saturated"].to_numpy(bool)[None, :])
            kinds.append((2, v[j], u[i], queries["m"].to_numpy()[i]))
        return pd.concat([pd.DataFrame({"kind": k, "a": a, "b": b, "m": m}) for k, a, b, m in kinds])

    return run


def _scan(queries: DataFrame, rows: DataFrame, threshold: float, mode: str) -> DataFrame:
    found = compare_blocks(queries, rows, ["label", "dims"], ["u"], _exact(threshold, mode), "kind int, a long, b long, m long", "scan")
    return materialize(found, "scan")


def _confirmed(graph: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """Both directions of the graph's edges whose exact cosine reaches the threshold: ``(u, v, m)``, m of v."""
    near = graph.where(F.col("s") >= threshold - MARGIN).select("label", F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b")).distinct()
    one = nodes.select("label", F.col("u").alias("a"), F.col("x").alias("xa"), F.col("m").alias("ma"))
    other = nodes.select("label", F.col("u").alias("b"), F.col("x").alias("xb"), F.col("m").alias("mb"))

    def dot(x: str, y: str):
        return F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda total, p: total + p)

    cosine = dot("xa", "xb") / (F.sqrt(dot("xa", "xa")) * F.sqrt(dot("xb", "xb")))
    links = near.join(one, ["label", "a"]).join(other, ["label", "b"]).where((F.size("xa") == F.size("xb")) & (cosine >= threshold))
    links = materialize(links.select("a", "b", "ma", "mb"), "confirmed")
    return links.select(F.col("a").alias("u"), F.col("b").alias("v"), F.col("mb").alias("m")).union(links.select("b", "a", "ma"))


def _links(graph: DataFrame, nodes: DataFrame, threshold: float, whole: DataFrame | None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(u, linked)`` for nodes with links, edges ``(u, v)`` that connect what is linked, and the nodes, marked where compared exactly.

    All nodes of the labels of ``whole`` count as saturated.
    """
    lists = graph.where(F.col("s") >= threshold - MARGIN).groupBy("label", "u").agg(F.count("*").alias("n"))
    full = lists.where(F.col("n") >= NEIGHBOURS).select("label", "u")
    if whole is not None:
        full = full.union(nodes.join(whole, "label", "left_semi").select("label", "u")).distinct()
    full = full.withColumn("saturated", F.lit(True))
    marked = materialize(nodes.join(full, ["label", "u"], "left").withColumn("saturated", F.coalesce("saturated", F.lit(False))), "marked")
    columns = ["label", "dims", "u", "x", "m", "saturated"]
    scanned = _scan(marked.where("saturated").select(*columns), marked.select(*columns), threshold, "links")
    pairs = _confirmed(graph, nodes, threshold)
    open_nodes = marked.where("not saturated").select("u")
    open_pairs = pairs.union(scanned.where("kind = 2").select("a", "b", "m")).distinct().join(open_nodes, "u", "left_semi")
    counted = open_pairs.select("u", "m").union(scanned.where("kind = 0").select("a", "m"))
    edges = pairs.select("u", "v").union(scanned.where("kind > 0").select("a", "b"))
    return materialize(counted.groupBy("u").agg(F.sum("m").alias("linked")), "linked"), materialize(edges.distinct(), "edges"), marked


def audit(linked: DataFrame, marked: DataFrame, threshold: float) -> DataFrame:
    """``(label, n)`` of the labels that fail, n the number of nodes that were not compared exactly."""
    columns = ["label", "dims", "u", "x", "m"]
    open_nodes = marked.where("not saturated")
    sizes = materialize(open_nodes.groupBy("label").agg(F.count("*").alias("n")), "open_sizes")
    drawn = F.pmod(F.xxhash64("u", F.lit("audit")), F.lit(1 << 30)) * F.col("n") < F.lit(AUDITED << 30)
    sample = open_nodes.join(sizes, "label").where((F.col("n") <= AUDITED) | drawn).select(*columns)
    sample = materialize(sample, "audited")
    exact = _scan(sample, marked.select(*columns), threshold, "count").groupBy("a").agg(F.sum("m").alias("true")).withColumnRenamed("a", "u")
    share = F.coalesce("linked", F.lit(0)) / F.col("true")
    checked = exact.join(sample.select("u", "label"), "u").join(linked, "u", "left").select("label", share.alias("share"))
    checked = checked.groupBy("label").agg(F.count("*").alias("with_links"), F.avg("share").alias("recall"), F.min("share").alias("worst"))
    failed = (F.col("worst") < 1) & ((F.col("recall") < RECALL) | (F.col("with_links") < ENOUGH) | (F.col("n") <= AUDITED))
    return materialize(checked.join(sizes, "label").where(failed).select("label", "n"), "failed")


def near_duplicate_vectors(vectors: DataFrame, threshold: float = 0.93) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` of each row of ``vectors (vec_id, label, embedding)``."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), F.col("embedding").cast("array<double>").alias("x"))
    usable_row = F.col("label").isNotNull() & F.col("vec_id").isNotNull() & usable("x") & F.exists("x", lambda c: c != 0)
    # Equal vectors have one key; -0.0 counts as 0.0.
    rows = rows.withColumn("x", F.transform("x", lambda c: c + F.lit(0.0))).withColumn("live", F.coalesce(usable_row, F.lit(False)))
    live = rows.where("live").drop("live")
    nodes = live.groupBy("label", "x").agg(F.min("vec_id").alias("u"), F.count("*").alias("m")).withColumn("dims", F.size("x"))

    def half(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            yield part.assign(half=_half(part["x"]))

    nodes = materialize(nodes.mapInPandas(half, "label string, x array<double>, u long, m long, dims int, half binary"), "nodes")
    graph = neighbour_graph(nodes, 1, threshold)
    whole = None
    for extra in range(EXTRA + 2):
        linked, edges, marked = _links(graph, nodes, threshold, whole)
        if extra > EXTRA:
            break
        failed = audit(linked, marked, threshold)
        if failed.isEmpty():
            break
        exact = failed if extra == EXTRA else failed.where(F.col("n") <= AUDITED)
        whole = exact.select("label") if whole is None else whole.union(exact.select("label"))
        again = failed.where(F.col("n") > AUDITED)
        if extra < EXTRA and not again.isEmpty():
            more = neighbour_graph(materialize(nodes.join(again, "label", "left_semi"), "again"), 2 + extra, threshold)
            graph = materialize(_best(graph.union(more)), "graph")
    components = connected_components(edges).withColumnRenamed("node", "u")
    named = nodes.join(linked, "u", "left").join(components, "u", "left")
    named = named.select("label", "x", F.col("m"), F.coalesce("linked", F.lit(0)).alias("linked"), F.coalesce("component", "u").alias("component"))
    joined = rows.join(named.withColumn("live", F.lit(True)), ["label", "x", "live"], "left")
    n_links = F.when(F.col("live") & F.col("m").isNotNull(), F.col("linked") + F.col("m") - 1).otherwise(0).cast("long")
    component = F.when(F.col("m").isNotNull(), F.col("component")).otherwise(F.col("vec_id"))
    kept = F.col("vec_id").isNull() | (component == F.col("vec_id"))
    return joined.select("vec_id", n_links.alias("n_links"), component.alias("component_id"), kept.alias("kept"))
