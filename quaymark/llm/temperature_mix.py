"""Mixing sources to target weights by temperature, realised as budgeted block permutations.

Method.  A source with the token share p gets the weight ``p^a / sum(p^a)``.  The exponent a
is found by bisection, for a target entropy of the weights, or as the smallest one at which
no source is repeated more often than a limit; each step evaluates a grid of exponents in one
aggregation over the sources' totals, so only a few sums reach the driver, however many
sources there are.  A source's budget is its weight of all tokens asked for.  Its documents
are dealt into blocks by a hash; an epoch is one pass over its blocks in a shuffled order.
Whole epochs take every document; the last one takes blocks until the budget is met, and of
the block in which that happens documents in shuffled order, so a source overshoots by less than
one document.  Only block totals are summed in order, so no task sees a whole source.

``place`` runs from 0 to 1 over a source's own budget: sorting by it interleaves all sources
at their weights.  ``epoch`` counts a document's repeats from 0.

Defined results: a null source is a source of its own; null or wordless texts have no tokens and
are left out; an empty table gives an empty result; rows that repeat each other are drawn
together; all columns pass through, and columns named as a result are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from quaymark.session import materialize

WORD = r"[^\x20\x09-\x0D]+"
GRID = 32
STEPS = 5
BLOCK_TOKENS = 1 << 16
MOST_BLOCKS = 1 << 20
_RESULTS = ("epoch", "n_tokens", "place")


def weights_at(totals: DataFrame, exponents: list[float]) -> list[tuple[float, float, float]]:
    """For each exponent: the sum of powered shares, the entropy of the weights, and the largest weight over share.

    ``totals`` has the log share of each source in ``lp``.
    """
    sums = []
    for a in exponents:
        power = F.exp(F.col("lp") * a)
        sums += [F.sum(power), F.sum(power * F.col("lp")), F.max(F.exp(F.col("lp") * (a - 1)))]
    row = totals.agg(*[s.alias(f"s{i}") for i, s in enumerate(sums)]).first()
    found = []
    for i, a in enumerate(exponents):
        z, s, most = row[3 * i : 3 * i + 3]
        found.append((z, math.log(z) - a * s / z, most / z))
    return found


def exponent(totals: DataFrame, epochs: float, entropy: float | None, max_repetition: float | None) -> float:
    """The exponent for the target entropy, raised if need be until no source is repeated more than the limit.

    An entropy that no exponent from 0 to 8 gives is met as nearly as these can.
    """

    def search(low: float, high: float, enough) -> float:
        for _ in range(STEPS):
            grid = [low + (high - low) * i / GRID for i in range(GRID + 1)]
            good = [g for g, w in zip(grid, weights_at(totals, grid)) if enough(w)]
            if not good:
                return high
            if good[0] == low:
                return low
            low, high = good[0] - (high - low) / GRID, good[0]
        return high

    found = 1.0 if entropy is None and max_repetition is None else 0.0
    if entropy is not None:
        found = search(0.0, 8.0, lambda w: w[1] <= entropy)
    if max_repetition is not None and found < 1:
        limit = max(max_repetition, epochs) * (1 + 1e-9)
        found = max(found, search(0.0, 1.0, lambda w: w[2] * epochs <= limit))
    return found


def _uniform(*parts: Column) -> Column:
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 40)) / (1 << 40)


def mix(docs: DataFrame, epochs: float = 1.0, entropy: float | None = None, max_repetition: float | None = None, seed: int = 17) -> DataFrame:
    """The drawn documents, one row for each time a document is drawn, with ``epoch``, ``n_tokens`` and ``place``.

    The budget is ``epochs`` times all tokens of ``docs (doc_id, text, source)``.
    """
    rest = [c for c in docs.columns if c not in _RESULTS]
    source = F.col("source").cast("string")
    rows = docs.select(*rest, F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("n_tokens")).where("n_tokens > 0")
    rows = rows.withColumn("_s", F.struct(source.isNull().alias("none"), F.coalesce(source, F.lit("")).alias("name")))
    totals = materialize(rows.groupBy("_s").agg(F.sum("n_tokens").alias("tokens")), "source_tokens")
    total = totals.agg(F.sum("tokens")).first()[0]
    if not total:
        return rows.drop("_s").select(*rest, F.lit(0).alias("epoch"), "n_tokens", F.lit(0.0).alias("place"))
    shares = totals.withColumn("lp", F.log(F.col("tokens") / total))
    a = exponent(shares, epochs, entropy, max_repetition)
    z = weights_at(shares, [a])[0][0]
    block_tokens = max(BLOCK_TOKENS, total // MOST_BLOCKS)
    budget = F.exp(F.col("lp") * a) / z * epochs * total
    plan = shares.select("_s", "tokens", budget.alias("budget"), F.ceil(F.col("tokens") / block_tokens).cast("int").alias("blocks"))
    plan = plan.withColumn("whole", F.floor(F.col("budget") / F.col("tokens") + 1e-9).cast("int"))
    plan = plan.withColumn("rest", F.greatest(F.col("budget") - F.col("whole") * F.col("tokens"), F.lit(0.0)))
    plan = materialize(plan, "source_plan")
    dealt = rows.join(plan.select("_s", "blocks"), "_s").withColumn("_block", F.pmod(F.xxhash64(F.lit(seed), "doc_id", "n_tokens"), "blocks").cast("int"))
    block_sums = dealt.groupBy("_s", "_block").agg(F.sum("n_tokens").alias("block_tokens"))
    # Blocks in the shuffled order of the last epoch, and how much of each the budget takes.
    order = Window.partitionBy("_s").orderBy(F.xxhash64(F.lit(seed), "_s", "_block"), "_block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    chosen = block_sums.join(plan.select("_s", "rest"), "_s")
    chosen = chosen.withColumn("before", F.sum("block_tokens").over(order) - F.col("block_tokens"))
    chosen = materialize(chosen.withColumn("take", F.least(F.greatest(F.col("rest") - F.col("before"), F.lit(0.0)), F.col("block_tokens"))), "blocks")
    # Of a block that is taken in part, documents in shuffled order.
    cut = chosen.where("take > 1e-6 and take < block_tokens").select("_s", "_block", "take")
    inner = Window.partitionBy("_s", "_block").orderBy("h", "doc_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    within = dealt.select("_s", "_block", F.col("doc_id"), "n_tokens").join(cut, ["_s", "_block"]).withColumn("h", F.xxhash64(F.lit(seed + 1), "doc_id", "n_tokens"))
    within = within.withColumn("before", F.sum("n_tokens").over(inner) - F.col("n_tokens")).where("before < take")
    # The last hash taken: rows up to it are in.
    last = within.groupBy("_s", "_block").agg(F.max(F.struct("h", "doc_id")).alias("last"))
    blocks = chosen.join(last, ["_s", "_block"], "left").select("_s", "_block", "before", F.when(F.col("take") <= 1e-6, 0).when(F.col("take") >= F.col("block_tokens"), 2).otherwise(1).alias("part"), "last")
    blocks = materialize(blocks, "chosen_blocks")
    drawn = dealt.drop("blocks").join(blocks, ["_s", "_block"]).join(plan.select("_s", "tokens", "budget", "whole"), "_s")
    own = F.struct(F.xxhash64(F.lit(seed + 1), "doc_id", "n_tokens").alias("h"), F.col("doc_id").alias("doc_id"))
    again = F.when(F.col("part") == 2, 1).when((F.col("part") == 1) & (own <= F.col("last")), 1).otherwise(0)
    drawn = drawn.withColumn("_times", F.col("whole") + again).where("_times > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("_times") - 1)))
    # Blocks in an order of their own for each epoch, documents in one of theirs inside a block.
    width = F.least(F.lit(block_tokens), F.col("tokens"))
    shuffled = F.when(F.col("epoch") < F.col("whole"), _uniform(F.lit(seed + 3), F.col("epoch"), F.col("_block")) * (F.col("tokens") - width)).otherwise(F.col("before"))
    inside = _uniform(F.lit(seed + 2), F.col("epoch"), F.col("doc_id")) * width
    place = F.least((F.col("epoch") * F.col("tokens") + shuffled + inside) / F.col("budget"), F.lit(1.0))
    return drawn.select(*rest, "epoch", "n_tokens", place.alias("place"))
