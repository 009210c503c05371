"""Deduplication, per-group top-N and exact global ranks without a single-task sort."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from quaymark.session import materialize


def keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column] | None = None) -> DataFrame:
    """One row per key, the first by ``order_by`` (default: a hash of the whole row).

    ``row_number() = 1`` is planned as a window group limit on both sides of
    the shuffle, so a key that holds a third of the rows sends one row per task.
    """
    order = list(order_by or [F.xxhash64(*df.columns)])
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_pick", F.row_number().over(w)).filter("_pick = 1").drop("_pick")


def top_per_group(
    df: DataFrame, group: Sequence[str], order_by: Sequence[Column], n: int, rank_name: str
) -> DataFrame:
    """Rows ranked 1..n inside each group; ``order_by`` should end in a unique key."""
    w = Window.partitionBy(*group).orderBy(*order_by)
    return df.withColumn(rank_name, F.row_number().over(w)).filter(F.col(rank_name) <= n)


def top_k(df: DataFrame, order_by: Sequence[Column], k: int) -> DataFrame:
    return df.orderBy(*order_by).limit(k)


def sorted_report(df: DataFrame, *order_by: str) -> DataFrame:
    """A result with few rows (one per label, day or batch) in one sorted partition.

    A global sort would run the stage before it twice, once to sample ranges.
    """
    return df.repartition(1).sortWithinPartitions(*order_by)


def bounded_limit(value: object, default: int, maximum: int | None = None) -> int:
    """Limit argument of a report: the default when not given; a limit that is no positive integer, or above a maximum, raises."""
    if value is None:
        return default
    number = int(str(value))
    if number <= 0 or (maximum is not None and number > maximum):
        raise ValueError(f"limit {number} is not between 1 and {maximum or 'any number'}")
    return number


def with_global_position(
    df: DataFrame, order_by: Sequence[Column], name: str, total: str | None = None
) -> DataFrame:
    """Exact ``row_number() over (order by ...)`` of the whole table, in parallel.

    The table is range-sorted once and written with each row's position inside
    its sorted partition.  Writing freezes the ranges (sampled boundaries may
    differ between two runs of one plan).  The only global step is a running
    sum over one count per partition.  ``order_by`` should end in a unique key:
    it makes the result deterministic and lets the range sort split equal keys.
    """
    stamp = F.monotonically_increasing_id()
    stamped = df.orderBy(*order_by).select("*", stamp.alias("_stamp"))
    stamped = stamped.select(
        *df.columns,
        F.shiftright("_stamp", 33).cast("int").alias("_part"),
        F.col("_stamp").bitwiseAND(F.lit((1 << 33) - 1)).alias("_offset"),
    )
    stamped = materialize(stamped, "ranked")
    # One row per sorted partition: at most spark.sql.shuffle.partitions rows.
    sizes = stamped.groupBy("_part").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    starts = sizes.select(
        "_part",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"),
        F.sum("_n").over(everything).alias("_total"),
    )
    placed = stamped.join(F.broadcast(starts), "_part")
    extra = [F.col("_total").alias(total)] if total else []
    return placed.select(*df.columns, (F.col("_start") + F.col("_offset") + 1).alias(name), *extra)


def with_global_ntile(df: DataFrame, order_by: Sequence[Column], tiles: int, name: str) -> DataFrame:
    """Exact ``ntile(tiles) over (order by ...)`` from the global position."""
    placed = with_global_position(df, order_by, "_pos", total="_all")
    small = F.expr(f"_all div {tiles}")
    larger = F.col("_all") % tiles
    in_larger = larger * (small + 1)
    tile = F.when(
        F.col("_pos") <= in_larger,
        F.floor((F.col("_pos") - 1) / (small + 1)) + 1,
    ).otherwise(larger + F.floor(F.try_divide(F.col("_pos") - 1 - in_larger, small)) + 1)
    return placed.withColumn(name, tile.cast("int")).drop("_pos", "_all")


# --- tiles by selection ------------------------------------------------------
#: Most elements that one step of a selection brings to the driver for one search.
SAMPLE = 16_384

Element = tuple[object, object]


def _ordered(element: Element) -> tuple:
    """Sort key of a (value, key) pair: nulls first, as in an ascending sort."""
    return tuple((part is not None, part) for part in element)


def _pair(df: DataFrame, column: str, key: str, element: Element | None = None) -> Column:
    """The (value, key) pair of a row, or ``element`` in the same types."""
    names = (column, key)
    parts = [F.col(n) if element is None else F.lit(element[i]).cast(df.schema[n].dataType) for i, n in enumerate(names)]
    return F.struct(parts[0].alias("value"), parts[1].alias("key"))


def _narrowed(found: list[Element], rank: int, inside: int, low: Element | None, high: Element | None) -> tuple:
    """A bracket around the element of a rank, from a sample of the elements inside the old one, and its expected size."""
    m = len(found)
    # Never more than half of the sample, so that every step narrows the bracket.
    middle, margin = rank / inside * m, min(4 * m**0.5 + 2, m / 4)
    first, last = math.floor(middle - margin) - 1, math.floor(middle + margin) + 1
    return (found[first] if first >= 0 else low), (found[last] if last < m else high), max(1, round((min(last, m) - max(first, 0)) / m * inside))


def select_ranks(df: DataFrame, wanted: dict[str, list[int]], key: str, sample: int = SAMPLE) -> dict[tuple[str, int], Element]:
    """The (value, key) pair at each wanted rank (from 1) of ``df`` sorted by a column and ``key``, without sorting.

    Every step is one aggregation over ``df``: it counts the rows below and inside the
    bracket of each search exactly and samples those inside by a hash of the key; the
    sample narrows the brackets, to about a tenth or less.  A bracket of at most ``sample`` rows is
    brought in whole and settles its ranks; a bracket that missed its rank is corrected by the
    counts, so the result is exact.  ``df`` is read once a step and should be a written
    table; ``key`` should be unique.
    """
    total = df.count()
    searches = {(c, r): (None, None, total) for c, ranks in wanted.items() for r in ranks if 1 <= r <= total}
    result: dict[tuple[str, int], Element] = {}
    step = 0
    while searches:
        step += 1
        brackets: dict[tuple, int] = {}
        for (column, _), (low, high, expected) in searches.items():
            at = (column, low, high)
            brackets[at] = max(expected, brackets.get(at, 0))
        figures = []
        for i, ((column, low, high), expected) in enumerate(brackets.items()):
            pair = _pair(df, column, key)
            above = F.lit(True) if low is None else pair > _pair(df, column, key, low)
            inside = above if high is None else above & (pair <= _pair(df, column, key, high))
            share = 1.0 if expected <= sample // 2 else sample / 2 / expected
            drawn = F.lit(True) if share == 1.0 else F.pmod(F.xxhash64(key, F.lit(step)), F.lit(1 << 30)) < int(share * (1 << 30))
            figures += [F.count_if(~above).alias(f"below{i}"), F.count_if(inside).alias(f"inside{i}"), F.collect_list(F.when(inside & drawn, pair)).alias(f"drawn{i}")]
        row = df.agg(*figures).first()
        seen = {at: (row[f"below{i}"], row[f"inside{i}"], sorted((tuple(e) for e in row[f"drawn{i}"]), key=_ordered)) for i, at in enumerate(brackets)}
        following = {}
        for (column, rank), (low, high, _) in searches.items():
            below, inside, found = seen[column, low, high]
            if rank <= below:
                following[column, rank] = (None, low, below)
            elif rank > below + inside:
                following[column, rank] = (high, None, total - below - inside)
            elif len(found) == inside:
                result[column, rank] = found[rank - below - 1]
            elif not found:
                following[column, rank] = (low, high, inside)
            else:
                following[column, rank] = _narrowed(found, rank - below, inside, low, high)
        searches = following
    return result


def with_tiles(df: DataFrame, columns: dict[str, str], key: str, tiles: int, sample: int = SAMPLE) -> DataFrame:
    """Exact ``ntile(tiles) over (order by column, key)`` for several columns at once, without a sort or a shuffle.

    ``columns`` maps a new name to the column it ranks.  Only the last row of each tile but
    the last is searched for, see ``select_ranks``; a row's tile follows from comparing it
    with these.  ``df`` should be a written table.
    """
    total = df.count()
    small, larger = divmod(total, tiles)
    ends = [j * small + min(j, larger) for j in range(1, tiles)]
    borders = select_ranks(df, {column: sorted(set(ends)) for column in columns.values()}, key, sample)
    added = {}
    for name, column in columns.items():
        tile = F.lit(1)
        for end in ends:
            if (column, end) in borders:
                tile = tile + F.when(_pair(df, column, key) > _pair(df, column, key, borders[column, end]), 1).otherwise(0)
        added[name] = tile.cast("int")
    return df.withColumns(added)
