"""Compare a query set with all rows of its key, block by block."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from quaymark.session import materialize

QUERY_BLOCK, ROW_BLOCK = 256, 512
MOST_ROWS = 16_384


def _cut(df: DataFrame, keys: list[str], identity: list[str], size: int, prefix: str) -> tuple[DataFrame, DataFrame]:
    """``df`` with a block number, and the number of blocks of each key."""
    counts = df.groupBy(*keys).agg(F.count("*").alias("_n"))
    # Few blocks while they stay small, so that little is repeated; more once 16 would be too large.
    blocks = F.greatest(F.least(F.ceil(F.col("_n") / size), F.lit(16)), F.ceil(F.col("_n") / MOST_ROWS)).cast("int")
    counts = counts.select(*keys, blocks.alias(f"_{prefix}s"))
    numbered = df.join(counts, keys).withColumn(f"_{prefix}", F.pmod(F.xxhash64(*identity), F.col(f"_{prefix}s")).cast("int"))
    return numbered.drop(f"_{prefix}s"), counts


def compare_blocks(
    queries: DataFrame,
    rows: DataFrame,
    keys: list[str],
    identity: list[str],
    function: Callable[[pd.DataFrame, pd.DataFrame], Iterator[pd.DataFrame] | pd.DataFrame],
    schema: str,
    label: str,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """``function(query block, row block)`` for every pair of blocks with the same ``keys``.

    A key's queries are dealt into a block for every ``query_block`` of them, up to 16 while these stay small.

    Both sides are dealt into blocks of at most about ``MOST_ROWS`` rows by a hash of
    ``identity``.  A query block is repeated for each row block of its key and the other
    way round, so no group ever holds more than one block of either side, and what a
    function returns should be much smaller than the pairs it looks at.
    """
    queries, rows = materialize(queries, f"{label}_queries"), materialize(rows, f"{label}_rows")
    left, left_counts = _cut(queries, keys, identity, query_block, "q")
    right, right_counts = _cut(rows, keys, identity, ROW_BLOCK, "r")
    left = left.join(right_counts, keys).withColumn("_r", F.explode(F.sequence(F.lit(0), F.col("_rs") - 1))).drop("_rs")
    right = right.join(left_counts, keys).withColumn("_q", F.explode(F.sequence(F.lit(0), F.col("_qs") - 1))).drop("_qs")
    on = [*keys, "_q", "_r"]

    def run(one: pd.DataFrame, other: pd.DataFrame) -> pd.DataFrame:
        if one.empty or other.empty:
            return pd.DataFrame()
        return function(one, other)

    return left.groupBy(*on).cogroup(right.groupBy(*on)).applyInPandas(run, schema)
