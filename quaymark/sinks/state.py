"""Merge state kept as versioned Parquet snapshots with a ledger of applied batches.

Layout: ``<path>/v=<n>/state`` and ``<path>/v=<n>/ledger``.  The ledger is
written last and its success marker is the commit, so a version that was cut
short is invisible and is overwritten by the next attempt.  The ledger holds
the highest batch id applied of each stream: ids of one stream only rise, and
another stream (or the same job with a new checkpoint) starts again at 0.  A
batch at or below its stream's id is not applied again.  One writer per path.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from quaymark.operators.merge import merge_sums
from quaymark.sinks.storage import child_names, delete, exists

_VERSION = "v="


def versions(spark: SparkSession, path: str) -> list[int]:
    """Committed versions, oldest first."""
    found = [
        int(name[len(_VERSION):])
        for name in child_names(spark, path)
        if name.startswith(_VERSION) and exists(spark, f"{path}/{name}/ledger/_SUCCESS")
    ]
    return sorted(found)


def read_state(spark: SparkSession, path: str) -> DataFrame | None:
    committed = versions(spark, path)
    return spark.read.parquet(f"{path}/v={committed[-1]}/state") if committed else None


def applied_batches(spark: SparkSession, path: str) -> DataFrame | None:
    committed = versions(spark, path)
    return spark.read.parquet(f"{path}/v={committed[-1]}/ledger") if committed else None


def apply_once(
    new: DataFrame,
    path: str,
    keys: Sequence[str],
    sums: Sequence[str],
    batch_id: int,
    keep: int = 2,
    stream: str = "",
) -> bool:
    """Add ``new`` to the state unless this batch of ``stream`` was applied before; True when applied."""
    spark = new.sparkSession
    ledger = applied_batches(spark, path)
    own = F.col("stream") == stream
    if ledger is not None and not ledger.filter(own & (F.col("batch_id") >= batch_id)).isEmpty():
        return False
    committed = versions(spark, path)
    target = f"{path}/v={(committed[-1] + 1) if committed else 0}"
    merged = merge_sums(read_state(spark, path), new.select(*keys, *sums), keys, sums)
    merged.write.mode("overwrite").parquet(f"{target}/state")
    entry = spark.range(1).select(F.lit(stream).alias("stream"), F.lit(batch_id).cast("bigint").alias("batch_id"))
    applied = entry if ledger is None else ledger.filter(~own).unionByName(entry)
    applied.coalesce(1).write.mode("overwrite").parquet(f"{target}/ledger")
    for old in committed[: max(0, len(committed) + 1 - keep)]:
        delete(spark, f"{path}/v={old}")
    return True
