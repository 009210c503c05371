"""High-water mark of processed batch ids, for incremental pulls."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from quaymark.sinks.storage import child_names, delete, exists

_MARK = "last="


def last_processed(spark: SparkSession, path: str) -> int:
    """Highest saved batch id, 0 before the first run."""
    done = [
        int(name[len(_MARK):])
        for name in child_names(spark, path)
        if name.startswith(_MARK) and exists(spark, f"{path}/{name}/_SUCCESS")
    ]
    return max(done, default=0)


def save_processed(spark: SparkSession, path: str, batch_id: int) -> None:
    """Record a finished batch; saving the same id again changes nothing."""
    row = spark.range(1).select(F.lit(1).alias("id"), F.lit(batch_id).alias("last_checkid"))
    row.coalesce(1).write.mode("overwrite").parquet(f"{path}/{_MARK}{batch_id}")
    for name in child_names(spark, path):
        if name.startswith(_MARK) and int(name[len(_MARK):]) < batch_id:
            delete(spark, f"{path}/{name}")


def next_batch(table: DataFrame, mark: int, column: str = "checkid") -> int | None:
    """The lowest batch id above the mark, or None; ids need not follow each other."""
    return table.filter(F.col(column) > mark).agg(F.min(column)).first()[0]


def pull_batch(table: DataFrame, batch_id: int, column: str = "checkid") -> DataFrame:
    """Rows of exactly one batch (the filter reaches the scan)."""
    return table.filter(F.col(column) == batch_id)
