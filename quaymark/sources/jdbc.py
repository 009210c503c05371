"""Parallel reads of database tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_options(
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    partition_column: str | None = None,
    bounds: tuple | None = None,
    partitions: int | None = None,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Options of a read split into ranges of ``partition_column``.

    The bounds only shape the ranges; rows outside them are still read.
    """
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **(properties or {})}
    given = (partition_column is not None, bounds is not None, partitions is not None)
    if any(given):
        if not all(given):
            raise ValueError("partition_column, bounds and partitions belong together")
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    return options


def read_table(spark: SparkSession, url: str, table: str, **kwargs) -> DataFrame:
    return spark.read.format("jdbc").options(**read_options(url, table, **kwargs)).load()
