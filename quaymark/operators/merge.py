"""Additive merge of keyed aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from quaymark.functions import labels as L


def merge_sums(old: DataFrame | None, new: DataFrame, keys: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """Old and new partial sums added per key; NULL sums count as nothing."""
    both = new if old is None else old.unionByName(new)
    return both.groupBy(*keys).agg(*[F.sum(c).cast("bigint").alias(c) for c in sums])


def weighted_merge(
    old: DataFrame, new: DataFrame, key: str = "community", count: str = "number", mean: str = "averageprice"
) -> DataFrame:
    """Counts added and means combined by their weights, truncated to whole numbers."""
    both = old.select(key, count, mean).unionByName(new.select(key, count, mean))
    weighted = F.sum(F.col(count).cast("decimal(20,0)") * F.col(mean).cast("decimal(12,0)"))
    return both.groupBy(key).agg(
        F.sum(count).cast("bigint").alias(count),
        F.floor(F.try_divide(weighted, F.sum(count).cast("decimal(20,0)"))).cast("bigint").alias(mean),
    )


def running_totals(messages: DataFrame) -> DataFrame:
    """Number and price sum per community of one batch of messages."""
    return messages.filter("community <> ''").groupBy("community").agg(
        F.count("price_per_sqm").alias("number"),
        F.sum(F.col("price_per_sqm").cast("bigint")).alias("price_sum"),
    )


def with_mean(totals: DataFrame) -> DataFrame:
    """Public form of the merge state: the mean truncated to a whole number."""
    return totals.select(
        "community", "number", F.expr("price_sum div number").alias("averageprice")
    )


def watched_result(
    means: DataFrame, district: str = L.WATCHED_DISTRICT, area: str = L.WATCHED_AREA_LABEL
) -> DataFrame:
    """Community means labelled with the district and area range they were filtered to."""
    return means.select(
        F.lit(district).alias("district"), F.lit(area).alias("area"), "community", "number", "averageprice"
    )
