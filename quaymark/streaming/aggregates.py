"""Aggregations over event streams; each also accepts a batch frame."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from quaymark.functions.expressions import MONEY, exact_ratio, list_items


def category_window_sales(
    events: DataFrame,
    duration: str = "1 minute",
    slide: str | None = "30 seconds",
    watermark: str | None = "2 minutes",
) -> DataFrame:
    """Order count and amount per sliding event-time window and category.

    The watermark bounds the state in ``update`` and ``append`` mode; in
    ``complete`` mode Spark keeps every window.  No slide means tumbling.
    """
    if watermark and events.isStreaming:
        events = events.withWatermark("event_ts", watermark)
    return (
        events.groupBy(F.window("event_ts", duration, slide), "category")
        .agg(F.count(F.lit(1)).alias("order_count"), F.sum("pay_amount").alias("pay_amount"))
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "category",
            "order_count",
            F.col("pay_amount").cast(MONEY).alias("pay_amount"),
        )
    )


def _kpi_sums():
    return [
        F.count("*").alias("new_games_count"),
        F.sum(F.col("price").cast(MONEY)).alias("_price"),
        F.count("price").alias("_prices"),
        F.sum("estimated_owners").alias("_owners"),
        F.count("estimated_owners").alias("_owner_rows"),
        F.coalesce(F.sum("positive"), F.lit(0)).alias("_positive"),
        F.coalesce(F.sum("negative"), F.lit(0)).alias("_negative"),
    ]


def _kpi_columns():
    reviews = F.col("_positive") + F.col("_negative") + 1
    return [
        "new_games_count",
        exact_ratio(F.col("_price"), F.col("_prices"), 2).alias("avg_price"),
        F.expr("try_divide(_owners, _owner_rows)").cast("bigint").alias("avg_owners"),
        exact_ratio(F.col("_positive"), reviews, 1, times=100).alias("avg_positive_rate"),
    ]


def cumulative_kpis(events: DataFrame) -> DataFrame:
    """Items so far, mean price, mean owners (truncated) and positive rate (one added to the total).

    All sums live in the stream's own state, so a restart continues them.
    """
    return events.groupBy().agg(*_kpi_sums()).select(*_kpi_columns())


def windowed_kpis(events: DataFrame, duration: str, slide: str | None = None, watermark: str | None = None) -> DataFrame:
    """The same figures per event-time window."""
    if watermark and events.isStreaming:
        events = events.withWatermark("timestamp", watermark)
    return (
        events.groupBy(F.window("timestamp", duration, slide))
        .agg(*_kpi_sums())
        .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *_kpi_columns())
    )


def genre_window_counts(
    events: DataFrame, duration: str, slide: str | None = None, watermark: str | None = None
) -> DataFrame:
    """Items per genre and event-time window."""
    if watermark and events.isStreaming:
        events = events.withWatermark("timestamp", watermark)
    return (
        events.select("timestamp", F.explode_outer(list_items(F.col("genres"))).alias("genre"))
        .filter("genre is not null")
        .groupBy(F.window("timestamp", duration, slide), "genre")
        .agg(F.count("*").alias("count"))
        .select(
            "genre",
            "count",
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
        )
    )
