"""Catalogue analyses: yearly trend, price and review, tags and genres, concentration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from quaymark.functions import labels as L
from quaymark.functions.expressions import (
    exact_avg,
    exact_ratio,
    first_below,
    first_reached,
    flag,
    in_closed_ranges,
    list_items,
)
from quaymark.operators.ranking import top_k
from quaymark.session import materialize


def total_of(df: DataFrame, column: str) -> Column:
    """Grand total as an in-plan scalar subquery: no driver action, NULL on empty input."""
    return df.agg(F.sum(column).alias("total")).scalar()


# --- yearly trend ------------------------------------------------------------
def market_trend(items: DataFrame) -> DataFrame:
    """Releases per year with averages and year-on-year growth.

    The ordered window has no partition key; it runs over one row per release
    year, a domain the cleaning step limits to a few dozen years.
    """
    yearly = items.groupBy(F.col("release_year").alias("year")).agg(
        F.count("*").alias("release_count"),
        exact_avg(F.col("owners_numeric"), 0).alias("avg_owners"),
        exact_avg(F.col("Price"), 2).alias("avg_price"),
        exact_avg(F.col("Average_playtime_forever"), 0).alias("avg_playtime"),
        F.sum("Recommendations").alias("total_recommendations"),
    )
    previous = F.lag("release_count", 1).over(Window.orderBy("year"))
    growth = exact_ratio(F.col("release_count") - F.col("_prev"), F.col("_prev"), 2, times=100)
    return (
        yearly.withColumn("_prev", previous)
        .withColumn("yoy_growth_pct", F.coalesce(growth, F.lit(0).cast("decimal(18,2)")))
        .withColumn(
            "yoy_growth_category",
            first_reached(F.col("yoy_growth_pct"), L.GROWTH_STEPS, L.GROWTH_LOWEST, strict=True),
        )
        .drop("_prev")
        .orderBy("year")
    )


# --- price and review --------------------------------------------------------
def with_price_bucket(items: DataFrame, strict_gaps: bool = False) -> DataFrame:
    """Six price labels over contiguous bounds.

    ``strict_gaps`` keeps the printed upper ends, so a price between two
    labels (4.995) or below zero falls to the top label.
    """
    price = F.col("Price")
    bucket = F.when(price == 0 if strict_gaps else price <= 0, L.PRICE_FREE)
    uppers = [low for _, low, _ in L.PRICE_BUCKETS[1:]] + [L.PRICE_TOP.rstrip("+")]
    for (label, low, high), upper in zip(L.PRICE_BUCKETS, uppers):
        low_number = F.lit(low).cast("decimal(18,2)")
        above = price > low_number if low == "0" else price >= low_number
        if strict_gaps:
            bucket = bucket.when(above & (price <= F.lit(high).cast("decimal(18,2)")), label)
        else:
            bucket = bucket.when(above & (price < F.lit(upper).cast("decimal(18,2)")), label)
    return items.withColumn("price_bucket", bucket.otherwise(L.PRICE_TOP))


def with_positive_rate(items: DataFrame) -> DataFrame:
    """Review total and share of positive reviews, one half when there are none.

    Twelve fixed decimals keep later averages independent of addition order.
    """
    total = F.col("Positive") + F.col("Negative")
    rate = F.round(
        F.try_divide(F.col("Positive").cast("decimal(20,0)"), F.col("total_reviews").cast("decimal(20,0)")), 12
    ).cast("decimal(18,12)")
    neutral = F.lit(L.NEUTRAL_RATE).cast("decimal(18,12)")
    return items.withColumn("total_reviews", total).withColumn(
        "positive_rate", F.when(F.col("total_reviews") > 0, rate).otherwise(neutral)
    )


def price_review(items: DataFrame, strict_gaps: bool = False) -> DataFrame:
    """Per price bucket: counts, averages and shares of all items and owners."""
    prepared = with_positive_rate(with_price_bucket(items, strict_gaps))
    rate_sum = F.sum("positive_rate")
    buckets = prepared.groupBy("price_bucket").agg(
        F.count("*").alias("game_count"),
        F.round(F.try_divide(rate_sum * 100, F.count("positive_rate").cast("decimal(20,0)")), 2).alias(
            "avg_positive_rate_pct"
        ),
        exact_avg(F.col("Metacritic_score"), 1).alias("avg_metacritic_score"),
        exact_avg(F.col("Recommendations"), 0).alias("avg_recommendations"),
        exact_avg(F.col("owners_numeric"), 0).alias("avg_owners"),
        exact_avg(F.col("Price"), 2).alias("avg_price_in_bucket"),
        F.sum("owners_numeric").alias("total_owners"),
    )
    # At most six rows reach these unpartitioned totals.
    whole = Window.partitionBy()
    all_games = F.sum("game_count").over(whole)
    all_owners = F.floor(F.sum("total_owners").over(whole))
    return (
        buckets.withColumn("game_pct", exact_ratio(F.col("game_count"), all_games, 2, times=100))
        .withColumn("owners_share_pct", exact_ratio(F.col("total_owners"), all_owners, 2, times=100))
        .orderBy(F.desc("game_count"), "price_bucket")
    )


def best_value(
    items: DataFrame,
    min_rate: float = 0.85,
    min_recommendations: int = 5000,
    max_price: float = 19.99,
    min_reviews: int = 100,
    k: int = 20,
) -> DataFrame:
    """Well reviewed, widely recommended, cheap items; the best ``k`` of them."""
    chosen = with_positive_rate(items).filter(
        (F.col("positive_rate") >= F.lit(str(min_rate)).cast("decimal(18,12)"))
        & (F.col("Recommendations") >= min_recommendations)
        & (F.col("Price") <= F.lit(str(max_price)).cast("decimal(18,2)"))
        & (F.col("total_reviews") >= min_reviews)
    )
    return top_k(chosen, [F.desc("positive_rate"), F.desc("Recommendations"), F.asc("AppID")], k)


# --- genres and tags ---------------------------------------------------------
def explode_list(df: DataFrame, column: str, name: str) -> DataFrame:
    """One row per item of a list text; the source column is not carried along.

    The outer form with a filter: for a plain ``explode`` the optimizer adds a
    size test before it, which would parse every text a second time.
    """
    exploded = df.withColumn(name, F.explode_outer(list_items(F.col(column)))).drop(column)
    return exploded.filter(F.col(name).isNotNull())


def genre_distribution(items: DataFrame) -> DataFrame:
    return (
        explode_list(items.select("Genres", "owners_numeric"), "Genres", "genre")
        .groupBy("genre")
        .agg(F.count("*").alias("count"), exact_avg(F.col("owners_numeric"), 0).alias("avg_owners"))
        .orderBy(F.desc("count"), "genre")
    )


def tag_distribution(items: DataFrame, k: int = 50) -> DataFrame:
    tags = explode_list(items.select("AppID", "Tags", "owners_numeric"), "Tags", "tag")
    counted = tags.groupBy("tag").agg(
        F.count("*").alias("frequency"),
        exact_avg(F.col("owners_numeric"), 0).alias("avg_owners"),
        F.countDistinct("AppID").alias("total_games"),
    )
    return top_k(counted, [F.desc("frequency"), F.asc("tag")], k)


def top_selling_genres(items: DataFrame) -> DataFrame:
    return (
        explode_list(items.select("Genres", "owners_numeric"), "Genres", "genre")
        .groupBy("genre")
        .agg(
            F.count("*").alias("total_games"),
            exact_avg(F.col("owners_numeric"), 0).alias("avg_owners"),
            F.round(F.sum("owners_numeric"), 0).alias("total_owners"),
        )
        .orderBy(F.desc("avg_owners"), "genre")
    )


# --- developers, publishers, platforms --------------------------------------
def concentration_label(index: Column) -> Column:
    return first_below(index, L.CONCENTRATION_STEPS, L.CONCENTRATION_HIGHEST)


def _with_market_share(grouped: DataFrame, label: str) -> DataFrame:
    """Share of all owners per group.

    The one-row-per-group table is written out, so the grand total is read
    from it instead of from a second pass over the items.
    """
    stored = materialize(grouped, label)
    total = F.floor(total_of(stored, "total_owners"))
    return stored.withColumn(
        "market_share_pct", exact_ratio(F.col("total_owners"), total, 4, times=100)
    )


def developer_totals(items: DataFrame) -> DataFrame:
    """Per developer: items, owners, averages, distinct genre texts, platforms, market share.

    Platform counts are averaged in the same aggregation, so items are grouped
    once; a null developer has no platform figure, as an outer join on the
    name would leave it.
    """
    grouped = items.groupBy(F.col("Developers").alias("developer")).agg(
        F.count("*").alias("game_count"),
        F.sum("owners_numeric").alias("total_owners"),
        exact_avg(F.col("Price"), 2).alias("avg_price"),
        exact_avg(F.col("Metacritic_score"), 1).alias("avg_metacritic"),
        F.countDistinct("Genres").alias("genre_diversity"),
        exact_avg(platform_count(), 1).alias("platform_diversity"),
    )
    diversity = F.when(F.col("developer").isNotNull(), F.col("platform_diversity"))
    return _with_market_share(grouped.withColumn("platform_diversity", diversity), "developers")


def publisher_totals(items: DataFrame) -> DataFrame:
    grouped = items.groupBy(F.col("Publishers").alias("publisher")).agg(
        F.count("*").alias("game_count"),
        F.sum("owners_numeric").alias("total_owners"),
        exact_avg(F.col("Price"), 2).alias("avg_price"),
    )
    return _with_market_share(grouped, "publishers")


def publisher_ranking(items: DataFrame, k: int = 50) -> DataFrame:
    return top_k(
        publisher_totals(items), [F.desc("game_count"), F.asc_nulls_first("publisher")], k
    )


def developer_genres(items: DataFrame) -> DataFrame:
    """Distinct single genres per developer (the ranking counts distinct genre texts)."""
    return (
        explode_list(items.select("Developers", "Genres"), "Genres", "genre")
        .groupBy(F.col("Developers").alias("developer"))
        .agg(F.countDistinct("genre").alias("genre_count"))
    )


def concentration(ranked: DataFrame) -> DataFrame:
    """One row: sum of squared market shares and its label."""
    share = F.col("market_share_pct").cast("decimal(12,4)")
    return ranked.agg(
        F.round(F.coalesce(F.sum(share * share), F.lit(0)), 0).cast("double").alias("market_hhi")
    ).withColumn("market_structure", concentration_label(F.col("market_hhi")))


def platform_count() -> Column:
    return flag(F.col("Windows")) + flag(F.col("Mac")) + flag(F.col("Linux"))


def developer_ecosystem(items: DataFrame, k: int = 50) -> DataFrame:
    """Largest developers with platform diversity and the concentration of that list."""
    ranked = top_k(
        developer_totals(items), [F.desc("game_count"), F.asc_nulls_first("developer")], k
    )
    share = F.col("market_share_pct").cast("decimal(12,4)")
    # At most k rows reach this unpartitioned sum.
    index = F.round(F.sum(share * share).over(Window.partitionBy()), 0).cast("double")
    return ranked.withColumn("market_hhi", index).withColumn(
        "market_structure", concentration_label(F.col("market_hhi"))
    )


def platform_categories(items: DataFrame) -> DataFrame:
    count = platform_count()
    category = (
        F.when(count >= 3, L.PLATFORM_LABELS[3])
        .when(count == 2, L.PLATFORM_LABELS[2])
        .when(count == 1, L.PLATFORM_LABELS[1])
        .otherwise(L.PLATFORM_NONE)
    )
    return (
        items.groupBy(category.alias("platform_category"))
        .agg(F.count("*").alias("game_count"), exact_avg(F.col("owners_numeric"), 0).alias("avg_owners"))
        .orderBy(F.desc("game_count"), "platform_category")
    )


def developer_classes(items: DataFrame) -> DataFrame:
    """Developers by number of items; class averages are averages of developer averages."""
    per_developer = items.groupBy("Developers").agg(
        F.count("*").alias("game_count"),
        exact_avg(F.col("Price"), 2).alias("avg_price"),
        exact_avg(F.col("Metacritic_score"), 1).alias("avg_metacritic"),
    )
    size = in_closed_ranges(F.col("game_count"), L.DEVELOPER_SIZES, L.DEVELOPER_LARGEST)
    return (
        per_developer.groupBy(size.alias("developer_category"))
        .agg(
            F.count("*").alias("developer_count"),
            F.sum("game_count").alias("total_games"),
            exact_avg(F.col("avg_price"), 2).alias("avg_game_price"),
            exact_avg(F.col("avg_metacritic"), 1).alias("avg_metacritic"),
        )
        .orderBy(F.desc("developer_count"), "developer_category")
    )


def overview(items: DataFrame) -> DataFrame:
    """Item count, release years, share of free items and the largest developer.

    The largest developer is read from one row per developer, ordered by the
    pair (count, name), so no scan order can change it.
    """
    top = (
        items.groupBy("Developers")
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), F.asc_nulls_last("Developers"))
        .limit(1)
        .select("Developers")
    )
    return items.agg(
        F.count("*").alias("total_games"),
        F.countDistinct("release_year").alias("total_years"),
        exact_ratio(F.count_if(F.col("Price") == 0), F.count("*"), 4, times=100).alias("free_games_pct"),
    ).withColumn("top_developer", top.scalar())
