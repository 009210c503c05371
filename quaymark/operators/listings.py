"""Listing analyses by area, district, build year and community."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from quaymark.functions import labels as L
from quaymark.functions.expressions import (
    exact_ratio,
    first_below,
    in_ranges,
    room_count,
)
from quaymark.operators.ranking import sorted_report, top_k


def _usable(listings: DataFrame) -> DataFrame:
    return listings.filter("area > 0 and price_per_sqm > 0")


def price_statistics(listings: DataFrame, keys: Sequence[str], accuracy: int | None = None) -> DataFrame:
    """Count, mean, extremes, median, variance, deviation, mean age and mean area per key.

    Listings are first counted per key and unit price.  That histogram is
    small (unit prices are whole numbers), is combined before the shuffle
    however large one key is, and gives the exact lower median.  With
    ``accuracy`` the median comes from ``percentile_approx`` instead.
    Means are truncated to whole numbers; variance is NULL for a single row.
    """
    price = F.col("price_per_sqm").cast("bigint")
    histogram = listings.groupBy(*keys, price.alias("_p")).agg(
        F.count("*").alias("_n"),
        F.sum("house_age").alias("_age_sum"),
        F.count("house_age").alias("_age_n"),
        F.sum("area").alias("_area_sum"),
    )
    by_key = Window.partitionBy(*keys)
    seen = by_key.orderBy("_p").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = histogram.select(
        *keys,
        "_p",
        "_n",
        "_age_sum",
        "_age_n",
        "_area_sum",
        F.sum("_n").over(seen).alias("_seen"),
        F.sum("_n").over(by_key).alias("_total"),
    )
    variance = _whole_variance(F.col("_p"), F.col("_n"))
    if accuracy is None:
        median = F.min(F.when(F.col("_seen") * 2 >= F.col("_total"), F.col("_p")))
    else:
        median = F.lit(None).cast("bigint")
    stats = ranked.groupBy(*keys).agg(
        F.sum("_n").alias("house_count"),
        _whole_mean(F.sum(F.col("_p") * F.col("_n")), F.sum("_n")).alias("avg_price_per_sqm"),
        F.min("_p").alias("min_price"),
        F.max("_p").alias("max_price"),
        median.alias("median_price"),
        variance.alias("price_variance"),
        F.floor(F.sqrt(variance)).alias("price_stddev"),
        _whole_mean(F.sum("_age_sum"), F.sum("_age_n")).alias("avg_house_age"),
        _whole_mean(F.sum("_area_sum"), F.sum("_n")).alias("avg_area"),
    )
    if accuracy is not None:
        approximate = listings.groupBy(*keys).agg(
            F.percentile_approx(price, 0.5, accuracy).cast("bigint").alias("median_price")
        )
        stats = stats.drop("median_price").join(approximate, list(keys))
    return stats


def _whole_variance(value: Column, count: Column) -> Column:
    """Sample variance of whole numbers with their counts, truncated; NULL for a single row.

    ``(n * sum(x^2) - sum(x)^2) / (n * (n - 1))`` in whole numbers, so the order of
    addition cannot change it.  NULL where a sum has over 38 digits.
    """
    x, n = value.cast("decimal(19,0)"), count.cast("decimal(19,0)")
    total = F.sum(count).cast("decimal(19,0)")
    linear = F.try_sum(F.try_multiply(x, n))
    squares = F.try_sum(F.try_multiply(F.try_multiply(x, x), n))
    spread = F.try_subtract(F.try_multiply(squares, total), F.try_multiply(linear, linear))
    return F.floor(F.try_divide(spread, F.try_multiply(total, total - 1))).try_cast("bigint")


def _whole_mean(total: Column, count: Column) -> Column:
    """Mean truncated towards zero."""
    whole = F.try_divide(total.cast("decimal(28,2)"), count.cast("decimal(20,0)"))
    return F.when(whole < 0, F.ceil(whole)).otherwise(F.floor(whole)).cast("bigint")


#: Nearest values a sketch keeps, and the rank error that its quantiles stay within (about thrice the expected one).
SKETCH_SIZE = 400
RANK_ERROR = 0.02


def price_sketches(listings: DataFrame, keys: Sequence[str] = ("district",), batch: str = "checkid", size: int = SKETCH_SIZE) -> DataFrame:
    """A quantile sketch of the unit prices per key and batch, some kilobytes however many listings there are.

    Stored by batch, the sketches of old batches answer for their listings; only a new batch is read.
    Listings without a price, or of no positive area or price, are left out.
    """
    prices = F.kll_sketch_agg_bigint(F.col("price_per_sqm").cast("bigint"), F.lit(size))
    return _usable(listings).groupBy(*keys, batch).agg(prices.alias("price_sketch"))


def merged_quantiles(sketches: DataFrame, keys: Sequence[str] = ("district",), probabilities: Sequence[float] = (0.5,), size: int = SKETCH_SIZE) -> DataFrame:
    """Count of listings and price quantiles per key over all batches, from their sketches alone.

    The quantiles are prices that occur, in the order of ``probabilities``; their ranks are within
    ``RANK_ERROR`` of the ones asked for, at the size that is the default.
    """
    merged = sketches.groupBy(*keys).agg(F.kll_merge_agg_bigint("price_sketch", F.lit(size)).alias("_s"))
    asked = F.array(*[F.lit(float(p)) for p in probabilities])
    return merged.select(*keys, F.kll_sketch_get_n_bigint("_s").alias("house_count"), F.kll_sketch_get_quantile_bigint("_s", asked).alias("price_quantiles"))


def price_ranks(listings: DataFrame, prices: DataFrame, keys: Sequence[str] = ("district",), price: str = "price") -> DataFrame:
    """``prices`` with the exact shares of its key's listings that are cheaper, and that are not dearer."""
    counted = _usable(listings).groupBy(*keys, F.col("price_per_sqm").cast("bigint").alias("_p")).agg(F.count("*").alias("_n"))
    below, upto = (F.sum(F.when(c, F.col("_n")).otherwise(0)) for c in (F.col("_p") < F.col(price), F.col("_p") <= F.col(price)))
    shares = counted.join(prices, list(keys)).groupBy(*keys, price).agg(
        (below / F.sum("_n")).alias("share_below"), (upto / F.sum("_n")).alias("share_upto")
    )
    return prices.join(shares, [*keys, price])


def area_price(listings: DataFrame, accuracy: int | None = None) -> DataFrame:
    """Price statistics per area range and batch.

    The share is of all usable listings, including those in no range.
    """
    ranged = _usable(listings).withColumn(
        "area_range", in_ranges(F.col("area"), L.AREA_EDGES, L.AREA_LABELS, otherwise=L.UNKNOWN)
    )
    stats = price_statistics(ranged, ["area_range", "checkid"], accuracy)
    # One row per range and batch reaches this unpartitioned total.
    everything = F.sum("house_count").over(Window.partitionBy())
    result = (
        stats.withColumn("area_ratio", exact_ratio(F.col("house_count"), everything, 2, times=100))
        .filter(F.col("area_range") != L.UNKNOWN)
        .withColumn(
            "price_level",
            first_below(F.col("avg_price_per_sqm"), L.PRICE_LEVEL_STEPS, L.PRICE_LEVEL_HIGHEST),
        )
        .drop("avg_area")
    )
    return sorted_report(result, "area_range", "checkid")


def district_price(listings: DataFrame, accuracy: int | None = None) -> DataFrame:
    named = _usable(listings).filter("district <> ''")
    stats = price_statistics(named, ["district", "checkid"], accuracy)
    return sorted_report(stats.withColumnRenamed("price_stddev", "std_price"), "district", "checkid")


def year_layout(listings: DataFrame, multi_digit_rooms: bool = False) -> DataFrame:
    """Elevators, layout sizes and decoration per build-year range and batch."""
    year = F.col("build_year").try_cast("int")
    rooms = F.col("_rooms")
    decorated = F.col("decoration")
    result = (
        listings.withColumn(
            "year_range", in_ranges(year, L.YEAR_EDGES, L.YEAR_LABELS, last_inclusive=True)
        )
        .filter("year_range is not null")
        .withColumn("_rooms", room_count(F.col("layout"), L.ROOM_MARK, multi_digit_rooms))
        .groupBy("year_range", "checkid")
        .agg(
            F.count("*").alias("house_count"),
            F.sum("elevator_int").alias("elevator_count"),
            F.count_if(rooms.between(1, 2)).alias("small_layout_count"),
            F.count_if(rooms.between(3, 4)).alias("medium_layout_count"),
            F.count_if((rooms >= 5) | (rooms == -1)).alias("large_layout_count"),
            F.count_if(decorated == L.DECORATION_PREMIUM).alias("premium_decoration_count"),
            F.count_if(decorated == L.DECORATION_SIMPLE).alias("simple_decoration_count"),
            F.count_if(decorated == L.DECORATION_ROUGH).alias("rough_decoration_count"),
        )
    )
    return sorted_report(result, "year_range", "checkid")


def community_price(listings: DataFrame) -> DataFrame:
    """Count, mean unit price and span of build years per community and batch."""
    oldest, newest = F.min("build_year"), F.max("build_year")
    span = F.when(oldest == newest, oldest).otherwise(F.concat_ws("-", oldest, newest))
    return (
        listings.filter("district <> '' and community <> '' and price_per_sqm > 0")
        .groupBy("district", "community", "checkid")
        .agg(
            F.count("*").alias("house_count"),
            _whole_mean(F.sum("price_per_sqm"), F.count("price_per_sqm")).alias("avg_price_per_sqm"),
            span.alias("build_year"),
        )
        .orderBy("district", "community", "checkid")
    )


def community_top(communities: DataFrame, k: int = 20) -> DataFrame:
    order = [F.desc("avg_price_per_sqm"), F.asc("district"), F.asc("community"), F.asc("checkid")]
    return top_k(communities, order, k)


def area_level_matrix(areas: DataFrame) -> DataFrame:
    """Mean price by area range (rows) and price level (columns), 0 where empty.

    Of several batches in one cell the lowest batch id is shown.
    """
    first = F.min_by("avg_price_per_sqm", "checkid")
    return (
        areas.groupBy("area_range").pivot("price_level", L.PRICE_LEVEL_ORDER).agg(first).fillna(0)
    )


def layout_share(years: DataFrame) -> DataFrame:
    """Percent of small, medium and large layouts within a build-year range."""
    parts = ["small_layout_count", "medium_layout_count", "large_layout_count"]
    whole = F.col(parts[0]) + F.col(parts[1]) + F.col(parts[2])
    zero = F.lit(0).cast("decimal(5,1)")
    shares = [
        F.coalesce(exact_ratio(F.col(p), whole, 1, times=100).cast("decimal(5,1)"), zero).alias(
            p.replace("_count", "_pct")
        )
        for p in parts
    ]
    return years.select("year_range", "checkid", *shares)


def watched_messages(
    listings: DataFrame,
    district: str | None = L.WATCHED_DISTRICT,
    area: tuple[int, int] = L.WATCHED_AREA,
) -> DataFrame:
    """(checkid, community, price_per_sqm) of one district (None: all) and area range."""
    watched = listings if district is None else listings.filter(F.col("district") == district)
    return watched.filter(
        (F.col("area") >= area[0])
        & (F.col("area") < area[1])
        & (F.col("community") != "")
        & (F.col("price_per_sqm") > 0)
    ).select("checkid", "community", "price_per_sqm")
