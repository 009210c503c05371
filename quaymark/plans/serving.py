"""Reports read from the result tables, as DataFrame queries over them."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from quaymark.functions import labels as L
from quaymark.functions.expressions import enum_position, exact_avg, exact_ratio
from quaymark.operators.ranking import bounded_limit, top_k
from quaymark.sources.files import register_views


# --- sales -------------------------------------------------------------------
def sales_summary(trend: DataFrame) -> DataFrame:
    """Totals of the hourly table; ``user_hours`` counts a user once per hour with an order."""
    zero = F.lit(0)
    ratio = exact_ratio(F.sum("pay_amount"), F.sum("order_count"), 2)
    return trend.agg(
        F.coalesce(F.sum("order_count"), zero).alias("order_count"),
        F.coalesce(F.sum("user_count"), zero).alias("user_hours"),
        F.coalesce(F.sum("total_amount"), zero).alias("total_amount"),
        F.coalesce(F.sum("discount_amount"), zero).alias("discount_amount"),
        F.coalesce(F.sum("pay_amount"), zero).alias("pay_amount"),
        F.coalesce(ratio, zero).alias("avg_order_amount"),
        F.date_format(F.min("stat_date"), L.DATE_FORMAT).alias("start_date"),
        F.date_format(F.max("stat_date"), L.DATE_FORMAT).alias("end_date"),
    )


def distinct_users(valid: DataFrame) -> DataFrame:
    """Users counted once over the whole period, which the hourly table cannot tell."""
    return valid.agg(F.countDistinct("user_id").alias("user_count"))


def sales_daily(trend: DataFrame) -> DataFrame:
    return (
        trend.groupBy("stat_date")
        .agg(
            F.sum("order_count").alias("order_count"),
            F.sum("user_count").alias("user_hours"),
            F.sum("total_amount").alias("total_amount"),
            F.sum("discount_amount").alias("discount_amount"),
            F.sum("pay_amount").alias("pay_amount"),
            exact_ratio(F.sum("pay_amount"), F.sum("order_count"), 2).alias("avg_order_amount"),
        )
        .orderBy("stat_date")
    )


def sales_hourly(trend: DataFrame) -> DataFrame:
    return (
        trend.groupBy("stat_hour")
        .agg(F.sum("order_count").alias("order_count"), F.sum("pay_amount").alias("pay_amount"))
        .withColumn("stat_hour_label", F.lpad(F.col("stat_hour").cast("string"), 2, "0"))
        .orderBy("stat_hour")
    )


def category_top(ranked: DataFrame, limit: object = 10, maximum: int | None = None) -> DataFrame:
    """Categories over all days, from the rows that made their day's top list."""
    totals = ranked.groupBy("category").agg(
        F.sum("order_count").alias("order_count"),
        F.sum("quantity_sum").alias("quantity_sum"),
        F.sum("amount_sum").alias("amount_sum"),
        exact_ratio(F.sum("amount_sum"), F.sum("quantity_sum"), 2).alias("avg_unit_amount"),
        F.max("category_rank").alias("max_daily_rank"),
    )
    order = [F.desc("amount_sum"), F.desc("quantity_sum"), F.asc("category")]
    return top_k(totals, order, bounded_limit(limit, 10, maximum))


# --- users -------------------------------------------------------------------
def user_value_summary(users: DataFrame) -> DataFrame:
    return users.agg(
        F.count("*").alias("user_count"),
        exact_avg(F.col("recency_days"), 2).alias("avg_recency_days"),
        exact_avg(F.col("frequency"), 2).alias("avg_frequency"),
        exact_avg(F.col("monetary"), 2).alias("avg_monetary"),
    )


def user_levels(users: DataFrame) -> DataFrame:
    """Users per level with their share, best level first."""
    levels = users.groupBy("user_level").agg(
        F.count("*").alias("user_count"),
        exact_avg(F.col("monetary"), 2).alias("avg_monetary"),
        exact_avg(F.col("frequency"), 2).alias("avg_frequency"),
    )
    # At most one row per level reaches this unpartitioned total.
    everyone = F.sum("user_count").over(Window.partitionBy())
    return levels.withColumn("user_ratio", exact_ratio(F.col("user_count"), everyone, 4)).orderBy(
        enum_position(F.col("user_level"), L.USER_LEVEL_ORDER)
    )


def member_levels(users: DataFrame) -> DataFrame:
    member = F.coalesce(F.col("member_level"), F.lit(L.UNKNOWN))
    return (
        users.groupBy(member.alias("member_level"), "user_level")
        .agg(F.count("*").alias("user_count"))
        .orderBy(
            enum_position(F.col("member_level"), L.MEMBER_LEVEL_ORDER),
            enum_position(F.col("user_level"), L.USER_LEVEL_ORDER),
        )
    )


def member_matrix(users: DataFrame) -> DataFrame:
    """Users by member level (rows) and value level (columns), 0 where nobody is."""
    return (
        member_levels(users)
        .groupBy("member_level")
        .pivot("user_level", L.USER_LEVEL_ORDER)
        .agg(F.sum("user_count"))
        .fillna(0)
    )


# --- rules -------------------------------------------------------------------
def top_rules(rules: DataFrame, limit: object = 10, maximum: int | None = None) -> DataFrame:
    order = [F.desc("lift"), F.desc("confidence"), F.desc("support"), F.asc("antecedent"), F.asc("consequent")]
    return top_k(rules, order, bounded_limit(limit, 10, maximum))


# --- stream windows ----------------------------------------------------------
def window_summary(sales: DataFrame) -> DataFrame:
    return sales.agg(F.max("window_end").alias("latest_window_end"), F.max("batch_id").alias("latest_batch_id"))


def latest_window(sales: DataFrame, limit: object = 20, maximum: int | None = None) -> DataFrame:
    newest = sales.agg(F.max("window_end").alias("latest")).scalar()
    order = [F.desc("pay_amount"), F.desc("order_count"), F.asc("category")]
    return top_k(sales.filter(F.col("window_end") == newest), order, bounded_limit(limit, 20, maximum))


def recent_windows(sales: DataFrame, limit: object = 20, maximum: int | None = None) -> DataFrame:
    order = [F.desc("window_end"), F.desc("pay_amount"), F.asc("category")]
    return top_k(sales, order, bounded_limit(limit, 20, maximum))


def window_trend(sales: DataFrame, windows: int = 20) -> DataFrame:
    """Totals of the last windows, oldest first."""
    totals = sales.groupBy("window_end").agg(
        F.sum("order_count").alias("order_count"), F.sum("pay_amount").alias("pay_amount")
    )
    return top_k(totals, [F.desc("window_end")], windows).orderBy("window_end")


def latest_rows(
    spark: SparkSession, view: str, n: int = 1, schema: str | None = None, by: str = "window_end", *ties: str
) -> DataFrame:
    """The last ``n`` rows of a result view by a column, equals by ``ties``; an empty frame if there is no such view."""
    if not spark.catalog.tableExists(view):
        return spark.createDataFrame([], schema or f"{by} timestamp")
    return top_k(spark.table(view), [F.desc(by), *[F.asc(c) for c in ties]], n)


def top_genres(counts: DataFrame, k: int = 10) -> DataFrame:
    return top_k(counts, [F.desc("count"), F.desc("window_end"), F.asc("genre")], k)


def has_rows(df: DataFrame) -> bool:
    return not df.isEmpty()


# --- catalogue ---------------------------------------------------------------
def market_trend_listing(trend: DataFrame) -> DataFrame:
    return trend.select(
        "year",
        "release_count",
        "avg_owners",
        "avg_price",
        "avg_playtime",
        "yoy_growth_pct",
        "yoy_growth_category",
    ).orderBy("year")


def market_trend_summary(trend: DataFrame) -> DataFrame:
    """Busiest year (the earliest of equals), its count, mean per year, growth of the last year."""
    return trend.agg(
        F.max_by("year", F.struct("release_count", (-F.col("year")).alias("early"))).alias("peak_year"),
        F.max("release_count").alias("peak_count"),
        exact_avg(F.col("release_count"), 0).cast("bigint").alias("avg_annual_games"),
        F.max_by("yoy_growth_pct", "year").alias("latest_year_growth"),
    )


def pricing_listing(buckets: DataFrame) -> DataFrame:
    return buckets.select(
        "price_bucket",
        "game_count",
        "game_pct",
        "avg_positive_rate_pct",
        "avg_metacritic_score",
        "avg_recommendations",
        "avg_owners",
        "owners_share_pct",
    ).orderBy(F.desc("game_count"), "price_bucket")


def tag_listing(tags: DataFrame, k: int = 50) -> DataFrame:
    return top_k(tags, [F.desc("frequency"), F.asc("tag")], k)


def tags_by_owners(tags: DataFrame, k: int = 20) -> DataFrame:
    best = top_k(tags, [F.desc("avg_owners"), F.asc("tag")], k)
    return best.select(F.col("tag").alias("genre"), "frequency", "avg_owners")


def developer_listing(developers: DataFrame, k: int = 30) -> DataFrame:
    return top_k(developers, [F.desc("game_count"), F.asc_nulls_first("developer")], k)


def developer_summary(developers: DataFrame) -> DataFrame:
    """Market structure, largest developer (by count, then name), list size and index."""
    leading = top_k(
        developers, [F.desc("game_count"), F.asc_nulls_first("developer")], 1
    ).select(
        F.col("market_structure"), F.col("developer").alias("top_dev"), F.col("game_count").alias("top_dev_count")
    )
    totals = developers.agg(F.count("*").alias("total_devs"), F.max("market_hhi").alias("hhi"))
    return leading.withColumn("total_devs", totals.select("total_devs").scalar()).withColumn(
        "hhi", totals.select("hhi").scalar()
    )


# --- communities -------------------------------------------------------------
def communities_by_mean(totals: DataFrame) -> DataFrame:
    return totals.orderBy(F.desc("averageprice"), "community")


# --- registry ----------------------------------------------------------------
def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count of each named result table."""
    counts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


class Registry:
    """Result tables reachable by a fixed set of public names."""

    def __init__(self) -> None:
        self._tables: dict[str, Callable[[], DataFrame]] = {}

    def add(self, name: str, table: Callable[[], DataFrame]) -> None:
        self._tables[name] = table

    def names(self) -> list[str]:
        return sorted(self._tables)

    def get(self, name: str) -> DataFrame:
        if name not in self._tables:
            raise KeyError(f"unknown table {name!r}; known: {', '.join(self.names())}")
        return self._tables[name]()

    def bundle(self, *names: str) -> dict[str, DataFrame]:
        return {name: self.get(name) for name in names}

    def register(self, *names: str) -> dict[str, str]:
        """Make the named tables views of the session, a ``/`` in a name as ``_``; the view of each name."""
        views = {name: name.replace("/", "_") for name in names}
        register_views({views[name]: self.get(name) for name in names})
        return views


def sql_report(spark: SparkSession, text: str, **values: object) -> DataFrame:
    """A report as SQL text over registered views; values are bound to its ``:name`` markers, never put into the text."""
    return spark.sql(text, args=values)
