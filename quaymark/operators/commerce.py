"""Commerce analyses: sales trend, daily category ranking, user value, order events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from quaymark.functions import labels as L
from quaymark.functions.expressions import exact_ratio, first_reached
from quaymark.operators.ranking import sorted_report, top_per_group, with_tiles
from quaymark.session import materialize


def attach_category(order_items: DataFrame, products: DataFrame) -> DataFrame:
    """Items with ``final_category``: the product's, else the item's own; none is dropped.

    No broadcast hint: the product table grows with the business, so AQE
    decides from its measured size and splits hot products otherwise.
    """
    dimension = products.select(
        "product_id",
        F.col("category").alias("product_category"),
        "brand",
        F.col("price").alias("listed_price"),
        F.col("cost").alias("listed_cost"),
    )
    return (
        order_items.join(dimension, "product_id", "left")
        .withColumn("final_category", F.coalesce("product_category", "category"))
        .filter("final_category is not null")
    )


def _single(low: str, high: str, what: str) -> Column:
    """A value that must be the same in all rows of an order; an order with two ends the job."""
    problem = F.concat(F.lit(f"one order with more than one {what}: "), F.col("order_id").cast("string"))
    return F.when(F.col(low) != F.col(high), F.raise_error(problem).cast("string")).otherwise(F.col(low))


def sales_time_trend(valid: DataFrame) -> DataFrame:
    """Orders, users and amounts per date and hour.

    Rows are summed per order, orders per user, and users per hour, so distinct counts
    become plain ones and no row is multiplied.  That takes one user per order, which
    is checked.
    """
    hour = ["stat_date", "stat_hour"]
    amounts = ["total_amount", "discount_amount", "pay_amount"]
    orders = valid.groupBy(*hour, "order_id").agg(
        F.min("user_id").alias("_low"),
        F.max("user_id").alias("_high"),
        *[F.sum(c).alias(c) for c in amounts],
        F.count("pay_amount").alias("_paid"),
    )
    users = orders.groupBy(*hour, _single("_low", "_high", "user").alias("user_id")).agg(
        F.count("order_id").alias("order_count"),
        *[F.sum(c).alias(c) for c in amounts],
        F.sum("_paid").alias("_paid"),
    )
    return (
        users.groupBy(*hour)
        .agg(
            F.sum("order_count").alias("order_count"),
            F.count("user_id").alias("user_count"),
            *[F.sum(c).cast("decimal(28,2)").alias(c) for c in amounts],
            exact_ratio(F.sum("pay_amount"), F.sum("_paid"), 2).alias("avg_order_amount"),
        )
        .orderBy(*hour)
    )


def category_sales_rank(
    valid: DataFrame, order_items: DataFrame, products: DataFrame, top_n: int = 10
) -> DataFrame:
    """Best-selling categories of each day, ranked by amount, quantity, name.

    Lines are summed per order and category before the join, so afterwards an order is
    one row in a category.  That takes one date and channel per order, which is checked.
    """
    return ranked_category_sales(valid, attach_category(order_items, products), top_n)


def ranked_category_sales(valid: DataFrame, items: DataFrame, top_n: int = 10) -> DataFrame:
    """``category_sales_rank`` of items that have their category."""
    keys = valid.groupBy("order_id").agg(
        F.min("stat_date").alias("_low_date"),
        F.max("stat_date").alias("_high_date"),
        F.min("channel").alias("_low"),
        F.max("channel").alias("_high"),
        F.count("*").alias("_copies"),
    )
    keys = keys.select(
        "order_id",
        _single("_low_date", "_high_date", "date").alias("stat_date"),
        _single("_low", "_high", "channel").alias("channel"),
        "_copies",
    )
    lines = items.groupBy("order_id", F.col("final_category").alias("category")).agg(
        F.sum("quantity").alias("quantity"), F.sum("amount").alias("amount"), F.count("amount").alias("_lines")
    )
    copies = F.col("_copies")
    channels = (
        lines.join(keys, "order_id")
        .groupBy("stat_date", "category", "channel")
        .agg(
            F.count("*").alias("order_count"),
            F.sum(F.col("quantity") * copies).alias("quantity_sum"),
            F.sum((F.col("amount") * copies).cast("decimal(28,2)")).cast("decimal(28,2)").alias("amount_sum"),
            F.sum(F.col("_lines") * copies).alias("_lines"),
        )
    )
    daily = channels.groupBy("stat_date", "category").agg(
        F.sum("order_count").alias("order_count"),
        F.sum("quantity_sum").cast("bigint").alias("quantity_sum"),
        F.sum("amount_sum").cast("decimal(28,2)").alias("amount_sum"),
        exact_ratio(F.sum("amount_sum"), F.sum("_lines"), 2).alias("avg_item_amount"),
        F.count("channel").alias("channel_count"),
    )
    order = [F.desc("amount_sum"), F.desc("quantity_sum"), F.asc("category")]
    best = top_per_group(daily, ["stat_date"], order, top_n, "category_rank")
    return sorted_report(best, "stat_date", "category_rank")


def user_activity(valid: DataFrame) -> DataFrame:
    """Per user: date of the last order, number of orders, amount."""
    return valid.groupBy("user_id").agg(
        F.max("stat_date").alias("last_date"),
        F.countDistinct("order_id").alias("frequency"),
        F.sum("pay_amount").alias("monetary"),
    )


def with_recency(activity: DataFrame) -> DataFrame:
    """Days from each user's last order to the day after the latest order of all."""
    latest = activity.agg(F.max("last_date").alias("latest")).scalar()
    days = F.datediff(F.date_add(latest, 1), "last_date")
    return activity.withColumn("recency_days", days)


def user_value(valid: DataFrame, users: DataFrame) -> DataFrame:
    """Quintile scores for recency, frequency and amount, and the level of their sum.

    Equal values are ordered by user id, so scores are reproducible.  Orders
    are scanned once, into a stored table per user; the borders of all quintiles are
    searched for there together (by last date, which sorts as descending recency).
    """
    activity = materialize(user_activity(valid), "user-activity")
    scored = with_tiles(activity, {"r_score": "last_date", "f_score": "frequency", "m_score": "monetary"}, "user_id", 5)
    total = F.col("r_score") + F.col("f_score") + F.col("m_score")
    return (
        with_recency(scored)
        .join(users.select("user_id", "province", "city", "member_level"), "user_id", "left")
        .withColumn("total_score", total)
        .withColumn(
            "user_level",
            first_reached(F.col("total_score"), L.USER_LEVEL_STEPS, L.USER_LEVEL_LOWEST, strict=False),
        )
        .select(
            "user_id",
            "province",
            "city",
            "member_level",
            "recency_days",
            "frequency",
            "monetary",
            "r_score",
            "f_score",
            "m_score",
            "total_score",
            "user_level",
        )
    )


def order_events(valid: DataFrame, order_items: DataFrame, products: DataFrame) -> DataFrame:
    """One event per valid order carrying its highest-amount category (ties: first name)."""
    per_category = (
        attach_category(order_items, products)
        .groupBy("order_id", "final_category")
        .agg(F.sum("amount").alias("amount"))
    )
    leading = per_category.groupBy("order_id").agg(
        F.min(F.struct((-F.col("amount")).alias("neg"), F.col("final_category").alias("category"))).alias("best")
    ).select("order_id", F.col("best.category").alias("category"))
    return valid.join(leading, "order_id").select(
        "order_id",
        "user_id",
        F.date_format("order_ts", L.TIME_FORMAT).alias("order_time"),
        "province",
        "city",
        "category",
        "pay_amount",
        "order_status",
        "channel",
    )
