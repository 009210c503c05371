"""Association mining: pair rules over baskets, frequent itemsets and their rules."""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, Window, functions as F

from quaymark.functions.expressions import exact_ratio, list_items
from quaymark.operators.commerce import attach_category
from quaymark.session import materialize, small_tasks


def order_baskets(valid: DataFrame, order_items: DataFrame, products: DataFrame) -> DataFrame:
    """Distinct (order_id, category) of valid orders.

    Repeats go before the join: an order with very many lines shrinks to its
    few categories inside each map task instead of meeting in one join task.
    (A semi join would be pushed below the distinct by the optimizer, so the
    order ids are made unique and joined.)
    """
    return baskets_of(valid, attach_category(order_items, products))


def baskets_of(valid: DataFrame, items: DataFrame) -> DataFrame:
    """``order_baskets`` of items that have their category."""
    return (
        items.select("order_id", F.col("final_category").alias("category"))
        .distinct()
        .join(valid.select("order_id").distinct(), "order_id")
    )


def basket_signatures(pairs: DataFrame, basket: str, item: str) -> DataFrame:
    """Distinct item sets of size two and more with the number of baskets holding each.

    Baskets collapse here: everything after this point works on one row per
    distinct set instead of one per basket.
    """
    return (
        pairs.groupBy(basket)
        .agg(F.array_sort(F.collect_set(item)).alias("items"))
        .filter(F.size("items") >= 2)
        .groupBy("items")
        .agg(F.count("*").alias("baskets"))
    )


def _pair_counts(sets: DataFrame) -> DataFrame:
    """Baskets per ordered pair: each unordered pair is emitted once per set, then turned round."""
    placed = sets.select("items", "baskets", F.posexplode("items").alias("_at", "first"))
    later = F.slice("items", F.col("_at") + 2, F.size("items"))
    unordered = (
        placed.select("first", "baskets", F.explode(later).alias("second"))
        .groupBy("first", "second")
        .agg(F.sum("baskets").alias("pair_order_count"))
    )
    both = F.array(
        F.struct(F.col("first").alias("antecedent"), F.col("second").alias("consequent")),
        F.struct(F.col("second").alias("antecedent"), F.col("first").alias("consequent")),
    )
    return unordered.select(F.explode(both).alias("pair"), "pair_order_count").select(
        "pair.*", "pair_order_count"
    )


def _several(pairs: DataFrame, basket: str, item: str) -> DataFrame:
    """The distinct pairs of baskets with two items and more; ``_first`` marks one row of each basket.

    Written once, from tasks whose share of the pairs does not grow with the input.
    """
    whole = Window.partitionBy(basket)
    sized = pairs.filter(F.col(basket).isNotNull()).distinct().select(
        basket,
        item,
        F.count("*").over(whole).alias("_size"),
        F.coalesce(F.col(item) == F.min(item).over(whole), F.lit(False)).alias("_first"),
    )
    spark = pairs.sparkSession
    with small_tasks(spark, pairs):
        return materialize(sized.filter("_size >= 2").drop("_size"), "baskets")


def pair_rules(
    pairs: DataFrame,
    min_support: float = 0.005,
    min_confidence: float = 0.10,
    basket: str = "order_id",
    item: str = "category",
    require_baskets: bool = False,
) -> DataFrame:
    """Ordered item pairs with support, confidence and lift.

    Denominators count only baskets with at least two items, and lift divides
    the already rounded confidence.  A pair cannot be more frequent than either
    member, so items below ``min_support`` are dropped before any basket's items are
    put together.  That is exact, and it bounds each set by the number of frequent
    items (at most mean basket size / min_support), however long a single basket is;
    baskets that become equal are counted as one set.
    ``require_baskets`` raises when no basket has two items.
    """
    pairs = _several(pairs.select(basket, item), basket, item)
    if require_baskets and pairs.isEmpty():
        raise ValueError("no basket holds two different items")
    threshold = F.lit(str(min_support)).cast("decimal(12,6)")
    total = pairs.agg(F.count_if("_first").alias("n")).scalar()
    singles = pairs.groupBy(F.col(item).alias("item")).agg(F.count("*").alias("n")).withColumn("total", total)
    frequent = materialize(singles.filter(exact_ratio(F.col("n"), F.col("total"), 6) >= threshold), "items")
    pruned = pairs.join(frequent.select(F.col("item").alias(item)), item)
    sets = basket_signatures(pruned, basket, item)
    left = frequent.select(
        F.col("item").alias("antecedent"),
        F.col("n").alias("antecedent_order_count"),
        F.col("total").alias("total_basket_count"),
    )
    right = frequent.select(F.col("item").alias("consequent"), F.col("n").alias("consequent_order_count"))
    confidence = exact_ratio(F.col("pair_order_count"), F.col("antecedent_order_count"), 6)
    lift = _lift(F.col("confidence"), F.col("consequent_order_count"), F.col("total_basket_count"))
    return (
        _pair_counts(sets)
        .join(left, "antecedent")
        .join(right, "consequent")
        .withColumn("support", exact_ratio(F.col("pair_order_count"), F.col("total_basket_count"), 6))
        .withColumn("confidence", confidence)
        .withColumn("lift", lift)
        .filter(
            (F.col("support") >= threshold)
            & (F.col("confidence") >= F.lit(str(min_confidence)).cast("decimal(12,6)"))
        )
        .select(
            "antecedent",
            "consequent",
            "support",
            "confidence",
            "lift",
            "pair_order_count",
            "antecedent_order_count",
            "consequent_order_count",
            "total_basket_count",
        )
        .orderBy(
            F.desc("lift"), F.desc("confidence"), F.desc("support"), "antecedent", "consequent"
        )
    )


def _lift(confidence: Column, count: Column, total: Column) -> Column:
    """confidence / (count / total), rounded half up to six decimals."""
    scaled = confidence.cast("decimal(8,6)") * total.cast("decimal(18,0)")
    return F.round(F.try_divide(scaled.cast("decimal(26,6)"), count.cast("decimal(18,0)")), 6)


def category_rules(
    valid: DataFrame,
    order_items: DataFrame,
    products: DataFrame,
    min_support: float = 0.005,
    min_confidence: float = 0.10,
    require_baskets: bool = False,
) -> DataFrame:
    pairs = order_baskets(valid, order_items, products)
    return pair_rules(pairs, min_support, min_confidence, require_baskets=require_baskets)


def rule_links(rules: DataFrame) -> DataFrame:
    return rules.select(
        F.col("antecedent").alias("source"),
        F.col("consequent").alias("target"),
        F.col("lift").alias("value"),
        "lift",
        "confidence",
        "support",
    )


def rule_nodes(rules: DataFrame) -> DataFrame:
    """Distinct names at either end of a rule."""
    ends = F.explode(F.array("antecedent", "consequent"))
    return rules.select(ends.alias("name")).distinct()


def tag_baskets(items: DataFrame, column: str = "Tags") -> DataFrame:
    """Item lists with at least two distinct, non-blank entries."""
    listed = items.select(F.array_distinct(list_items(F.col(column))).alias("items"))
    return listed.filter(F.size("items") > 1)


def item_lists(pairs: DataFrame, basket: str, item: str, at_least: int = 1) -> DataFrame:
    """The distinct items of each basket as an ``items`` array, for FP-Growth.

    Repeats go before the shuffle, so a basket is bounded by the number of different items.
    """
    lists = pairs.filter(F.col(item).isNotNull()).groupBy(basket).agg(F.array_sort(F.collect_set(item)).alias("items"))
    return lists.filter(F.size("items") >= at_least).select("items")


def fit_frequent_items(
    baskets: DataFrame,
    min_support: float = 0.02,
    min_confidence: float = 0.3,
    partitions: int | None = None,
):
    """Spark ML's parallel FP-Growth over an ``items`` array column (fits eagerly)."""
    growth = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence)
    if partitions:
        growth = growth.setNumPartitions(partitions)
    return growth.fit(baskets)


def frequent_itemsets(model) -> DataFrame:
    return model.freqItemsets.select(F.array_sort("items").alias("items"), "freq")


def association_rules(model) -> DataFrame:
    return model.associationRules


def rules_of(model, digits: int = 6) -> DataFrame:
    """Association rules with their sides in order and rounded ratios."""
    sides = [F.array_sort(c).alias(c) for c in ("antecedent", "consequent")]
    return association_rules(model).select(*sides, *[F.round(c, digits).alias(c) for c in ("confidence", "lift", "support")])
