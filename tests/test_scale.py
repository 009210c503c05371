"""Plan shapes that keep hot keys and large inputs spread out."""

import glob
from functools import partial

import pytest
from pyspark.sql import functions as F

from quaymark.operators import baskets, catalogue, commerce, listings
from quaymark.plans import queries
from quaymark.session import shared_dir, small_tasks

SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
}


@pytest.fixture
def skewed(spark):
    before = {key: spark.conf.get(key, None) for key in SKEW}
    for key, value in SKEW.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


def executed(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    # The noop write plans its own copy; collect the adaptive plan of this one.
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def commerce_tables(spark):
    """One order and one product hold half of the lines."""
    hot = F.col("id") % 2 == 0
    items = spark.range(0, 200000, numPartitions=8).select(
        F.when(hot, 0).otherwise(F.col("id") % 3000).alias("order_id"),
        F.when(hot, 0).otherwise(F.col("id") % 400).alias("product_id"),
        F.lit("x").alias("category"),
        F.lit(1).alias("quantity"),
        (F.xxhash64("id") % 97).cast("decimal(18,2)").alias("amount"),
    )
    products = spark.range(400).select(
        F.col("id").alias("product_id"), F.concat(F.lit("c"), F.col("id") % 7).alias("category"),
        F.lit("b").alias("brand"), F.lit(1.0).alias("price"), F.lit(1.0).alias("cost"),
    )
    orders = spark.range(3000).select(
        F.col("id").alias("order_id"), (F.col("id") % 50).alias("user_id"),
        F.date_add(F.lit("2025-01-01").cast("date"), (F.col("id") % 5).cast("int")).alias("stat_date"),
        F.lit("APP").alias("channel"),
    )
    return orders, items, products


def test_hot_products_are_split_and_hot_orders_summed_before_their_join(skewed, commerce_tables):
    orders, items, products = commerce_tables
    # The hot product is split by adaptive execution.
    assert "skew=true" in executed(commerce.attach_category(items, products))
    # The hot order has no hot key left in its join: its lines are summed before.
    ranked = commerce.category_sales_rank(orders, items, products, top_n=3)
    assert executed(ranked).count("skew=true") >= 1
    plan = ranked._jdf.queryExecution().optimizedPlan().toString().splitlines()
    joins = [i for i, line in enumerate(plan) if "Join" in line and "order_id" in line]
    summed = [i for i, line in enumerate(plan) if "Aggregate" in line and "order_id" in line and "sum(" in line and "quantity" in line]
    assert len(joins) == 1 and any(i > joins[0] for i in summed)
    lines = commerce.attach_category(items, products).groupBy("order_id", "final_category").count()
    assert lines.groupBy("order_id").count().agg(F.max("count")).first()[0] <= 8


def test_hot_order_shrinks_before_the_basket_join(commerce_tables, rows):
    orders, items, products = commerce_tables
    pairs = baskets.order_baskets(orders, items, products)
    plan = pairs._jdf.queryExecution().optimizedPlan().toString()
    assert plan.startswith("Project") and plan.index("Join Inner") < plan.index("Aggregate")  # distinct, then join
    assert pairs.filter("order_id = 0").count() <= 8


def test_pairs_form_once_per_distinct_basket(spark):
    pairs = spark.range(20000).select(
        (F.col("id") % 5000).alias("order_id"), F.concat(F.lit("c"), F.floor(F.col("id") / 5000)).alias("category")
    )
    assert baskets.basket_signatures(pairs, "order_id", "category").count() == 1
    rules = baskets.pair_rules(pairs)
    assert {r["pair_order_count"] for r in rules.collect()} == {5000}


def test_infrequent_items_never_form_pairs(spark):
    rare = spark.range(3000).select(F.col("id").alias("order_id"), F.concat(F.lit("r"), "id").alias("category"))
    common = spark.range(3000).select(F.col("id").alias("order_id"), F.lit("common").alias("category"))
    assert baskets.pair_rules(rare.union(common), min_support=0.01).collect() == []


def test_statistics_combine_before_the_shuffle(spark):
    df = spark.range(100000).select(
        F.lit("one").alias("k"), (F.col("id") % 50).cast("int").alias("price_per_sqm"), F.lit(1).alias("house_age"), F.lit(1).alias("area")
    ).withColumn("k", F.concat("k", F.col("price_per_sqm") % 1))
    plan = listings.price_statistics(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and "partial_count" in plan
    assert listings.price_statistics(df, ["k"]).first()["median_price"] == 24


def test_scans_read_only_what_is_needed(spark, tmp_path):
    spark.range(10).select(
        F.col("id").alias("release_year"), F.lit(1).cast("decimal(18,1)").alias("owners_numeric"),
        F.lit(1).cast("decimal(18,2)").alias("Price"), F.lit(1).alias("Average_playtime_forever"),
        F.lit(1).alias("Recommendations"), F.lit("wide text").alias("Description"),
    ).write.parquet(str(tmp_path / "t"))
    plan = catalogue.market_trend(spark.read.parquet(str(tmp_path / "t")))._jdf.queryExecution().executedPlan().toString()
    assert "Description" not in plan


def test_no_cross_join_anywhere(spark):
    from quaymark.plans.queries import QUERIES

    for name in ("sales_summary", "price_bucket_review", "developer_hhi", "area_price", "category_pair_rules", "rfm_levels"):
        plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert "Cartesian" not in plan and "NestedLoop" not in plan, name


def _tasks_of(spark, label: str) -> int:
    """Part files of the tables written under a label."""
    app = spark.sparkContext.applicationId
    return len(glob.glob(f"{shared_dir(spark)}/quaymark/{app}/{label}-*/part-*"))


def test_small_tasks_grow_in_number_with_the_files_and_put_settings_back(spark, tmp_path):
    path = str(tmp_path / "pairs")
    spark.range(100_000).select((F.col("id") % 50_000).alias("order_id"), F.xxhash64("id").alias("category")).write.parquet(path)
    keys = ["spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.coalescePartitions.parallelismFirst"]
    before = [spark.conf.get(k) for k in keys]
    with pytest.raises(KeyError), small_tasks(spark, spark.read.parquet(path), 64 << 10):
        assert int(spark.conf.get(keys[0])) > 8
        raise KeyError
    assert [spark.conf.get(k) for k in keys] == before


def test_baskets_of_pair_rules_are_made_in_small_tasks(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "pairs")
    pairs = spark.range(1_600_000).select((F.col("id") % 800_000).alias("order_id"), (F.xxhash64("id") % 1000).alias("category"))
    pairs.write.parquet(path)
    monkeypatch.setattr(baskets, "small_tasks", partial(small_tasks, task_bytes=1 << 20))
    old = _tasks_of(spark, "baskets")
    baskets.pair_rules(spark.read.parquet(path))
    assert _tasks_of(spark, "baskets") - old >= 6  # four shuffle partitions are set


def test_a_null_basket_is_no_basket(spark):
    schema = "order_id string, category string"
    pairs = [("o", "a"), ("o", "b"), (None, "a"), (None, "b"), ("p", None), ("p", "a"), ("q", "a")]
    got = baskets.pair_rules(spark.createDataFrame(pairs, schema), 0.0, 0.0).collect()
    assert {(r["antecedent"], r["consequent"], r["pair_order_count"], r["antecedent_order_count"], r["total_basket_count"]) for r in got} == {
        ("a", "b", 1, 2, 2), ("b", "a", 1, 1, 2)
    }


@pytest.mark.parametrize("drain", ["_drain_in_slices", "_drain_with_late_rows"])
def test_slices_of_a_stream_are_read_by_every_core(spark, tmp_path, drain):
    """The events lie in one row group; each micro-batch still has a file for each core."""
    spark.range(0, 3000, numPartitions=1).selectExpr("id as event_id", "timestamp_seconds(1700000000 + id) as ts").write.parquet(str(tmp_path / "events.parquet"))
    files = []

    def count(batch, batch_id, stream=""):
        files.append([r["n"] for r in batch.groupBy("file").agg(F.count("*").alias("n")).collect()])

    getattr(queries, drain)(spark, str(tmp_path), lambda rows: rows.select(F.input_file_name().alias("file")), count, "append")
    shares = [s for s in files if s]
    assert sum(map(sum, shares)) == 3000
    assert all(len(s) >= 4 and max(s) < 2 * sum(s) / len(s) for s in shares)
