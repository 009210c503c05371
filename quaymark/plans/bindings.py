"""The given star-schema tables read as inputs of the analyses.

Every function reads whole tables; each column is derived from stored ones.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, functions as F

from quaymark.functions import labels as L
from quaymark.functions.expressions import MONEY
from quaymark.operators import cleaning
from quaymark.sinks import storage

EVENT_STATUSES = ("purchase", "signup")
ORDER_STATUSES = ("F", "O")
#: Bytes of the events table for each file of an arriving slice.
ARRIVING_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- commerce ----------------------------------------------------------------
def hourly_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as orders with a time of day: the discount is the number in ``props`` in cents."""
    value = F.col("value").cast(MONEY)
    discount = (F.get_json_object("props", "$.k").try_cast("bigint") / F.lit(100)).cast(MONEY)
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("order_id"),
        "user_id",
        F.col("ts").alias("order_ts"),
        F.to_date("ts").alias("stat_date"),
        F.hour("ts").alias("stat_hour"),
        F.col("event_type").alias("order_status"),
        value.alias("total_amount"),
        discount.alias("discount_amount"),
        (value - discount).cast(MONEY).alias("pay_amount"),
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderdate").alias("order_ts"),
        F.to_date("o_orderdate").alias("stat_date"),
        F.col("o_orderpriority").alias("channel"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_totalprice").cast(MONEY).alias("pay_amount"),
    )


def valid_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.valid_orders(orders(spark, sf_dir), ORDER_STATUSES)


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as items; the item's own category is its return flag."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_returnflag").alias("category"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").cast(MONEY).alias("amount"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as products; the PROMO type counts as no category, so items fall back to their own."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.nullif(F.col("p_type"), F.lit("PROMO")).alias("category"),
        F.col("p_brand").alias("brand"),
        F.col("p_retailprice").cast(MONEY).alias("price"),
        F.col("p_retailprice").cast(MONEY).alias("cost"),
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with nation as province and region as city; FURNITURE counts as no member level."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return (
        table(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .select(
            F.col("c_custkey").alias("user_id"),
            F.col("n_name").alias("province"),
            F.col("r_name").alias("city"),
            F.nullif(F.col("c_mktsegment"), F.lit("FURNITURE")).alias("member_level"),
        )
    )


# --- catalogue ---------------------------------------------------------------
def catalogue_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as catalogue items with texts that need parsing; line counts as reviews."""
    sold = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_partkey")
        .agg(
            F.count_if(F.col("l_returnflag") == "N").alias("Positive"),
            F.count_if(F.col("l_returnflag") == "R").alias("Negative"),
            F.sum(F.col("l_quantity").cast("bigint")).alias("Recommendations"),
            F.count("*").alias("lines"),
        )
    )
    size = F.col("p_size")
    year = (size + 1978).cast("string")
    dated = (
        F.when(F.col("p_type").isin("SMALL", "LARGE"), F.concat(year, F.lit("-01-15")))
        .when(F.col("p_type").isin("ECONOMY", "MEDIUM"), F.concat(F.lit("Oct 21, "), year))
        .otherwise(year)
    )
    words = F.split("p_name", " ")
    zero = F.lit(0).cast("bigint")
    return (
        table(spark, sf_dir, "part")
        .join(sold, F.col("p_partkey") == F.col("l_partkey"), "left")
        .select(
            F.col("p_partkey").alias("AppID"),
            F.col("p_name").alias("Name"),
            dated.alias("Release date"),
            F.concat((size * 1000).cast("string"), F.lit(" - "), (size * 2000).cast("string")).alias(
                "Estimated owners"
            ),
            (F.col("p_retailprice").cast(MONEY) - 900).cast(MONEY).alias("Price"),
            F.coalesce("lines", zero).alias("Average playtime forever"),
            F.coalesce("Recommendations", zero).alias("Recommendations"),
            F.coalesce("Positive", zero).alias("Positive"),
            F.coalesce("Negative", zero).alias("Negative"),
            (size + 45).alias("Metacritic score"),
            F.concat(F.lit("['"), "p_type", F.lit("', '"), words[1], F.lit("']")).alias("Genres"),
            F.concat(F.lit("['"), words[0], F.lit("', '"), words[1], F.lit("', '']")).alias("Tags"),
            F.when(size != 48, F.col("p_brand")).alias("Developers"),
            F.when(size != 47, F.col("p_type")).alias("Publishers"),
            F.when(size <= 45, "True").otherwise("False").alias("Windows"),
            F.when(size <= 20, "1").otherwise("0").alias("Mac"),
            F.when(size.between(10, 30), "TRUE").otherwise("").alias("Linux"),
        )
    )


def catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_catalogue(catalogue_raw(spark, sf_dir))


def developers_by_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as items of their customer, whose order counts span the size classes."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("Developers"),
        F.col("o_totalprice").cast(MONEY).alias("Price"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("Metacritic_score"),
    )


# --- listings ----------------------------------------------------------------
def listings_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as listings: nation is the district, brand the community, shipping year the build year."""
    size = F.col("p_size")
    built = (F.year("l_shipdate") - 8 * (F.col("l_partkey") % 7)).cast("int").cast("string")
    rooms = (
        F.when(size == 50, "10室2厅")
        .when(size == 49, "0室1厅")
        .when(size == 48, "开间")
        .otherwise(F.concat(F.substring("o_orderpriority", 1, 1), F.lit("室1厅")))
    )
    decoration = (
        F.when(F.col("l_returnflag") == "A", L.DECORATION_PREMIUM)
        .when(F.col("l_returnflag") == "N", L.DECORATION_SIMPLE)
        .otherwise(L.DECORATION_ROUGH)
    )
    # Half up in whole cents: cheaper per row than decimal division.
    cents = F.rint(F.col("l_extendedprice") * 100).cast("bigint")
    price = F.floor((cents * 96 + 10000) / 20000).cast("decimal(16,0)") * F.lit("0.01").cast("decimal(2,2)")
    lines = table(spark, sf_dir, "lineitem")
    owners = (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select("o_orderkey", "o_orderpriority", "o_orderstatus", "n_name")
    )
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size")
    return (
        lines.join(owners, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.col("n_name").alias("district"),
            F.col("p_brand").alias("community"),
            rooms.alias("layout"),
            F.col("o_orderstatus").alias("orientation"),
            F.col("l_linenumber").alias("floor_num"),
            decoration.alias("decoration"),
            F.when(F.col("l_linestatus") == "O", L.ELEVATOR_YES).otherwise("无电梯").alias("elevator"),
            (F.col("l_quantity").cast("int") * 6).alias("area"),
            price.cast(MONEY).alias("price"),
            F.when(size == 1, "unknown").otherwise(built).alias("build_year"),
            ((F.col("l_suppkey") % 3) + 1).cast("int").alias("batch"),
            "l_orderkey",
            "l_linenumber",
            "l_partkey",
            "l_suppkey",
        )
    )


TIE_BREAK = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_listings(listings_raw(spark, sf_dir), TIE_BREAK, batch_id=F.col("batch"))


def listing_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean listings without their row key, which only the stored table needs."""
    return cleaning.usable_listings(listings_raw(spark, sf_dir), batch_id=F.col("batch"))


# --- streams -----------------------------------------------------------------
def event_slices(spark: SparkSession, sf_dir: str, parts: int = 3) -> list[DataFrame]:
    """The events cut into equal spans of event time, earliest first; together they are all events."""
    rows = table(spark, sf_dir, "events")
    seconds = F.unix_timestamp(F.col("ts").cast("timestamp"))
    low, high = rows.agg(F.min(seconds), F.max(seconds)).first()
    if low is None:
        return [rows]
    place = F.least(F.floor((seconds - low) * parts / (high - low + 1)), F.lit(parts - 1))
    return [rows.filter(F.coalesce(place, F.lit(0)) == n) for n in range(parts)]


def arrive(part: DataFrame, folder: str, sf_dir: str) -> None:
    """Append events to ``folder`` in files of equal shares, one for each core at least.

    A stream reads a row group in one task.  Events of one time span lie side by side in their
    table, so without dealing a slice would be read by the few tasks that hold its row groups.
    """
    spark = part.sparkSession
    files = max(spark.sparkContext.defaultParallelism, math.ceil(storage.size(spark, f"{sf_dir}/events.parquet") / ARRIVING_BYTES))
    part.repartition(files, *part.columns).write.mode("append").parquet(folder)


def event_stream(spark: SparkSession, folder: str, schema, max_files: int | None = None) -> DataFrame:
    """The events stored in ``folder`` as an unbounded frame with a zoned event time; at most so many files a micro-batch."""
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    rows = reader.parquet(folder)
    return rows.withColumn("ts", F.col("ts").cast("timestamp"))


def order_messages(events: DataFrame) -> DataFrame:
    """Events as JSON order messages."""
    number = F.get_json_object("props", "$.k")
    message = F.struct(
        F.col("event_id").cast("string").alias("order_id"),
        F.col("user_id").cast("string").alias("user_id"),
        F.date_format("ts", L.TIME_FORMAT).alias("order_time"),
        number.alias("province"),
        F.lit("").alias("city"),
        F.concat(F.lit("k"), F.substring(number, 1, 1)).alias("category"),
        F.col("value").alias("pay_amount"),
        F.col("event_type").alias("order_status"),
        F.lit("web").alias("channel"),
    )
    return events.select(F.to_json(message).alias("value"), "event_type", "event_id")


def item_messages(events: DataFrame) -> DataFrame:
    """Events as JSON item messages; genres are the event type and the first digit of the number."""
    number = F.get_json_object("props", "$.k")
    message = F.struct(
        F.col("event_id").alias("app_id"),
        F.col("event_type").alias("name"),
        F.col("value").alias("price"),
        F.concat(F.lit("["), "event_type", F.lit(", k"), F.substring(number, 1, 1), F.lit("]")).alias("genres"),
        (F.col("user_id") * 1000).alias("estimated_owners"),
        number.cast("int").alias("positive"),
        (F.col("user_id") % 10).cast("int").alias("negative"),
        F.date_format("ts", L.TIME_FORMAT).alias("timestamp"),
    )
    return events.select(F.to_json(message).alias("value"))
