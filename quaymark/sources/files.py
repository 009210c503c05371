"""File sources with explicit schemas (inference would cost a second scan)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType, StringType

from quaymark.functions import labels as L
from quaymark.operators import cleaning

USERS = (
    "user_id string, user_name string, gender string, age int, province string, "
    "city string, member_level string, register_date string"
)
PRODUCTS = "product_id string, product_name string, category string, brand string, price double, cost double"
ORDERS = (
    "order_id string, user_id string, order_time string, pay_time string, province string, city string, "
    "channel string, order_status string, total_amount double, discount_amount double, pay_amount double"
)
ORDER_ITEMS = (
    "item_id string, order_id string, product_id string, category string, quantity int, "
    "price double, amount double"
)
LISTINGS = (
    "district string, community string, layout string, orientation string, floor_num int, "
    "decoration string, elevator string, area decimal(12,2), price decimal(12,2), build_year string"
)
REJECTED = "_corrupt_record"


def _parsed_csv(
    spark: SparkSession, path: str, schema: str | StructType, **options: str
) -> tuple[DataFrame, Column]:
    """All rows with the text of unfitting ones in ``REJECTED``, and the test for fitting.

    The test looks at every column.  Spark parses only the columns a query
    asks for, so without it a bad value would go unnoticed by a query that
    does not read that column, and counts would depend on the query.
    """
    fields = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    rows = (
        spark.read.options(**options)
        .schema(StructType([*fields.fields, StructField(REJECTED, StringType())]))
        .option("header", True)
        .option("encoding", "UTF-8")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", REJECTED)
        .csv(path)
    )
    touched = F.bit_count(F.xxhash64(*fields.names)) >= 0
    return rows, F.col(REJECTED).isNull() & touched


def read_typed_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Headed UTF-8 CSV; rows that do not fit the schema are left out."""
    rows, fits = _parsed_csv(spark, path, schema)
    return rows.filter(fits).drop(REJECTED)


def read_csv_with_rejects(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """The fitting rows of a headed CSV, and the raw text of the others."""
    rows, fits = _parsed_csv(spark, path, schema)
    return rows.filter(fits).drop(REJECTED), rows.filter(~fits).select(REJECTED)


def read_commerce(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The four commerce tables below ``root``, typed and defaulted."""
    base = root.rstrip("/")
    return {
        "users": cleaning.clean_users(read_typed_csv(spark, f"{base}/users.csv", USERS)),
        "products": cleaning.clean_products(read_typed_csv(spark, f"{base}/products.csv", PRODUCTS)),
        "orders": cleaning.clean_orders(read_typed_csv(spark, f"{base}/orders.csv", ORDERS)),
        "order_items": cleaning.clean_order_items(
            read_typed_csv(spark, f"{base}/order_items.csv", ORDER_ITEMS)
        ),
    }


def require_non_empty(df: DataFrame, name: str) -> DataFrame:
    if df.isEmpty():
        raise ValueError(f"{name} is empty or cannot be read")
    return df


def read_catalogue_csv(spark: SparkSession, path: str, schema: str | StructType | None = None) -> DataFrame:
    """Headed CSV whose quoted fields may span lines and double their quotes.

    Such files cannot be split, so a large catalogue should arrive as many
    files.  Without a schema one is inferred, at the cost of another scan.
    """
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"')
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def read_listings_csv(
    spark: SparkSession, path: str, delimiter: str = ",", charset: str = "UTF-8", schema: str = LISTINGS
) -> DataFrame:
    """Listing CSV with its original headers, columns renamed to the English names."""
    rows = (
        spark.read.schema(_listing_source(schema))
        .option("header", True)
        .option("delimiter", delimiter)
        .option("charset", charset)
        .csv(path)
    )
    return rows.toDF(*L.LISTING_HEADERS.values())


def _listing_source(schema: str) -> StructType:
    types = {f.name: f.dataType for f in StructType.fromDDL(schema).fields}
    return StructType([StructField(header, types[name]) for header, name in L.LISTING_HEADERS.items()])


def read_listings_with_rejects(
    spark: SparkSession, path: str, delimiter: str = ",", schema: str = LISTINGS
) -> tuple[DataFrame, DataFrame]:
    """``read_listings_csv`` of the rows that fit, and the raw text of the others."""
    rows, fits = _parsed_csv(spark, path, _listing_source(schema), delimiter=delimiter)
    return rows.filter(fits).drop(REJECTED).toDF(*L.LISTING_HEADERS.values()), rows.filter(~fits).select(REJECTED)


def read_delimited_text(
    spark: SparkSession, path: str, columns: dict[str, str], separator: str
) -> DataFrame:
    """Headerless text lines split at ``separator`` into named, typed columns."""
    parts = F.split(F.col("value"), separator)
    return spark.read.text(path).select(
        *[
            F.trim(F.get(parts, F.lit(i))).try_cast(kind).alias(name)
            for i, (name, kind) in enumerate(columns.items())
        ]
    )


def read_any(spark: SparkSession, path: str, kind: str, schema: str | None = None, **options) -> DataFrame:
    """CSV, JSON, Parquet, ORC or (with its module on the classpath) Avro."""
    reader = spark.read.options(**options)
    if schema:
        reader = reader.schema(schema)
    return reader.format(kind).load(path)


def register_views(tables: dict[str, DataFrame]) -> None:
    """Make the tables queryable by name from SQL."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
