"""Cleaning of the three raw inputs into typed analysis tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, FloatType, IntegralType

from quaymark.functions import labels as L
from quaymark.functions.expressions import (
    MONEY,
    first_year,
    money,
    parse_time,
    range_midpoint,
    word_safe,
)
from quaymark.operators.ranking import keep_first, with_global_position
from quaymark.session import materialize


def normalise_names(df: DataFrame) -> DataFrame:
    """Column names trimmed, spaces and dots replaced by underscores."""
    return df.toDF(*[c.strip().replace(" ", "_").replace(".", "_") for c in df.columns])


def clean_catalogue(
    raw: DataFrame,
    order_by: Sequence[Column] | None = None,
    first: int = L.FIRST_YEAR,
    last: int = L.LAST_YEAR,
) -> DataFrame:
    """Named, keyed, deduplicated items with ``owners_numeric`` and ``release_year``.

    Of rows with one AppID the first by ``order_by`` stays, by default by name, release
    date and owners: short columns, so that a later query still reads only the columns it
    needs.  Give a finer key where rows can agree in all three and differ elsewhere.
    """
    df = normalise_names(raw).filter(
        F.col("AppID").isNotNull() & F.col("Name").isNotNull() & (F.col("Name") != "")
    )
    # Binary fractions become decimals, four places to tell 4.995 from 4.99.
    price = df.schema["Price"].dataType
    price = "decimal(18,4)" if isinstance(price, (DoubleType, FloatType)) else price
    return (
        keep_first(df, ["AppID"], order_by or [F.col(c).asc() for c in ("Name", "Release_date", "Estimated_owners")])
        .withColumn("owners_numeric", range_midpoint(F.col("Estimated_owners")))
        .withColumn("Price", F.coalesce(F.col("Price").cast(price), F.lit(0).cast(price)))
        .withColumn("release_year", first_year(F.col("Release_date").cast("string")))
        .filter(F.col("release_year").between(first, last))
    )


def clean_orders(raw: DataFrame) -> DataFrame:
    """Parsed times, date and hour of the order, amounts defaulted to 0, keys present."""
    return (
        raw.withColumn("order_ts", parse_time(F.col("order_time"), L.TIME_FORMAT))
        .withColumn("pay_ts", parse_time(F.col("pay_time"), L.TIME_FORMAT))
        .withColumn("stat_date", F.to_date("order_ts"))
        .withColumn("stat_hour", F.hour("order_ts"))
        .withColumn("total_amount", money(F.col("total_amount")))
        .withColumn("discount_amount", money(F.col("discount_amount")))
        .withColumn("pay_amount", money(F.col("pay_amount")))
        .filter("order_id is not null and user_id is not null and order_ts is not null")
    )


def clean_order_items(raw: DataFrame) -> DataFrame:
    return (
        raw.withColumn("quantity", F.coalesce(F.col("quantity").try_cast("int"), F.lit(0)))
        .withColumn("price", money(F.col("price")))
        .withColumn("amount", money(F.col("amount")))
        .filter("item_id is not null and order_id is not null and product_id is not null")
    )


def clean_products(raw: DataFrame) -> DataFrame:
    return raw.withColumn("price", money(F.col("price"))).withColumn("cost", money(F.col("cost")))


def clean_users(raw: DataFrame) -> DataFrame:
    return raw.withColumn("age", F.col("age").try_cast("int")).withColumn(
        "register_date", F.to_date(parse_time(F.col("register_date"), L.DATE_FORMAT))
    )


def valid_orders(
    df: DataFrame, statuses: Sequence[str] = L.VALID_STATUSES, column: str = "order_status"
) -> DataFrame:
    return df.filter(F.col(column).isin(*statuses))


def unit_price(listings: DataFrame) -> Column:
    """``price * 10000 / area`` rounded half up to a whole number.

    With whole-number areas this is whole-number arithmetic: the quotient of
    two integers below 2**53 is never rounded across the next integer, so its
    floor is exact, and no decimal division is paid per row.  A price beyond a
    whole number's range is NULL.
    """
    price, area = F.col("price"), F.col("area")
    if isinstance(listings.schema["area"].dataType, IntegralType):
        if isinstance(listings.schema["price"].dataType, IntegralType):
            hundredths = price.cast("bigint") * 100
        else:
            hundredths = (price.cast(MONEY) * 100).cast("bigint")
        whole = F.floor(F.try_divide(hundredths * 200 + area, area * 2))
    else:
        whole = F.round(F.try_divide(price.cast(MONEY) * 10000, area.cast("decimal(12,2)")), 0)
    return whole.try_cast("int")


def usable_listings(
    raw: DataFrame, batch_id: int | Column = 1, base_year: int = L.AGE_BASE_YEAR
) -> DataFrame:
    """Plausible listings with unit price, age and batch id; analyses need no more than this."""
    batch = batch_id if isinstance(batch_id, Column) else F.lit(batch_id)
    return (
        raw.filter(
            F.col("district").isNotNull()
            & F.col("community").isNotNull()
            & (F.col("area") > 0)
            & (F.col("price") > 0)
            & F.col("build_year").rlike("^[0-9]{4}$")
        )
        .withColumn("elevator_int", F.when(F.col("elevator") == L.ELEVATOR_YES, 1).otherwise(0))
        .withColumn("price_per_sqm", unit_price(raw))
        .withColumn("house_age", F.lit(base_year) - F.col("build_year").try_cast("int"))
        .withColumn("checkid", batch.cast("int"))
    )


def clean_listings(
    raw: DataFrame,
    tie_break: Sequence[str] = (),
    batch_id: int | Column = 1,
    base_year: int = L.AGE_BASE_YEAR,
) -> DataFrame:
    """Usable listings in their stored form, with a row key numbered by district and community.

    ``tie_break`` columns order listings of one community; without them the
    whole row does.
    """
    rest = list(tie_break) or [c for c in raw.columns if c not in ("district", "community")]
    order = [F.col(c).asc() for c in ["district", "community", *rest]]
    # Written before the sort, which reads its input twice (once to sample ranges).
    usable = materialize(usable_listings(raw, batch_id, base_year), "usable-listings")
    return with_global_position(usable, order, "_row").select(
        F.concat_ws("_", "district", word_safe(F.col("community")), F.col("_row").cast("string")).alias("rowkey"),
        "district",
        "community",
        "layout",
        "orientation",
        "floor_num",
        "decoration",
        "elevator_int",
        "area",
        "price",
        "price_per_sqm",
        "build_year",
        "house_age",
        "checkid",
    )


def with_audit(
    df: DataFrame,
    times: Sequence[str] = ("update_time",),
    dates: Sequence[str] = (),
    batch_id: int | None = None,
) -> DataFrame:
    """Load-time columns, added last so that results stay comparable without them."""
    for name in times:
        df = df.withColumn(name, F.current_timestamp())
    for name in dates:
        df = df.withColumn(name, F.date_format(F.current_date(), L.DATE_FORMAT))
    if batch_id is not None:
        df = df.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
    return df
