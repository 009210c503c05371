"""Result-table contracts: column types, required columns, primary keys."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, functions as F

from quaymark.session import materialize


@dataclass(frozen=True)
class Contract:
    columns: dict[str, str]
    key: tuple[str, ...]
    nullable: tuple[str, ...] = ()


MONEY = "decimal(18,2)"
RATIO = "decimal(10,6)"

CONTRACTS = {
    "ads_sales_time_trend": Contract(
        {
            "stat_date": "date",
            "stat_hour": "int",
            "order_count": "bigint",
            "user_count": "bigint",
            "total_amount": MONEY,
            "discount_amount": MONEY,
            "pay_amount": MONEY,
            "avg_order_amount": MONEY,
        },
        ("stat_date", "stat_hour"),
    ),
    "ads_category_sales_rank": Contract(
        {
            "stat_date": "date",
            "category": "string",
            "order_count": "bigint",
            "quantity_sum": "bigint",
            "amount_sum": MONEY,
            "avg_item_amount": MONEY,
            "channel_count": "bigint",
            "category_rank": "int",
        },
        ("stat_date", "category"),
    ),
    "ads_user_value_level": Contract(
        {
            "user_id": "string",
            "province": "string",
            "city": "string",
            "member_level": "string",
            "recency_days": "int",
            "frequency": "bigint",
            "monetary": MONEY,
            "r_score": "int",
            "f_score": "int",
            "m_score": "int",
            "total_score": "int",
            "user_level": "string",
        },
        ("user_id",),
        nullable=("province", "city", "member_level"),
    ),
    "ads_category_association_rules": Contract(
        {
            "antecedent": "string",
            "consequent": "string",
            "support": RATIO,
            "confidence": RATIO,
            "lift": RATIO,
            "pair_order_count": "bigint",
            "antecedent_order_count": "bigint",
            "consequent_order_count": "bigint",
            "total_basket_count": "bigint",
        },
        ("antecedent", "consequent"),
    ),
    "rt_category_window_sales": Contract(
        {
            "window_start": "timestamp",
            "window_end": "timestamp",
            "category": "string",
            "order_count": "bigint",
            "pay_amount": MONEY,
            "batch_id": "bigint",
        },
        ("window_start", "window_end", "category"),
    ),
    "area_price_analysis": Contract(
        {
            "area_range": "string",
            "house_count": "bigint",
            "avg_price_per_sqm": "int",
            "min_price": "int",
            "max_price": "int",
            "median_price": "int",
            "price_variance": "bigint",
            "price_stddev": "bigint",
            "avg_house_age": "int",
            "price_level": "string",
            "area_ratio": "decimal(5,2)",
            "checkid": "int",
        },
        ("area_range", "checkid"),
        nullable=("price_variance", "price_stddev", "avg_house_age"),
    ),
    "district_house_price_analysis": Contract(
        {
            "district": "string",
            "avg_price_per_sqm": "int",
            "house_count": "bigint",
            "min_price": "int",
            "max_price": "int",
            "median_price": "int",
            "price_variance": "bigint",
            "std_price": "bigint",
            "avg_house_age": "int",
            "avg_area": "int",
            "checkid": "int",
        },
        ("district", "checkid"),
        nullable=("price_variance", "std_price", "avg_house_age"),
    ),
    "house_year_analysis": Contract(
        {
            "year_range": "string",
            "house_count": "bigint",
            "elevator_count": "bigint",
            "small_layout_count": "bigint",
            "medium_layout_count": "bigint",
            "large_layout_count": "bigint",
            "premium_decoration_count": "bigint",
            "simple_decoration_count": "bigint",
            "rough_decoration_count": "bigint",
            "checkid": "int",
        },
        ("year_range", "checkid"),
    ),
    "community_price_analysis": Contract(
        {
            "checkid": "int",
            "district": "string",
            "community": "string",
            "house_count": "bigint",
            "avg_price_per_sqm": "int",
            "build_year": "string",
        },
        ("checkid", "district", "community"),
        nullable=("build_year",),
    ),
    "certain_analysis": Contract(
        {
            "district": "string",
            "area": "string",
            "community": "string",
            "number": "bigint",
            "averageprice": "int",
        },
        ("community",),
    ),
}


# Load-time columns that differ from a plain update_time: (timestamps, dates as text).
AUDIT_COLUMNS = {
    "area_price_analysis": ((), ("load_date", "pt_date")),
    "district_house_price_analysis": ((), ("load_date",)),
    "house_year_analysis": (("analysis_time",), ("pt_date",)),
    "community_price_analysis": (("sync_time",), ()),
    "certain_analysis": (("sync_time",), ()),
    "house_info_checkid": ((), ()),
    "house_info_clean_checkid": ((), ()),
}


def conform(df: DataFrame, contract: Contract) -> DataFrame:
    """Columns in contract order and type; a value that does not fit raises at run time."""
    return df.select(*[F.col(c).cast(t).alias(c) for c, t in contract.columns.items()])


def violations(df: DataFrame, contract: Contract) -> DataFrame:
    """Keys that break the contract, with the number of rows and why."""
    required = [c for c in contract.columns if c not in contract.nullable]
    has_null = F.lit(False)
    for name in required:
        has_null = has_null | F.col(name).isNull()
    keyed = df.groupBy(*contract.key).agg(
        F.count("*").alias("row_count"), F.max(has_null).alias("has_null")
    )
    reason = F.when(F.col("has_null"), "null in a required column").otherwise("duplicate key")
    return keyed.filter("row_count > 1 or has_null").withColumn("reason", reason).drop("has_null")


def checked(df: DataFrame, contract: Contract, counts: dict[str, int] | None = None) -> DataFrame:
    """``df`` in contract order and types, raising when a value does not fit, a required one is missing, or a key repeats.

    The result is written once.  Rows, misfits and nulls are counted by that write itself
    (they go to ``counts`` if given); only the keys are read again, to find repeated ones.
    """
    fitted = {c: F.col(c).try_cast(t) for c, t in contract.columns.items()}
    required = [c for c in contract.columns if c not in contract.nullable]
    measures = {"rows": F.count(F.lit(1))}
    measures |= {f"misfits {c}": F.count_if(F.col(c).isNotNull() & fitted[c].isNull()) for c in contract.columns}
    measures |= {f"nulls {c}": F.count_if(F.col(c).isNull()) for c in required}
    seen = Observation()
    observed = df.observe(seen, *[measure.alias(name) for name, measure in measures.items()])
    stored = materialize(observed.select(*[fitted[c].alias(c) for c in contract.columns]), "contract")
    found = {name: seen.get.get(name) or 0 for name in measures}
    if counts is not None:
        counts.update(found)
    bad = {name: n for name, n in found.items() if n and name != "rows"}
    if any(name.startswith("misfits") for name in bad):
        raise ValueError(f"contract violated: values that do not fit their column: {bad}")
    if bad:
        raise ValueError(f"contract violated: null in a required column: {bad}, as in {violations(stored, contract).first().asDict()}")
    repeated = stored.groupBy(*contract.key).agg(F.count("*").alias("row_count")).filter("row_count > 1").first()
    if repeated is not None:
        raise ValueError(f"contract violated: duplicate key {repeated.asDict()}")
    return stored
