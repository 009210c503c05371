"""Plans of named queries on the test tables: what is scanned, and that no row is multiplied."""

import pytest

from quaymark.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


def plan(spark, name):
    return QUERIES[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", ["sales_time_trend", "category_sales_rank"])
def test_distinct_counts_multiply_no_rows(spark, name):
    assert "Expand" not in plan(spark, name)


def test_items_are_cleaned_without_reading_every_column(spark):
    text = plan(spark, "platform_categories")
    assert "l_extendedprice" not in text and "l_quantity" not in text
