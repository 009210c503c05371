import datetime as dt
from decimal import Decimal
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from quaymark.functions import labels as L
from quaymark.operators import baskets, cleaning, commerce
from quaymark.plans import serving

PAID, DONE = L.VALID_STATUSES


@pytest.fixture(scope="module")
def orders(spark):
    schema = (
        "order_id string, user_id string, order_time string, pay_time string, province string, city string, "
        "channel string, order_status string, total_amount double, discount_amount double, pay_amount double"
    )
    row = lambda i, u, t, s, pay, ch="APP": (i, u, t, "", "p", "c", ch, s, pay, None, pay)
    data = [
        row("o1", "u1", "2025-01-01 10:00:00", PAID, 10.0),
        row("o2", "u1", "2025-01-01 10:59:59", DONE, 20.05, "PC"),
        row("o3", "u2", "2025-01-02 11:00:00", PAID, 30.0),
        row("o4", "u3", "2025-01-02 12:00:00", "已取消", 99.0),
        row("o5", "u3", "broken", PAID, 99.0),
        row(None, "u3", "2025-01-02 12:00:00", PAID, 99.0),
        row("o6", "u3", "2025-01-03 09:00:00", DONE, None),
    ]
    return cleaning.clean_orders(spark.createDataFrame(data, schema))


@pytest.fixture(scope="module")
def valid(orders):
    return cleaning.valid_orders(orders)


@pytest.fixture(scope="module")
def items(spark):
    schema = "item_id string, order_id string, product_id string, category string, quantity int, price double, amount double"
    data = [
        ("i1", "o1", "p1", "old", 1, 5.0, 5.0),
        ("i2", "o1", "p2", "old", 2, 5.0, 5.0),
        ("i3", "o2", "p1", None, 1, 7.0, 7.0),
        ("i4", "o2", "missing", "loose", None, 1.0, None),
        ("i5", "o3", "missing", None, 1, 1.0, 1.0),
        ("i6", "o3", "p2", None, 4, 5.0, 20.0),
        ("i7", "o3", "p3", None, 1, 9.0, 9.0),
        (None, "o3", "p3", None, 1, 9.0, 9.0),
    ]
    return cleaning.clean_order_items(spark.createDataFrame(data, schema))


@pytest.fixture(scope="module")
def products(spark):
    data = [("p1", "n", "food", "b", 5.0, 1.0), ("p2", "n", "toys", "b", None, 1.0), ("p3", "n", "books", "b", 9.0, 1.0)]
    schema = "product_id string, product_name string, category string, brand string, price double, cost double"
    return cleaning.clean_products(spark.createDataFrame(data, schema))


def test_orders_are_typed_and_defaulted(orders, rows):
    got = {r["order_id"]: r for r in rows(orders)}
    assert sorted(got) == ["o1", "o2", "o3", "o4", "o6"]
    assert got["o1"]["stat_hour"] == 10 and got["o1"]["stat_date"] == dt.date(2025, 1, 1)
    assert got["o6"]["pay_amount"] == 0.0 and got["o1"]["pay_ts"] is None


def test_items_without_category_are_dropped(items, products, rows):
    got = {r["item_id"]: r["final_category"] for r in rows(commerce.attach_category(items, products))}
    assert got == {"i1": "food", "i2": "toys", "i3": "food", "i4": "loose", "i6": "toys", "i7": "books"}


def test_sales_time_trend(valid, rows):
    got = rows(commerce.sales_time_trend(valid))
    assert got[0] == {
        "stat_date": dt.date(2025, 1, 1), "stat_hour": 10, "order_count": 2, "user_count": 1,
        "total_amount": 30.05, "discount_amount": 0.0, "pay_amount": 30.05, "avg_order_amount": 15.03,
    }
    assert len(got) == 3


def test_category_rank_breaks_ties_by_name(valid, items, products, rows):
    got = rows(commerce.category_sales_rank(valid, items, products, top_n=2))
    first = [(r["category"], r["category_rank"]) for r in got if r["stat_date"] == dt.date(2025, 1, 1)]
    assert first == [("food", 1), ("toys", 2)]
    second = [(r["category"], r["amount_sum"]) for r in got if r["stat_date"] == dt.date(2025, 1, 2)]
    assert second == [("toys", 20.0), ("books", 9.0)]


def test_user_value(valid, spark, rows):
    users = spark.createDataFrame([("u1", "P", "C", "黄金")], "user_id string, province string, city string, member_level string")
    got = {r["user_id"]: r for r in rows(commerce.user_value(valid, users))}
    assert {u: r["recency_days"] for u, r in got.items()} == {"u1": 3, "u2": 2, "u3": 1}
    assert got["u1"]["frequency"] == 2 and got["u1"]["monetary"] == 30.05 and got["u2"]["member_level"] is None
    assert [got[u]["r_score"] for u in ("u1", "u2", "u3")] == [1, 2, 3]
    assert [got[u]["m_score"] for u in ("u3", "u2", "u1")] == [1, 2, 3]
    assert all(r["total_score"] == r["r_score"] + r["f_score"] + r["m_score"] for r in got.values())


def test_order_events_take_the_leading_category(valid, items, products, rows):
    got = {r["order_id"]: r["category"] for r in rows(commerce.order_events(valid, items, products))}
    assert got == {"o1": "food", "o2": "food", "o3": "toys"}


def _brute_rules(sets, min_support, min_confidence):
    sets = [s for s in sets if len(s) >= 2]
    total, names = len(sets), sorted(set().union(*sets))
    count = {n: sum(n in s for s in sets) for n in names}
    found = {}
    for a, c in permutations(names, 2):
        both = sum(a in s and c in s for s in sets)
        if both and round(both / total, 6) >= min_support and round(both / count[a], 6) >= min_confidence:
            confidence = round(both / count[a], 6)
            found[(a, c)] = (round(both / total, 6), confidence, round(confidence / (count[c] / total), 6))
    return found


@pytest.mark.parametrize(("support", "confidence"), [(0.0, 0.0), (0.2, 0.1), (0.4, 0.6), (0.99, 0.99)])
def test_pair_rules_equal_brute_force(spark, rows, support, confidence):
    sets = [{"a", "b"}, {"a", "b", "c"}, {"b", "c"}, {"a"}, {"a", "c", "d"}, {"d", "e"}, {"a", "b"}]
    pairs = [(f"o{i}", name) for i, s in enumerate(sets) for name in s] + [("o0", "a")] * 50
    got = rows(baskets.pair_rules(spark.createDataFrame(pairs, "order_id string, category string"), support, confidence))
    found = {(r["antecedent"], r["consequent"]): (r["support"], r["confidence"], r["lift"]) for r in got}
    want = _brute_rules(sets, support, confidence)
    assert sorted(found) == sorted(want)
    assert all(found[k] == pytest.approx(want[k], abs=1e-9) for k in want)
    assert all(r["confidence"] <= 1 for r in got)
    for (a, c), (s, _, _) in found.items():
        if (c, a) in found:
            assert found[(c, a)][0] == s


def test_rule_graph(spark, rows):
    rules = spark.createDataFrame([("a", "b", 2.0, 0.5, 0.1), ("b", "a", 2.0, 0.4, 0.1)],
                                  "antecedent string, consequent string, lift double, confidence double, support double")
    assert sorted(r["name"] for r in rows(baskets.rule_nodes(rules))) == ["a", "b"]
    assert rows(baskets.rule_links(rules))[0] == {
        "source": "a", "target": "b", "value": 2.0, "lift": 2.0, "confidence": 0.5, "support": 0.1,
    }


def test_reports(valid, items, products, rows):
    trend = commerce.sales_time_trend(valid)
    summary = rows(serving.sales_summary(trend))[0]
    assert summary["order_count"] == 4 and summary["user_hours"] == 3
    assert summary["start_date"] == "2025-01-01" and summary["end_date"] == "2025-01-03"
    assert summary["avg_order_amount"] == 15.01
    empty = rows(serving.sales_summary(trend.filter("false")))[0]
    assert empty["order_count"] == 0 and empty["avg_order_amount"] == 0.0 and empty["start_date"] is None
    assert [r["order_count"] for r in rows(serving.sales_daily(trend))] == [2, 1, 1]
    assert rows(serving.sales_hourly(trend))[0]["stat_hour_label"] == "09"
    assert rows(serving.distinct_users(valid))[0]["user_count"] == 3
    ranked = commerce.category_sales_rank(valid, items, products, 2)
    assert rows(serving.category_top(ranked, limit=1))[0]["category"] == "toys"


def test_level_reports_follow_the_fixed_order(spark, rows):
    data = [("普通", "低价值用户", 1.0, 1, 1), (None, "高价值用户", 3.0, 2, 5), ("黑金", "高价值用户", 2.0, 2, 4)]
    df = spark.createDataFrame(data, "member_level string, user_level string, monetary double, frequency int, recency_days int")
    assert [r["user_level"] for r in rows(serving.user_levels(df))] == ["高价值用户", "低价值用户"]
    assert rows(serving.user_levels(df))[0]["user_ratio"] == 0.6667
    assert [r["member_level"] for r in rows(serving.member_levels(df))] == ["普通", "黑金", "未知"]
    matrix = {r["member_level"]: r for r in rows(serving.member_matrix(df))}
    assert matrix["普通"]["低价值用户"] == 1 and matrix["普通"]["高价值用户"] == 0
    assert rows(serving.user_value_summary(df))[0]["user_count"] == 3


def test_signatures_collapse_repeated_baskets(spark):
    pairs = spark.range(1000).select(F.col("id").alias("order_id"), F.explode(F.array(F.lit("x"), F.lit("y"))).alias("category"))
    assert [tuple(r) for r in baskets.basket_signatures(pairs, "order_id", "category").collect()] == [(["x", "y"], 1000)]


def test_rules_need_baskets_of_two(spark):
    alone = spark.createDataFrame([("o1", "a"), ("o2", "b")], "order_id string, category string")
    assert baskets.pair_rules(alone).collect() == []
    with pytest.raises(ValueError, match="two different"):
        baskets.pair_rules(alone, require_baskets=True)


def test_one_basket_of_very_many_items_does_not_reach_the_rules(spark):
    """Its rare items go before a set is put together, so the set holds frequent items only."""
    huge = spark.range(100_000).select(F.lit("huge").alias("order_id"), F.concat(F.lit("i"), "id").alias("category"))
    usual = spark.range(300).select(F.concat(F.lit("o"), "id").alias("order_id"), F.explode(F.array(F.lit("i1"), F.lit("i2"))).alias("category"))
    rules = baskets.pair_rules(huge.union(usual), min_support=0.01)
    got = {(r["antecedent"], r["consequent"]): (r["pair_order_count"], r["total_basket_count"]) for r in rules.collect()}
    assert got == {("i1", "i2"): (301, 301), ("i2", "i1"): (301, 301)}


def test_an_order_of_two_users_ends_the_trend(spark):
    schema = "stat_date date, stat_hour int, order_id string, user_id string, total_amount decimal(18,2), discount_amount decimal(18,2), pay_amount decimal(18,2)"
    day = dt.date(2025, 1, 1)
    one, two = Decimal(1), Decimal(2)
    df = spark.createDataFrame([(day, 1, "o", "u", two, one, one), (day, 1, "p", "u", two, one, None), (day, 1, "p", "u", two, one, one)], schema)
    row = commerce.sales_time_trend(df).first()
    assert (row["order_count"], row["user_count"], row["pay_amount"], row["avg_order_amount"]) == (2, 1, 2, 1)
    with pytest.raises(Exception, match="more than one user"):
        commerce.sales_time_trend(df.withColumn("user_id", F.when(F.col("pay_amount").isNull(), "v").otherwise("u"))).collect()
