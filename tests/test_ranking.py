import random
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import Window, functions as F

from quaymark.operators import ranking as R


def test_keep_first_uses_the_given_order(spark, rows):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (2, "c")], "k int, v string")
    got = {r["k"]: r["v"] for r in rows(R.keep_first(df, ["k"], [F.asc("v")]))}
    assert got == {1: "a", 2: "c"}


def test_keep_first_limits_hot_keys_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 1).alias("k"), "id")
    plan = R.keep_first(df, ["k"], [F.asc("id")])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_top_per_group(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("a", 3), ("b", 9)], "g string, v int")
    got = rows(R.top_per_group(df, ["g"], [F.desc("v")], 2, "rank"))
    assert sorted((r["g"], r["v"], r["rank"]) for r in got) == [("a", 2, 2), ("a", 3, 1), ("b", 9, 1)]


@pytest.mark.parametrize(("given_value", "want"), [("5", 5), (30, 30), (None, 10)])
def test_bounded_limit(given_value, want):
    assert R.bounded_limit(given_value, 10, 30) == want
    assert R.bounded_limit(200, 10) == 200


@pytest.mark.parametrize("given_value", ["x", "0", -3, 99])
def test_a_limit_that_cannot_be_met_raises(given_value):
    with pytest.raises(ValueError):
        R.bounded_limit(given_value, 10, 30)


def _skewed(spark, n=3000):
    """One value holds two thirds of the rows."""
    random.seed(7)
    data = [(i, 5 if i % 3 else random.randrange(100)) for i in range(n)]
    return spark.createDataFrame(data, "id bigint, v int").repartition(7)


def test_global_position_equals_single_window(spark):
    df = _skewed(spark)
    got = R.with_global_position(df, [F.asc("v"), F.asc("id")], "pos", total="all")
    want = df.withColumn("pos", F.row_number().over(Window.orderBy("v", "id"))).withColumn("all", F.lit(3000))
    assert got.exceptAll(want.select(got.columns)).isEmpty() and got.count() == 3000


def test_global_position_splits_a_hot_value(spark):
    # AQE would join such small ranges again.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = R.with_global_position(_skewed(spark, 6000), [F.asc("v"), F.asc("id")], "pos")
        stored = spark.read.parquet(*placed.inputFiles())
        assert stored.filter("v = 5").select("_part").distinct().count() > 1
        assert placed.agg(F.max("pos")).first()[0] == 6000
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.integers(0, 4), min_size=1, max_size=23))
def test_global_ntile_equals_ntile(spark, values):
    df = spark.createDataFrame(list(enumerate(values)), "id bigint, v int")
    got = R.with_global_ntile(df, [F.desc("v"), F.asc("id")], 5, "t")
    want = df.withColumn("t", F.ntile(5).over(Window.orderBy(F.desc("v"), "id")))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_global_position_of_nothing(spark):
    df = spark.createDataFrame([], "id bigint, v int")
    assert R.with_global_ntile(df, [F.asc("v")], 5, "t").collect() == []


def tile_rows(count, seed):
    rng = random.Random(seed)
    values = [rng.choice([None, 1, 2, 2, 2, rng.randrange(1000)]) for _ in range(count)]
    return [(i, f"u{i:05d}", v, None if v is None else v // 300, Decimal(rng.randrange(10**6)).scaleb(-2)) for i, v in enumerate(values)]


@pytest.mark.parametrize("count,tiles,sample", [(0, 5, 16), (1, 5, 16), (3, 5, 16), (7, 5, 16), (2000, 5, 128), (2001, 4, 100_000)])
def test_tiles_by_selection_equal_the_window(spark, count, tiles, sample):
    df = spark.createDataFrame(tile_rows(count, count), "id long, name string, v int, few int, money decimal(10,2)")
    for key in ("id", "name"):
        names = {"tv": "v", "tf": "few", "tm": "money"}
        got = R.with_tiles(df, names, key, tiles, sample)
        for name, column in names.items():
            got = got.withColumn(f"w_{name}", F.ntile(tiles).over(Window.orderBy(F.asc(column), F.asc(key))))
        assert got.where(" or ".join(f"{n} <> w_{n}" for n in names)).count() == 0
        assert got.count() == count


def test_selection_narrows_its_brackets_and_sorts_nothing(spark, monkeypatch):
    df = spark.range(0, 50_000, numPartitions=8).select("id", F.pmod(F.xxhash64("id"), F.lit(97)).alias("v"))
    sizes = []
    narrow = R._narrowed
    monkeypatch.setattr(R, "_narrowed", lambda found, *rest: sizes.append(len(found)) or narrow(found, *rest))
    tiled = R.with_tiles(df, {"t": "v"}, "id", 5, sample=600)
    assert sizes and max(sizes) <= 600
    plan = tiled._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan
    counts = [r["n"] for r in tiled.groupBy("t").agg(F.count("*").alias("n")).collect()]
    assert counts == [10_000] * 5


def test_a_bracket_that_missed_is_corrected(spark, monkeypatch):
    df = spark.range(3000).select("id", (F.col("id") * 7 % 3000).alias("v"))
    narrow, calls = R._narrowed, []

    def wrong(found, *rest):
        calls.append(1)
        if len(calls) > 4:
            return narrow(found, *rest)
        return (found[0], found[1], 5) if len(calls) % 2 else (found[-2], found[-1], 5)

    monkeypatch.setattr(R, "_narrowed", wrong)
    found = R.select_ranks(df, {"v": [1, 1500, 3000]}, "id", 100)
    assert found == {("v", r): (r - 1, (r - 1) * 2143 % 3000) for r in (1, 1500, 3000)} and len(calls) > 4
