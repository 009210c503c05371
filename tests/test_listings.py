import random
import statistics

import pytest
from pyspark.sql import functions as F

from quaymark.operators import cleaning, listings as Ls, merge

RAW = (
    "district string, community string, layout string, orientation string, floor_num int, decoration string, "
    "elevator string, area int, price int, build_year string"
)


def raw_row(district="海淀", community="世茂 1-a", layout="3室2厅", decoration="精装", elevator="有电梯", area=100, price=300, year="2005"):
    return (district, community, layout, "南", 3, decoration, elevator, area, price, year)


@pytest.fixture(scope="module")
def clean(spark):
    data = [
        raw_row(),
        raw_row(area=49, price=50, elevator="无电梯"),
        raw_row(area=50, price=60, layout="0室1厅", decoration="简装"),
        raw_row(area=90, price=90, layout="10室2厅", decoration="毛坯", year="1950"),
        raw_row(area=144, price=100, layout="1室1厅", elevator="?", year="2020"),
        raw_row(area=236, price=900, layout="5室1厅", year="2021"),
        raw_row(district="朝阳", community="b", area=120, price=120, year="1949"),
        raw_row(area=0),
        raw_row(price=0),
        raw_row(year="99"),
        raw_row(year="20050"),
        raw_row(district=None),
        raw_row(community=None),
    ]
    return cleaning.clean_listings(spark.createDataFrame(data, RAW))


def test_cleaning(clean, rows):
    got = rows(clean)
    assert len(got) == 7
    top = [r for r in got if r["area"] == 100][0]
    assert top["price_per_sqm"] == 30000 and top["house_age"] == 20 and top["checkid"] == 1 and top["elevator_int"] == 1
    assert top["rowkey"].startswith("海淀_世茂_1_a_")
    assert sorted(int(r["rowkey"].rsplit("_", 1)[1]) for r in got) == list(range(1, 8))
    assert [r["rowkey"] for r in got if r["district"] == "朝阳"] in (["朝阳_b_1"], ["朝阳_b_7"])


def test_area(clean, rows):
    got = {r["area_range"]: r for r in rows(Ls.area_price(clean))}
    assert {k: r["house_count"] for k, r in got.items()} == {"50-90㎡": 1, "90-144㎡": 3, "144-236㎡": 1, "236㎡以上": 1}
    # Shares are of all seven listings, the one below every range included.
    assert got["90-144㎡"]["area_ratio"] == 42.86 and sum(r["area_ratio"] for r in got.values()) < 100
    one = got["236㎡以上"]
    assert one["price_variance"] is None and one["price_stddev"] is None
    assert one["price_level"] == "高价位" and got["144-236㎡"]["price_level"] == "低价位"
    assert got["90-144㎡"]["min_price"] == 10000 and got["90-144㎡"]["median_price"] == 10000


@pytest.mark.parametrize("accuracy", [None, 1_000_000])
def test_statistics_equal_brute_force(spark, rows, accuracy):
    random.seed(3)
    data = [("a" if i % 3 else "b", random.randrange(1, 60) * 97, random.randrange(40), 10) for i in range(999)]
    df = spark.createDataFrame(data, "k string, price_per_sqm int, house_age int, area int")
    for r in rows(Ls.price_statistics(df, ["k"], accuracy)):
        prices = sorted(p for k, p, _, _ in data if k == r["k"])
        ages = [a for k, _, a, _ in data if k == r["k"]]
        assert r["house_count"] == len(prices) and r["min_price"] == prices[0] and r["max_price"] == prices[-1]
        assert r["avg_price_per_sqm"] == sum(prices) // len(prices) and r["avg_house_age"] == sum(ages) // len(ages)
        assert r["median_price"] == statistics.median_low(prices)
        assert r["price_variance"] == int(statistics.variance(prices))
        assert r["price_stddev"] == int(statistics.stdev(prices)) and r["avg_area"] == 10


def test_sketches_of_batches_merge(spark, rows):
    random.seed(4)
    # A hot district, batches of unlike prices, a district of one listing, listings without a price.
    data = [("a" if i % 9 else "b", 1 + i % 3, random.randrange(1, 9000) * (1 + i % 3), 10) for i in range(6000)]
    data += [("c", 2, 77, 10), ("c", 2, None, 10), ("d", 1, None, 10), ("d", 1, 5, 0)]
    df = spark.createDataFrame(data, "district string, checkid int, price_per_sqm int, area int")
    asked = [0.0, 0.25, 0.5, 0.9, 1.0]
    sketches = Ls.price_sketches(df)
    # Beyond one listing's sketch, its size is bounded.
    assert all(len(r["price_sketch"]) < 20_000 for r in rows(sketches))
    got = {r["district"]: r for r in rows(Ls.merged_quantiles(sketches, probabilities=asked))}
    assert set(got) == {"a", "b", "c"} and got["c"]["price_quantiles"] == [77] * 5
    for k, r in got.items():
        prices = sorted(p for d, _, p, area in data if d == k and p and area)
        assert r["house_count"] == len(prices)
        for share, price in zip(asked, r["price_quantiles"]):
            below, upto = (sum(f) / len(prices) for f in ([p < price for p in prices], [p <= price for p in prices]))
            assert below - Ls.RANK_ERROR <= share <= upto + Ls.RANK_ERROR
    ranks = Ls.price_ranks(df, spark.createDataFrame([("a", 9000), ("c", 77)], "district string, price long"))
    ranks = {r["district"]: (r["share_below"], r["share_upto"]) for r in rows(ranks)}
    prices = [p for d, _, p, _ in data if d == "a"]
    assert ranks["c"] == (0, 1) and ranks["a"] == pytest.approx((sum(p < 9000 for p in prices) / len(prices), sum(p <= 9000 for p in prices) / len(prices)))
    assert rows(Ls.merged_quantiles(Ls.price_sketches(df.limit(0)))) == []


def test_negative_ages_truncate_towards_zero(spark, rows):
    df = spark.createDataFrame([(1, 5, -1), (1, 5, -2)], "k int, price_per_sqm int, house_age int").withColumn("area", F.lit(1))
    assert rows(Ls.price_statistics(df, ["k"]))[0]["avg_house_age"] == -1


def test_district_and_community(clean, rows):
    districts = {r["district"]: r for r in rows(Ls.district_price(clean))}
    assert districts["海淀"]["house_count"] == 6 and districts["海淀"]["avg_area"] == 111
    communities = rows(Ls.community_price(clean))
    assert {r["community"]: r["build_year"] for r in communities} == {"世茂 1-a": "1950-2021", "b": "1949"}
    assert rows(Ls.community_top(Ls.community_price(clean), 1))[0]["community"] == "世茂 1-a"


def test_years(clean, rows):
    got = {r["year_range"]: r for r in rows(Ls.year_layout(clean))}
    assert sorted(got) == ["1950-1970", "2000-2010", "2010-2020"]
    recent = got["2000-2010"]
    # A layout of no rooms is in no class.
    assert recent["house_count"] == 3 and recent["medium_layout_count"] == 2 and recent["large_layout_count"] == 0
    assert got["1950-1970"]["large_layout_count"] == 1 and got["1950-1970"]["rough_decoration_count"] == 1
    assert got["2010-2020"]["elevator_count"] == 0
    shares = {r["year_range"]: r for r in rows(Ls.layout_share(Ls.year_layout(clean)))}
    assert shares["2000-2010"]["medium_layout_pct"] == 100.0


def test_empty_layout_share_is_zero(spark, rows):
    df = spark.createDataFrame([("r", 1, 0, 0, 0)], "year_range string, checkid int, small_layout_count int, medium_layout_count int, large_layout_count int")
    assert rows(Ls.layout_share(df))[0]["small_layout_pct"] == 0.0


def test_matrix(clean, rows):
    got = {r["area_range"]: r for r in rows(Ls.area_level_matrix(Ls.area_price(clean)))}
    assert got["236㎡以上"]["高价位"] == 38136 and got["236㎡以上"]["低价位"] == 0


def test_batches_stay_apart(spark, rows):
    data = [raw_row(), raw_row(price=200)]
    df = spark.createDataFrame(data, RAW).withColumn("b", F.when(F.col("price") == 200, 2).otherwise(1))
    clean = cleaning.clean_listings(df, batch_id=F.col("b"))
    assert sorted(r["checkid"] for r in rows(Ls.area_price(clean))) == [1, 2]


def test_watched_messages(clean, rows):
    got = rows(Ls.watched_messages(clean))
    assert sorted(r["price_per_sqm"] for r in got) == [10000, 30000]


def test_weighted_merge(spark, rows):
    schema = "community string, number bigint, averageprice bigint"
    old = spark.createDataFrame([("a", 2, 100), ("b", 1, 7)], schema)
    new = spark.createDataFrame([("a", 1, 101), ("c", 4, 9)], schema)
    got = {r["community"]: (r["number"], r["averageprice"]) for r in rows(merge.weighted_merge(old, new))}
    assert got == {"a": (3, 100), "b": (1, 7), "c": (4, 9)}
    labelled = rows(merge.watched_result(merge.weighted_merge(old, new)))
    assert labelled[0]["district"] == "海淀" and labelled[0]["area"] == "90-144㎡"


@pytest.mark.parametrize("price_type", ["int", "decimal(18,2)"])
@pytest.mark.parametrize("area_type", ["int", "decimal(12,2)"])
def test_unit_price_rounds_half_up(spark, price_type, area_type):
    from decimal import ROUND_HALF_UP, Decimal

    cases = [(1, 3), (1, 16000), (3, 20000), (5, 20000), (299, 37), (123456, 7), (2, 80000)]
    df = spark.createDataFrame(cases, "price int, area int").select(
        F.col("price").cast(price_type), F.col("area").cast(area_type)
    )
    got = [r[0] for r in df.select(cleaning.unit_price(df)).collect()]
    want = [int((Decimal(p) * 10000 / a).quantize(Decimal(1), ROUND_HALF_UP)) for p, a in cases]
    assert got == want


def test_a_unit_price_out_of_range_is_null(spark):
    df = spark.createDataFrame([(1, 900_000), (90, 300)], "area int, price int")
    assert sorted((r[0] for r in df.select(cleaning.unit_price(df)).collect()), key=str) == [33333, None]


def test_variance_is_exact_next_to_a_whole_number(spark, rows):
    """Large prices whose variance doubles would round."""
    prices = [2_000_000_000 + k for k in (0, 1, 2, 4)] * 250
    df = spark.createDataFrame([("k", p, 1, 10) for p in prices], "k string, price_per_sqm int, house_age int, area int")
    got = rows(Ls.price_statistics(df, ["k"]))[0]
    assert got["price_variance"] == int(statistics.variance(prices)) and got["price_stddev"] == 1
