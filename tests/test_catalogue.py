import pytest
from pyspark.sql import functions as F

from quaymark.functions import labels as L
from quaymark.operators import baskets, catalogue as C, cleaning

COLUMNS = (
    "`AppID` bigint, `Name` string, `Release date` string, `Estimated owners` string, `Price` double, "
    "`Average playtime forever` bigint, `Recommendations` bigint, `Positive` bigint, `Negative` bigint, "
    "`Metacritic score` int, `Genres` string, `Tags` string, `Developers` string, `Publishers` string, "
    "`Windows` string, `Mac` string, `Linux` string"
)


def item(key, name="Half Game", date="2023-01-15", owners="0 - 20000", price=4.99, pos=90, neg=10, genres="['RPG', 'Indie']",
         tags="['a', 'b']", dev="Studio A", recs=5000, platforms=("True", "0", "")):
    return (key, name, date, owners, price, 120, recs, pos, neg, 80, genres, tags, dev, "Pub", *platforms)


@pytest.fixture(scope="module")
def items(spark):
    data = [
        item(1),
        item(1, name="Other copy"),
        item(None),
        item(2, name=""),
        item(3, name=None),
        item(4, owners="unknown"),
        item(5, date="soon"),
        item(6, date="1979"),
        item(7, date="Jan 1, 2027"),
        item(8, date=None),
        item(9, price=None, pos=0, neg=0, date="Oct 21, 2022", genres="RPG", dev=None),
        item(10, price=5.0, date="2022", tags="['a', '', 'a']", dev="Studio B", platforms=("TRUE", "1", "true")),
        item(11, price=60.0, date="2022", dev="Studio B"),
    ]
    return cleaning.clean_catalogue(spark.createDataFrame(data, COLUMNS), [F.asc("Name")])


def test_cleaning(items, rows):
    got = {r["AppID"]: r for r in rows(items)}
    assert sorted(got) == [1, 4, 9, 10, 11]
    assert got[1]["Name"] == "Half Game" and got[1]["owners_numeric"] == 10000.0
    assert got[4]["owners_numeric"] is None and got[9]["Price"] == 0.0
    assert got[9]["release_year"] == 2022


def test_column_names_are_normalised(spark):
    df = spark.createDataFrame([(1, 2)], "` a b` int, `c.d` int")
    assert cleaning.normalise_names(df).columns == ["a_b", "c_d"]


def test_market_trend(items, rows):
    got = rows(C.market_trend(items))
    assert [r["year"] for r in got] == [2022, 2023]
    assert got[0]["yoy_growth_pct"] == 0.0 and got[0]["yoy_growth_category"] == "基本持平"
    assert got[1]["yoy_growth_pct"] == -33.33 and got[1]["yoy_growth_category"] == "快速下降"
    assert got[0]["release_count"] == 3 and got[0]["avg_price"] == 21.67


@pytest.mark.parametrize(
    ("price", "plain", "strict"),
    [
        (0.0, "Free", "Free"),
        (-1.0, "Free", "50+"),
        (4.99, "0.01-4.99", "0.01-4.99"),
        (4.995, "0.01-4.99", "50+"),
        (5.0, "5-9.99", "5-9.99"),
        (9.995, "5-9.99", "50+"),
        (19.995, "10-19.99", "50+"),
        (49.99, "20-49.99", "20-49.99"),
        (49.995, "20-49.99", "50+"),
        (50.0, "50+", "50+"),
    ],
)
def test_price_buckets(spark, price, plain, strict):
    df = spark.createDataFrame([(price,)], "Price double")
    assert C.with_price_bucket(df).first()["price_bucket"] == plain
    assert C.with_price_bucket(df, strict_gaps=True).first()["price_bucket"] == strict


def test_price_review_shares(items, rows):
    got = {r["price_bucket"]: r for r in rows(C.price_review(items))}
    assert got["0.01-4.99"]["game_count"] == 2 and got["0.01-4.99"]["game_pct"] == 40.0
    assert got["Free"]["avg_positive_rate_pct"] == 50.0
    assert abs(sum(r["game_pct"] for r in got.values()) - 100) < 0.05
    assert abs(sum(r["owners_share_pct"] for r in got.values()) - 100) < 0.05


def test_price_review_of_nothing(items):
    assert C.price_review(items.filter("false")).collect() == []


def test_best_value(items, rows):
    got = rows(C.best_value(items))
    assert [r["AppID"] for r in got] == [1, 4, 10]
    assert C.best_value(items, k=1).count() == 1


def test_genres_and_tags(items, rows):
    genres = {r["genre"]: r["count"] for r in rows(C.genre_distribution(items))}
    assert genres == {"RPG": 5, "Indie": 4}
    tags = {r["tag"]: (r["frequency"], r["total_games"]) for r in rows(C.tag_distribution(items))}
    assert tags == {"a": (6, 5), "b": (4, 4)}
    assert C.tag_distribution(items, k=1).first()["tag"] == "a"
    assert C.top_selling_genres(items).count() == 2


def test_developers(items, rows):
    got = {r["developer"]: r for r in rows(C.developer_ecosystem(items))}
    assert got["Studio B"]["game_count"] == 2 and got["Studio B"]["platform_diversity"] == 2.0
    assert got[None]["platform_diversity"] is None
    assert got["Studio B"]["market_share_pct"] == 50.0
    assert got["Studio A"]["genre_diversity"] == 1
    assert got["Studio A"]["market_hhi"] == 3750.0 and got["Studio A"]["market_structure"] == "高度集中"
    spread = {r["developer"]: r["genre_count"] for r in rows(C.developer_genres(items))}
    assert spread == {"Studio A": 2, "Studio B": 2, None: 1}


def test_concentration_bounds(items, spark):
    index = C.concentration(C.developer_totals(items)).first()
    assert 0 <= index["market_hhi"] <= 10000
    labels = spark.createDataFrame([(999.0,), (1000.0,), (2500.0,)], "h double")
    got = [r[0] for r in labels.select(C.concentration_label(F.col("h"))).collect()]
    assert got == ["分散市场", "适度集中", "高度集中"]


def test_platforms(items, rows):
    got = {r["platform_category"]: r["game_count"] for r in rows(C.platform_categories(items))}
    assert got == {"单平台(Windows)": 4, "三平台": 1}


def test_developer_classes_average_the_averages(spark, rows):
    data = [("solo", 10.0, 50)] + [("duo", 1.0, 60), ("duo", 2.0, 60)] + [("big", 5.0, 70)] * 11 + [("huge", 9.0, None)] * 51
    df = spark.createDataFrame(data, "Developers string, Price double, Metacritic_score int")
    got = {r["developer_category"]: r for r in rows(C.developer_classes(df))}
    assert {k: v["total_games"] for k, v in got.items()} == {
        "独立开发者": 1, "小型厂商": 2, "中型厂商": 11, "大型厂商": 51,
    }
    assert got["小型厂商"]["avg_game_price"] == 1.5 and got["大型厂商"]["avg_metacritic"] is None


def test_overview(items, rows):
    got = rows(C.overview(items))[0]
    assert got == {"total_games": 5, "total_years": 2, "free_games_pct": 20.0, "top_developer": "Studio A"}


def test_tag_baskets_are_sets_of_two_or_more(items, rows):
    got = sorted(r["items"] for r in rows(baskets.tag_baskets(items)))
    assert got == [["a", "b"]] * 4


def test_frequent_items_and_rules(spark, rows):
    df = spark.createDataFrame([(["a", "b"],), (["a", "b", "c"],), (["a", "c"],)], "items array<string>")
    model = baskets.fit_frequent_items(df, 0.6, 0.9)
    sets = {tuple(r["items"]): r["freq"] for r in rows(baskets.frequent_itemsets(model))}
    assert sets == {("a",): 3, ("b",): 2, ("c",): 2, ("a", "b"): 2, ("a", "c"): 2}
    rules = {(r["antecedent"][0], r["consequent"][0]) for r in rows(baskets.association_rules(model))}
    assert rules == {("b", "a"), ("c", "a")}


def test_labels_are_complete():
    assert len(L.AREA_EDGES) == len(L.AREA_LABELS) and len(L.YEAR_EDGES) == len(L.YEAR_LABELS) + 1
