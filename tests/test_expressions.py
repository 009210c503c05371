import pytest
from pyspark.sql import functions as F

from quaymark.functions import labels as L
from quaymark.functions import expressions as E


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    ("text", "want"),
    [("0 - 20000", 10000.0), ("1 - 2", 1.5), ("none", None), ("", None), ("7", 7.0), (None, None)],
)
def test_range_midpoint(spark, text, want):
    got = one(spark, E.range_midpoint(F.lit(text).cast("string")))
    assert (float(got) if got is not None else None) == want


@pytest.mark.parametrize(
    ("text", "want"),
    [("2023-01-15", 2023), ("Oct 21, 2008", 2008), ("2008", 2008), ("soon", None), (None, 0)],
)
def test_first_year(spark, text, want):
    assert one(spark, E.first_year(F.lit(text).cast("string"))) == want


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("['RPG', 'Indie']", ["RPG", "Indie"]),
        ("RPG,Indie", ["RPG", "Indie"]),
        ("['a', '', ' ']", ["a"]),
        ("", []),
        (None, None),
    ],
)
def test_list_items(spark, text, want):
    assert one(spark, E.list_items(F.lit(text).cast("string"))) == want


@pytest.mark.parametrize(("value", "want"), [("True", 1), ("TRUE", 1), ("1", 1), ("no", 0), ("", 0), (True, 1), (False, 0)])
def test_flag(spark, value, want):
    assert one(spark, E.flag(F.lit(value))) == want


@pytest.mark.parametrize(
    ("layout", "multi", "want"),
    [("3室2厅", False, 3), ("0室1厅", False, 0), ("10室2厅", False, -1), ("10室2厅", True, 10), ("开间", False, -1)],
)
def test_room_count(spark, layout, multi, want):
    assert one(spark, E.room_count(F.lit(layout), L.ROOM_MARK, multi)) == want


def test_word_safe_keeps_words_and_cjk(spark):
    assert one(spark, E.word_safe(F.lit("Ab1 w-世茂"))) == "Ab1_w_世茂"


@pytest.mark.parametrize(
    ("num", "den", "digits", "times", "want"),
    [(1, 3, 2, 100, 33.33), (-1, 8, 2, 1, -0.13), (1, 8, 2, 1, 0.13), (5, 0, 2, 1, None), (1, None, 2, 1, None)],
)
def test_exact_ratio(spark, num, den, digits, times, want):
    got = one(spark, E.exact_ratio(F.lit(num), F.lit(den).cast("bigint"), digits, times))
    assert (float(got) if got is not None else None) == want


@pytest.mark.parametrize(
    ("area", "want"), [(49, None), (50, "50-90㎡"), (90, "90-144㎡"), (144, "144-236㎡"), (236, "236㎡以上"), (9999, "236㎡以上")]
)
def test_area_ranges(spark, area, want):
    assert one(spark, E.in_ranges(F.lit(area), L.AREA_EDGES, L.AREA_LABELS)) == want


@pytest.mark.parametrize(
    ("year", "want"),
    [(1949, None), (1950, "1950-1970"), (1970, "1970-1990"), (2010, "2010-2020"), (2020, "2010-2020"), (2021, None)],
)
def test_year_ranges_close_at_the_end(spark, year, want):
    assert one(spark, E.in_ranges(F.lit(year), L.YEAR_EDGES, L.YEAR_LABELS, last_inclusive=True)) == want


@pytest.mark.parametrize(
    ("growth", "want"), [(20.01, "高速增长"), (20, "稳定增长"), (5, "基本持平"), (-5, "缓慢下降"), (-20, "快速下降"), (0, "基本持平")]
)
def test_growth_labels(spark, growth, want):
    assert one(spark, E.first_reached(F.lit(growth), L.GROWTH_STEPS, L.GROWTH_LOWEST, strict=True)) == want


@pytest.mark.parametrize(("score", "want"), [(15, 0), (13, 0), (12, 1), (10, 1), (7, 2), (6, 3)])
def test_user_level(spark, score, want):
    got = one(spark, E.first_reached(F.lit(score), L.USER_LEVEL_STEPS, L.USER_LEVEL_LOWEST, strict=False))
    assert got == L.USER_LEVEL_ORDER[want]


def test_parsing_bad_text_gives_null(spark):
    assert one(spark, E.parse_time(F.lit("not a time"), L.TIME_FORMAT)) is None
    assert float(one(spark, E.money(F.lit("abc")))) == 0.0
    assert float(one(spark, E.money(F.lit("1.005").cast("string")))) == 1.01


def test_enum_position(spark):
    assert one(spark, E.enum_position(F.lit("黄金"), L.MEMBER_LEVEL_ORDER)) == 3
    assert one(spark, E.enum_position(F.lit("?"), L.MEMBER_LEVEL_ORDER)) == 0
