"""Column expressions shared by the operators (built-in functions only).

Every parse that could fail gives NULL, and every ratio is exact decimal
arithmetic rounded half up, so a result does not depend on how rows were
partitioned or in which order partial sums were added.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

MONEY = "decimal(18,2)"


def money(value: Column) -> Column:
    """Amount as DECIMAL(18,2), 0 when missing."""
    return F.coalesce(value.try_cast(MONEY), F.lit(0).cast(MONEY))


def exact_ratio(num: Column, den: Column, digits: int, times: int = 1) -> Column:
    """``num / den * times`` rounded half up to ``digits``; NULL when ``den`` is 0 or NULL."""
    wide = num.cast("decimal(28,4)")
    if times != 1:
        wide = (wide * F.lit(times)).cast("decimal(28,4)")
    return F.round(F.try_divide(wide, den.cast("decimal(20,2)")), digits)


def exact_avg(value: Column, digits: int) -> Column:
    """Mean of the non-null values of an integer or decimal column, rounded half up."""
    return exact_ratio(F.sum(value), F.count(value), digits)


def first_reached(value: Column, steps: Sequence[tuple], otherwise: str, strict: bool) -> Column:
    """Label of the first bound (descending) that ``value`` exceeds (or reaches)."""
    result = None
    for bound, label in steps:
        hit = value > bound if strict else value >= bound
        result = F.when(hit, label) if result is None else result.when(hit, label)
    return result.otherwise(otherwise)


def first_below(value: Column, steps: Sequence[tuple], otherwise: str) -> Column:
    """Label of the first bound (ascending) that ``value`` stays below."""
    result = None
    for bound, label in steps:
        result = F.when(value < bound, label) if result is None else result.when(value < bound, label)
    return result.otherwise(otherwise)


def in_ranges(
    value: Column,
    edges: Sequence,
    labels: Sequence[str],
    otherwise: str | None = None,
    last_inclusive: bool = False,
) -> Column:
    """Half-open ranges ``[edge, next edge)``.

    With as many labels as edges the last range is open-ended; with one label
    fewer it ends at the last edge, which ``last_inclusive`` includes.
    """
    result = None
    for i, label in enumerate(labels):
        hit = value >= edges[i]
        if i + 1 < len(edges):
            closing = last_inclusive and i == len(labels) - 1
            hit = hit & ((value <= edges[i + 1]) if closing else (value < edges[i + 1]))
        result = F.when(hit, label) if result is None else result.when(hit, label)
    return result.otherwise(F.lit(otherwise))


def in_closed_ranges(value: Column, ranges: Sequence[tuple], otherwise: str) -> Column:
    """Ranges given as (lowest, highest, label), both ends included."""
    result = None
    for low, high, label in ranges:
        hit = value.between(low, high)
        result = F.when(hit, label) if result is None else result.when(hit, label)
    return result.otherwise(otherwise)


def enum_position(value: Column, ordered: Sequence[str]) -> Column:
    """1-based position in a fixed list, 0 for anything else (custom sort order)."""
    return F.coalesce(F.array_position(F.array(*[F.lit(v) for v in ordered]), value), F.lit(0))


def range_midpoint(text: Column) -> Column:
    """Middle of a ``low - high`` text, NULL when either number is missing."""
    low = F.regexp_extract(text, r"^([0-9]+)", 1).try_cast("bigint")
    high = F.regexp_extract(text, r"([0-9]+)$", 1).try_cast("bigint")
    return ((low + high) / F.lit(2)).cast("decimal(18,1)")


def first_year(text: Column) -> Column:
    """First four-digit run of a date text; 0 for NULL, NULL when there is none."""
    found = F.regexp_extract(text, r"(\d{4})", 1).try_cast("int")
    return F.when(text.isNull(), F.lit(0)).otherwise(found)


def list_items(text: Column) -> Column:
    """Array of trimmed, non-blank items from ``['a', 'b']`` or ``a,b``."""
    bare = F.regexp_replace(F.regexp_replace(text, r"^\[|\]$", ""), "['\"]", "")
    return F.filter(F.transform(F.split(bare, ","), lambda item: F.trim(item)), lambda item: item != "")


def flag(value: Column) -> Column:
    """1 for TRUE (any case) or 1, else 0; accepts boolean and text columns."""
    text = F.upper(value.cast("string"))
    return F.when(text.isin("TRUE", "1"), 1).otherwise(0)


def room_count(layout: Column, mark: str, multi_digit: bool = False) -> Column:
    """Leading number of a layout text such as ``3室2厅``, -1 when unknown.

    One digit is read by default, so ten and more rooms count as unknown.
    """
    digits = "[0-9]+" if multi_digit else "[0-9]"
    found = F.regexp_extract(layout, f"^({digits}){mark}", 1).try_cast("int")
    return F.coalesce(found, F.lit(-1))


def word_safe(text: Column) -> Column:
    """Every character that is neither a word nor a CJK character becomes ``_``."""
    return F.regexp_replace(text, r"[^\w一-鿿]", "_")


def parse_time(text: Column, pattern: str) -> Column:
    return F.try_to_timestamp(text, F.lit(pattern))
