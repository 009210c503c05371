"""Places of pattern matches in a text, with built-in expressions only.

Work is in proportion to the matches of a text: running places come from sums over blocks
(``running``), overlaps from sorted spans (``clear_of``), and parts of a text from its pieces.

Patterns are read by Java.  Those used here have possessive repeats where a repeated group
could otherwise go as deep as a text is long, and look-behinds where a failed match could
otherwise be tried again from each of its characters; neither changes what they match.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

SPAN = "struct<kind: string, start: int, end: int, found: string>"
BLOCK = 64
PIECE = 1024
LAST = (1 << 31) - 1


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, also where ``body`` reads it in its own loops."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _befores(items: Column, value: Callable[[Column], Column], combine: Callable[[Column, Column], Column]) -> Column:
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("before"))
    return F.aggregate(items, start, lambda state, x: F.struct(combine(state["at"], value(x)).alias("at"), F.array_append(state["before"], state["at"]).alias("before")))


def running(items: Column, value: Callable[[Column], Column], combine: Callable[[Column, Column], Column]) -> Column:
    """For each item, what the values of the items before it combine to (0 for the first).

    Arrays grow within blocks of ``BLOCK`` items and over blocks, so the work is in proportion
    to the items and not to their square.  ``items`` has to be a bound variable.
    """
    last = F.greatest(F.floor((F.size(items) - 1) / BLOCK).cast("int"), F.lit(0))
    blocks = F.transform(F.sequence(F.lit(0), last), lambda i: _befores(F.slice(items, i * BLOCK + 1, F.lit(BLOCK)), value, combine))

    def joined(local: Column) -> Column:
        starts = _befores(local, lambda b: b["at"], combine)["before"]
        return F.flatten(F.zip_with(local, starts, lambda b, s: F.transform(b["before"], lambda y: combine(s, y))))

    return let(blocks, joined)


def locate(text: Column, kind: str, pattern: str, valid: Callable[[Column], Column] | None = None) -> Column:
    """Leftmost non-overlapping matches that are valid, as an array of ``SPAN``; code points, end exclusive.

    The text between matches comes from ``split``; lengths add up to places.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.zip_with(F.split(text, pattern, -1), found, lambda gap, m: F.struct(F.length(gap).alias("gap"), F.coalesce(F.length(m), F.lit(0)).alias("size"), m.alias("found")))

    def placed(piece: Column, at: Column) -> Column:
        begin = at + piece["gap"]
        return F.struct(F.lit(kind).alias("kind"), begin.alias("start"), (begin + piece["size"]).alias("end"), piece["found"].alias("found"))

    def good(span: Column) -> Column:
        there = span["found"].isNotNull()
        return there if valid is None else there & F.coalesce(valid(span["found"]), F.lit(False))

    spans = let(pieces, lambda p: F.filter(F.zip_with(p, running(p, lambda x: x["gap"] + x["size"], lambda x, y: x + y), placed), good))
    # Most texts have no match at all, and then only the first scan is made.
    return F.when(F.coalesce(F.regexp_like(text, F.lit(pattern)), F.lit(False)), spans).otherwise(F.array().cast(f"array<{SPAN}>"))


def in_order(spans: Column, kinds: list[str]) -> Column:
    """Spans by start, then by the order of ``kinds``."""
    keyed = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.array_position(F.array(*[F.lit(k) for k in kinds]), s["kind"]).alias("rank"), s["end"].alias("end"), s["kind"].alias("kind")))
    return F.array_sort(keyed)


def as_text(ordered: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_kind(spans: str, kind: str) -> Column:
    """How many of an array of spans are of a kind."""
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def clear_of(spans: Column, others: Column) -> Column:
    """The ``spans`` that overlap none of ``others``, in their order; sorts both instead of comparing all pairs."""

    def free(own: Column, against: Column) -> Column:
        ours = F.transform(own, lambda s, i: F.struct(s["start"].alias("start"), i.alias("place"), s["end"].alias("end")))
        theirs = F.transform(against, lambda s: F.struct(s["start"].alias("start"), F.lit(-1).alias("place"), s["end"].alias("end")))
        return let(F.array_sort(F.concat(ours, theirs)), lambda row: let(F.reverse(row), lambda back: apart(own, row, back)))

    def apart(own: Column, row: Column, back: Column) -> Column:
        # Of the others that start no later, the last end; of those that start later, the first start.
        ends = running(row, lambda s: F.when(s["place"] < 0, s["end"]).otherwise(0), F.greatest)
        starts = F.reverse(running(back, lambda s: F.when(s["place"] < 0, LAST - s["start"]).otherwise(0), F.greatest))
        near = F.zip_with(ends, starts, lambda e, s: F.struct(e.alias("end"), (LAST - s).alias("start")))
        places = F.zip_with(row, near, lambda s, n: F.when((s["place"] >= 0) & (n["end"] <= s["start"]) & (n["start"] >= s["end"]), s["place"]))
        return F.transform(F.array_sort(F.filter(places, lambda i: i.isNotNull())), lambda i: F.get(own, i))

    few = (F.size(spans) == 0) | (F.size(others) == 0)
    return F.when(few, spans).otherwise(let(spans, lambda own: let(others, lambda against: free(own, against))))


def pieces_of(text: Column) -> Column:
    """``text`` cut into strings of ``PIECE`` code points, for ``cut``."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))


def cut(pieces: Column, start: Column, size: Column) -> Column:
    """``size`` code points from ``start`` on, read from the pieces they lie in and not from the first on."""
    first = F.floor(start / PIECE).cast("int")
    several = F.floor((start + size - 1) / PIECE).cast("int") - first + 1
    return F.when(size > 0, F.substring(F.array_join(F.slice(pieces, first + 1, several), ""), start - first * PIECE + 1, size)).otherwise("")


def mask(text: Column, ordered: Column, label: Callable[[Column], Column]) -> Column:
    """``text`` with each span replaced by its label; of overlapping spans the first gives the label."""

    def replaced(pieces: Column, spans: Column) -> Column:
        ends = running(spans, lambda s: s["end"], F.greatest)
        after = F.array_max(F.transform(spans, lambda s: s["end"]))
        parts = F.zip_with(spans, ends, lambda s, e: F.when(s["start"] >= e, F.concat(cut(pieces, e, s["start"] - e), label(s))).otherwise(""))
        return F.array_join(F.concat(parts, F.array(cut(pieces, after, F.length(text) - after))), "")

    return let(ordered, lambda spans: F.when(F.size(spans) > 0, let(pieces_of(text), lambda pieces: replaced(pieces, spans))).otherwise(text))
