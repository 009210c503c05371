"""Decoding and validation of JSON messages, for batch and streaming frames alike."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType, StructType

from quaymark.functions import labels as L
from quaymark.functions.expressions import MONEY, parse_time

ORDER_EVENT = (
    "order_id string, user_id string, order_time string, province string, city string, "
    "category string, pay_amount double, order_status string, channel string"
)
ITEM_EVENT = (
    "app_id bigint, name string, price double, genres string, estimated_owners bigint, "
    "positive int, negative int, timestamp timestamp"
)
PRICE_MESSAGE = "community string, price_per_sqm bigint, checkid bigint"


def parsed(lines: DataFrame, schema: str) -> DataFrame:
    """The fields of each message as columns, all NULL for text that is not JSON.

    Selecting ``from_json(...).*`` would be inlined into every later filter
    and column and parse each message many times over; a generator is
    evaluated once per row.
    """
    return lines.select(F.inline(F.array(F.from_json("value", schema))))


def one_object(value: Column) -> Column:
    """Whether a text is one JSON object and nothing besides.

    The JSON functions stop after the first value.  Inside brackets, and as a member
    of an object, only text that ends with that value still fits.
    """
    listed = F.json_array_length(F.concat(F.lit("["), value, F.lit("]")))
    member = F.json_object_keys(F.concat(F.lit('{"m":'), value, F.lit("}")))
    return F.json_object_keys(value).isNotNull() & (listed == 1) & (F.size(member) == 1)


def with_reason(
    lines: DataFrame, required: Sequence[str] = L.EVENT_FIELDS, schema: str = ORDER_EVENT
) -> DataFrame:
    """Column ``reason``: NULL for a good message, else why it is rejected; blank lines go.

    Text after the object, missing fields and values that do not fit their field's type
    each are a reason.
    """
    missing = F.array_sort(F.array_except(F.array(*[F.lit(f) for f in required]), F.json_object_keys("value")))
    typed = [f.name for f in StructType.fromDDL(schema) if not isinstance(f.dataType, StringType)]
    unfit = [
        F.when(F.get_json_object("value", f"$.{name}").isNotNull() & F.col(f"_read.{name}").isNull(), F.lit(name))
        for name in typed
    ]
    wrong = F.array_compact(F.array(*unfit)) if unfit else F.array().cast("array<string>")
    reason = (
        F.when(~F.coalesce(one_object(F.col("value")), F.lit(False)), "invalid json")
        .when(F.size(missing) > 0, F.concat(F.lit("missing "), F.array_join(missing, ", ")))
        .when(F.size(wrong) > 0, F.concat(F.lit("wrong type "), F.array_join(wrong, ", ")))
    )
    read = lines.filter(F.trim("value") != "").withColumn("_read", F.from_json("value", schema))
    return read.withColumn("reason", reason).drop("_read")


def split_events(
    lines: DataFrame, schema: str = ORDER_EVENT, required: Sequence[str] = L.EVENT_FIELDS
) -> tuple[DataFrame, DataFrame]:
    """(decoded good messages, rejected lines with their reason)."""
    marked = with_reason(lines, required, schema)
    good = parsed(marked.filter("reason is null"), schema)
    return good, marked.filter("reason is not null").select("value", "reason")


def decode(lines: DataFrame, schema: str, key: str) -> DataFrame:
    """Typed columns of each message; messages without the key field are left out."""
    return parsed(lines, schema).filter(F.col(key).isNotNull())


#: What else makes an order message useless, as conditions on its fields.
ORDER_FAULTS = {
    "unreadable order_time": lambda row: parse_time(row["order_time"], L.TIME_FORMAT).isNull(),
    "null category": lambda row: row["category"].isNull(),
}


def accepted_and_rejected(
    lines: DataFrame, schema: str, key: str, faults: Mapping[str, Callable[[Column], Column]] | None = None
) -> tuple[DataFrame, DataFrame]:
    """(typed good messages, ``(value, reason)`` of all others), for batch and streaming frames alike.

    Every line that is not blank is in exactly one of the two: rejected are texts that are
    not one JSON object, values that do not fit their field, a missing or null key, and
    messages with one of the ``faults``.
    """
    marked = with_reason(lines, [key], schema)
    # A generator is evaluated once per message, see parsed.
    read = marked.select("value", "reason", F.explode(F.array(F.from_json("value", schema))).alias("row"))
    reasons = [F.col("reason"), F.when(F.col("row")[key].isNull(), f"null {key}")]
    reasons += [F.when(fault(F.col("row")), reason) for reason, fault in (faults or {}).items()]
    judged = read.withColumn("reason", F.coalesce(*reasons))
    return judged.filter("reason is null").select("row.*"), judged.filter("reason is not null").select("value", "reason")


def order_events(lines: DataFrame, statuses: Sequence[str] = L.VALID_STATUSES) -> DataFrame:
    """Valid, timed, categorised order events with a default amount of 0."""
    return valid_order_events(decode(lines, ORDER_EVENT, "order_id"), statuses)


def valid_order_events(decoded: DataFrame, statuses: Sequence[str] = L.VALID_STATUSES) -> DataFrame:
    """``order_events`` of decoded messages."""
    return (
        decoded.withColumn("event_ts", parse_time(F.col("order_time"), L.TIME_FORMAT))
        .withColumn("pay_amount", F.coalesce(F.col("pay_amount"), F.lit(0.0)).cast(MONEY))
        .filter("event_ts is not null and category is not null")
        .filter(F.col("order_status").isin(*statuses))
    )


def to_messages(df: DataFrame, key: str | None = None) -> DataFrame:
    """Rows as JSON messages, keyed when a key column is named."""
    value = F.to_json(F.struct(*df.columns)).alias("value")
    return df.select(value) if key is None else df.select(F.col(key).cast("string").alias("key"), value)


def at_current_time(events: DataFrame) -> DataFrame:
    """Replay option: the order time becomes the sending time."""
    return events.withColumn("order_time", F.date_format(F.current_timestamp(), L.TIME_FORMAT))
