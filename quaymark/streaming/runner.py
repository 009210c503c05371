"""Starting streams and storing their micro-batches.

Every writer is idempotent per stream and micro-batch id, so a batch that is
replayed after a failure replaces its first attempt.  Micro-batch ids start at 0
with every checkpoint, so a batch is known by its stream's id (which Spark keeps in the
checkpoint) and its number, and stored batches are ordered by when they came.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from quaymark.operators.merge import merge_sums, running_totals, with_mean
from quaymark.operators.ranking import keep_first
from quaymark.session import materialize
from quaymark.sinks import jdbc
from quaymark.sinks.state import apply_once, read_state
from quaymark.sinks.storage import child_names, delete, exists
from quaymark.sources.jdbc import read_table


#: Called with the rows, the number and the stream id of a micro-batch.
BatchWriter = Callable[[DataFrame, int, str], None]


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gave the stream of a checkpoint folder; it stays the same over restarts."""
    row = spark.read.text(f"{checkpoint}/metadata").select(F.get_json_object("value", "$.id")).first()
    return row[0]


def start(
    df: DataFrame,
    each_batch: BatchWriter,
    checkpoint: str,
    mode: str = "update",
    trigger_seconds: int | None = None,
) -> StreamingQuery:
    """Run ``each_batch`` on every micro-batch; without a trigger interval, drain the source and stop."""

    def save(batch: DataFrame, batch_id: int) -> None:
        each_batch(batch, batch_id, stream_id(batch.sparkSession, checkpoint))

    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(save)
    if trigger_seconds is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{trigger_seconds} seconds").start()


def await_end(query: StreamingQuery, timeout: int | None = None) -> bool:
    """Wait for the stream, raising its error; on timeout stop it and return False."""
    ended = query.awaitTermination(timeout) if timeout is not None else query.awaitTermination()
    if timeout is not None and not ended:
        query.stop()
        return False
    return True


class Stored(NamedTuple):
    """A stored batch: its place in the order of arrival, its stream and its number."""

    place: int
    stream: str
    batch_id: int

    @property
    def folder(self) -> str:
        return f"place={self.place}/stream={self.stream}/batch_id={self.batch_id}"


def _values(names: list[str], key: str) -> list[str]:
    return [n.split("=", 1)[1] for n in names if n.startswith(key + "=")]


def _stored(spark: SparkSession, path: str, whole: bool = True) -> list[Stored]:
    """Stored batches in their order; ``whole=False`` includes those cut short."""
    found = []
    for place in _values(child_names(spark, path), "place"):
        for stream in _values(child_names(spark, f"{path}/place={place}"), "stream"):
            for batch_id in _values(child_names(spark, f"{path}/place={place}/stream={stream}"), "batch_id"):
                one = Stored(int(place), stream, int(batch_id))
                if not whole or exists(spark, f"{path}/{one.folder}/_SUCCESS"):
                    found.append(one)
    return sorted(found)


def _slot(spark: SparkSession, path: str, batch_id: int, stream: str, after: int = -1) -> Stored:
    """Where a batch belongs: its earlier place if it came before, else the next one."""
    known = _stored(spark, path, whole=False)
    same = [s for s in known if (s.stream, s.batch_id) == (stream or "none", batch_id)]
    newest = max([after, *(s.place for s in known)])
    return same[-1] if same else Stored(newest + 1, stream or "none", batch_id)


def change_log(path: str, keys: Sequence[str] | None = None, compact_every: int | None = None) -> BatchWriter:
    """Batch writer for update mode: the changed rows of each micro-batch in its own folder.

    With ``keys`` and ``compact_every`` the folders are folded into one base
    table every so many batches, so a long-running log stays short.
    """

    def save(batch: DataFrame, batch_id: int, stream: str = "") -> None:
        spark = batch.sparkSession
        base = _base(spark, path)
        if base is not None and not _folded(spark, path, base, batch_id, stream):
            slot = _slot(spark, path, batch_id, stream, base)
        elif base is None:
            slot = _slot(spark, path, batch_id, stream)
        else:
            return  # a replay of a batch that is in the base table
        batch.write.mode("overwrite").parquet(f"{path}/{slot.folder}")
        if compact_every and keys and len(_stored(spark, path)) >= compact_every:
            compact(spark, path, keys)

    return save


def _base(spark: SparkSession, path: str) -> int | None:
    """Place up to which the log was folded into its base table."""
    folded = [
        int(place)
        for place in _values(child_names(spark, f"{path}/_base"), "upto")
        if exists(spark, f"{path}/_base/upto={place}/applied/_SUCCESS")
    ]
    return max(folded, default=None)


def _folded(spark: SparkSession, path: str, base: int, batch_id: int, stream: str) -> bool:
    applied = spark.read.parquet(f"{path}/_base/upto={base}/applied")
    return not applied.filter((F.col("stream") == (stream or "none")) & (F.col("batch_id") >= batch_id)).isEmpty()


def _log(spark: SparkSession, path: str) -> DataFrame:
    base = _base(spark, path)
    parts = [] if base is None else [spark.read.parquet(f"{path}/_base/upto={base}/rows")]
    for one in _stored(spark, path):
        if base is None or one.place > base:
            rows = spark.read.parquet(f"{path}/{one.folder}")
            parts.append(
                rows.withColumn("place", F.lit(one.place).cast("bigint")).withColumn(
                    "batch_id", F.lit(one.batch_id).cast("bigint")
                )
            )
    return reduce(DataFrame.unionByName, parts)


def latest_rows(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """Current row of every key in a change log, with the number of the batch that wrote it."""
    return keep_first(_log(spark, path), keys, [F.desc("place")]).drop("place")


def compact(spark: SparkSession, path: str, keys: Sequence[str]) -> None:
    """Fold all stored batches into the base table, then drop their folders.

    The base is committed by the success marker of its list of applied batches
    before anything is removed; call it from the log's only writer.
    """
    base, stored = _base(spark, path), _stored(spark, path)
    if not stored:
        return
    newest = stored[-1].place
    target = f"{path}/_base/upto={newest}"
    keep_first(_log(spark, path), keys, [F.desc("place")]).write.mode("overwrite").parquet(f"{target}/rows")
    applied = spark.createDataFrame([(s.stream, s.batch_id) for s in stored], "stream string, batch_id bigint")
    if base is not None:
        applied = applied.unionByName(spark.read.parquet(f"{path}/_base/upto={base}/applied"))
    highest = applied.groupBy("stream").agg(F.max("batch_id").alias("batch_id"))
    highest.coalesce(1).write.mode("overwrite").parquet(f"{target}/applied")
    for one in stored:
        delete(spark, f"{path}/place={one.place}")
    for place in _values(child_names(spark, f"{path}/_base"), "upto"):
        if int(place) < newest:
            delete(spark, f"{path}/_base/upto={place}")


def snapshots(path: str) -> BatchWriter:
    """Batch writer for complete mode: the whole result per micro-batch, two versions kept."""

    def save(batch: DataFrame, batch_id: int, stream: str = "") -> None:
        spark = batch.sparkSession
        slot = _slot(spark, path, batch_id, stream)
        batch.write.mode("overwrite").parquet(f"{path}/{slot.folder}")
        for old in _stored(spark, path)[:-2]:
            delete(spark, f"{path}/place={old.place}")

    return save


def latest_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The last complete snapshot with its batch id."""
    newest = _stored(spark, path)[-1]
    return spark.read.parquet(f"{path}/{newest.folder}").withColumn(
        "batch_id", F.lit(newest.batch_id).cast("bigint")
    )


def table_refresh(target: jdbc.JdbcTarget, table: str) -> BatchWriter:
    """Batch writer replacing a database table with each complete result."""

    def save(batch: DataFrame, batch_id: int, stream: str = "") -> None:
        stamped = batch.withColumn("batch_id", F.lit(batch_id).cast("bigint")).withColumn(
            "update_time", F.current_timestamp()
        )
        jdbc.full_refresh(stamped, target, table)

    return save


def table_changes(target: jdbc.JdbcTarget, table: str, keys: Sequence[str]) -> BatchWriter:
    """Batch writer for update mode: windows that changed replace their rows in a database table.

    Windows are replaced whole by their end, so other windows of the table stay; a
    micro-batch holds only categories that changed, the others are read back first.  The
    replacement is one transaction, so a replay after a failure reads back what the first
    attempt did and no category is lost.
    """

    def save(batch: DataFrame, batch_id: int, stream: str = "") -> None:
        spark = batch.sparkSession
        stamped = batch.withColumn("batch_id", F.lit(batch_id).cast("bigint")).withColumn(
            "update_time", F.current_timestamp()
        )
        changed = materialize(stamped, "changed-windows")
        if changed.isEmpty():
            return
        stored = read_table(spark, target.url, table, properties=target.properties())
        same_windows = stored.join(changed.select("window_end").distinct(), "window_end", "left_semi")
        others = same_windows.join(changed.select(*keys), list(keys), "left_anti").select(*changed.columns)
        jdbc.replace_in_transaction(changed.unionByName(others), target, table, "window_end")

    return save


def closed_windows(path: str) -> BatchWriter:
    """Batch writer for append mode: every row comes once, when the watermark has passed its window."""
    return change_log(path)


def closed_rows(spark: SparkSession, path: str) -> DataFrame:
    """All rows that append mode has emitted, with the number of the batch that did."""
    return _log(spark, path).drop("place")


# --- two outputs of one micro-batch ------------------------------------------
def with_rejects(result: DataFrame, rejected: DataFrame) -> DataFrame:
    """One stream of the rows of ``result`` and of rejected messages ``(value, reason)``.

    Both sides read the same source, so a micro-batch of the one query holds the rejects of
    the very messages its result is made of, in every output mode.  ``two_outputs`` stores them apart.
    """
    kind = result.select(F.struct(*result.columns).alias("row")).schema["row"].dataType
    good = result.select(F.struct(*result.columns).alias("row"), *[F.lit(None).cast("string").alias(c) for c in ("value", "reason")])
    return good.union(rejected.select(F.lit(None).cast(kind).alias("row"), "value", "reason"))


def two_outputs(writer: BatchWriter, rejects: str) -> BatchWriter:
    """Batch writer of a ``with_rejects`` stream: rows to ``writer``, rejects to a folder of this stream and batch.

    A replayed batch replaces its rejects, so each is stored once.
    """

    def save(batch: DataFrame, batch_id: int, stream: str = "") -> None:
        both = materialize(batch, "two-outputs")
        bad = both.filter("reason is not null").select("value", "reason")
        bad.write.mode("overwrite").parquet(f"{rejects}/stream={stream or 'none'}/batch_id={batch_id}")
        writer(both.filter("reason is null").select("row.*"), batch_id, stream)

    return save


def rejected_messages(spark: SparkSession, path: str) -> DataFrame:
    """``(value, reason, stream, batch_id)`` of every rejected message."""
    return spark.read.schema("value string, reason string, stream string, batch_id bigint").parquet(path)


# --- running totals ----------------------------------------------------------
def keyed_totals(path: str, compact_every: int | None = 100) -> BatchWriter:
    """Batch writer for totals per community that a stream keeps in its own state (update mode).

    A micro-batch writes the totals of its communities only.  Totals of several streams into
    one path add up, so each row names its stream.
    """
    log = change_log(path, ["stream", "community"], compact_every)

    def save(batch: DataFrame, batch_id: int, stream: str = "") -> None:
        log(batch.withColumn("stream", F.lit(stream or "none")), batch_id, stream)

    return save


def additive_merge(path: str) -> BatchWriter:
    """Batch writer adding each micro-batch of price messages to the community totals once."""

    def save(batch: DataFrame, batch_id: int, stream: str = "") -> None:
        apply_once(
            running_totals(batch), path, ["community"], ["number", "price_sum"], batch_id, stream=stream
        )

    return save


def community_means(spark: SparkSession, path: str) -> DataFrame:
    """Mean per community, from a log of totals or from merge state."""
    state = read_state(spark, path)
    if state is None:
        totals = latest_rows(spark, path, ["stream", "community"])
        state = merge_sums(None, totals, ["community"], ["number", "price_sum"])
    return with_mean(state)
