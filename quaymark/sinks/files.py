"""File sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame

from quaymark.sources.events import to_messages


def save_csv(df: DataFrame, path: str, files: int | None = 1) -> None:
    """Headed CSV, replacing what was there.

    One file is meant for report-sized results; ``files=None`` keeps the
    frame's own partitions for anything larger.  ``repartition`` rather than
    ``coalesce`` so that computing the result stays parallel.
    """
    out = df if files is None else df.repartition(files)
    out.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def replace_batches(df: DataFrame, path: str, batch: str = "checkid") -> None:
    """Write by batch, replacing only the batches present in ``df``: reruns do not duplicate."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(batch)
        .parquet(path)
    )


def save_messages(df: DataFrame, path: str) -> None:
    """One JSON message per line, the file form of publishing to a topic."""
    to_messages(df).write.mode("append").text(path)


def topic_options(servers: str, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic, "kafka.acks": "all", "kafka.retries": "3"}


def publish(df: DataFrame, key: str | None, servers: str, topic: str) -> None:
    """JSON messages, keyed if a key column is named, to a Kafka topic (needs Spark's Kafka connector)."""
    to_messages(df, key).write.format("kafka").options(**topic_options(servers, topic)).save()
