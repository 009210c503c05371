"""Kafka topics as streaming frames (needs Spark's Kafka connector on the classpath)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def source_options(
    servers: str | list[str],
    topic: str,
    starting: str = "latest",
    max_offsets: int | None = None,
    fail_on_data_loss: bool = True,
) -> dict[str, str]:
    brokers = servers if isinstance(servers, str) else ",".join(servers)
    options = {
        "kafka.bootstrap.servers": brokers,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def read_topic(spark: SparkSession, **kwargs) -> DataFrame:
    """Message text in column ``value``."""
    rows = spark.readStream.format("kafka").options(**source_options(**kwargs)).load()
    return rows.selectExpr("cast(value as string) as value")


def read_message_files(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """The same shape from a directory of text files, one message per line."""
    reader = spark.readStream.format("text")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)
