"""Session factory and the shared scratch area used to cut lineage.

Everything that has to outlive a task (materialised intermediates, streaming
checkpoints, merge state) goes under the folder the cluster names in
``spark.checkpoint.dir``.  A machine-local folder is only ever chosen for a
local master, where driver and executors share one disk.
"""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_LOCAL_FALLBACK: dict[str, str] = {}


def build_session(
    app_name: str,
    master: str | None = None,
    shuffle_partitions: int | None = None,
    time_zone: str = "UTC",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session for batch and streaming jobs.

    AQE picks the number of reducers and splits skewed joins, so
    ``shuffle_partitions`` is only the upper bound it starts from.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.serializer", "org.apache.spark.serializer.KryoSerializer")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64MB")
        .config("spark.sql.files.maxPartitionBytes", "128MB")
        .config("spark.sql.session.timeZone", time_zone)
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions is None and master and master.startswith("local"):
        shuffle_partitions = 8
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def size_shuffles(spark: SparkSession, *paths: str, target_bytes: int = 128 << 20) -> int:
    """Raise the shuffle partition count so that the inputs, shuffled whole, give partitions of about the target size.

    AQE merges partitions that turn out small but never splits an aggregation's
    partitions, so the starting count has to suit the largest shuffle.
    """
    from quaymark.sinks.storage import size

    total = sum(size(spark, path) for path in paths)
    current = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = max(current, math.ceil(total / target_bytes))
    spark.conf.set("spark.sql.shuffle.partitions", str(wanted))
    return wanted


@contextmanager
def small_tasks(spark: SparkSession, inputs: DataFrame, task_bytes: int = 8 << 20) -> Iterator[None]:
    """Within the block, what is run over ``inputs`` is dealt in tasks of about ``task_bytes`` of their files.

    A task that aggregates or sorts keeps its share of the rows in memory.  With these settings the
    number of tasks grows with the input and the share of one task does not; they are put back afterwards.
    """
    from quaymark.sinks.storage import size

    total = sum(size(spark, path) for path in inputs.inputFiles())
    shuffles = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(total / task_bytes))
    wanted = {
        "spark.sql.shuffle.partitions": str(shuffles),
        "spark.sql.files.maxPartitionBytes": str(task_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(task_bytes),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Within the block, a job's shuffle files go when it ends, not when the driver happens to collect its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = context.applicationId
    if app not in _LOCAL_FALLBACK:
        _LOCAL_FALLBACK[app] = tempfile.mkdtemp(prefix="quaymark-")
    return _LOCAL_FALLBACK[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder, grouped by application."""
    app = spark.sparkContext.applicationId
    return f"{shared_dir(spark)}/quaymark/{app}/{label}-{uuid.uuid4().hex[:12]}"


def drop_scratch(spark: SparkSession) -> None:
    """Remove what this application wrote with ``scratch_path``; call at job end."""
    from quaymark.sinks.storage import delete

    delete(spark, f"{shared_dir(spark)}/quaymark/{spark.sparkContext.applicationId}")


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and continue from the written table.

    The result has real file statistics, so later joins choose their strategy
    from measured size, and a lost executor re-reads files instead of
    recomputing (possibly non-deterministic) upstream stages.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
