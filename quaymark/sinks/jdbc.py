"""Database sinks.  Failures propagate; nothing is logged and forgotten."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from quaymark.session import materialize


@dataclass(frozen=True)
class JdbcTarget:
    url: str
    user: str | None = None
    password: str | None = None
    driver: str | None = None
    extra: dict[str, str] = field(default_factory=dict)

    def properties(self) -> dict[str, str]:
        named = {"user": self.user, "password": self.password, "driver": self.driver}
        return {k: v for k, v in named.items() if v is not None} | self.extra


def write_options(target: JdbcTarget, table: str, batch_size: int = 1000, truncate: bool = False) -> dict[str, str]:
    options = {"url": target.url, "dbtable": table, "batchsize": str(batch_size), **target.properties()}
    return options | ({"truncate": "true"} if truncate else {})


# Connections opened by one write unless told otherwise.
WRITERS = 8


def _write(df: DataFrame, target: JdbcTarget, table: str, mode: str, writers: int | None, truncate: bool) -> None:
    # A shuffle rather than a coalesce: the result is still computed in parallel.
    out = df.repartition(writers or WRITERS)
    out.write.format("jdbc").options(**write_options(target, table, truncate=truncate)).mode(mode).save()


def overwrite(df: DataFrame, target: JdbcTarget, table: str, writers: int | None = None) -> None:
    _write(df, target, table, "overwrite", writers, truncate=False)


def full_refresh(
    df: DataFrame, target: JdbcTarget, table: str, writers: int | None = None, dry_run: bool = False
) -> None:
    """Empty the table and fill it again, keeping its definition; a dry run prints 20 rows."""
    if dry_run:
        df.show(20, truncate=False)
        return
    _write(df, target, table, "overwrite", writers, truncate=True)


def append(df: DataFrame, target: JdbcTarget, table: str, writers: int | None = None) -> None:
    _write(df, target, table, "append", writers, truncate=False)


def delete_values(spark: SparkSession, target: JdbcTarget, table: str, column: str, values: Sequence) -> None:
    """Delete the rows with one of the values in ``column``, in one transaction, from the driver."""
    manager = spark._jvm.java.sql.DriverManager
    properties = spark._jvm.java.util.Properties()
    for key, value in target.properties().items():
        properties.setProperty(key, value)
    connection = manager.getConnection(target.url, properties)
    try:
        connection.setAutoCommit(False)
        statement = connection.prepareStatement(f"DELETE FROM {table} WHERE {column} = ?")
        for value in values:
            statement.setObject(1, value)
            statement.executeUpdate()
        connection.commit()
    finally:
        connection.close()


def replace_batches(
    df: DataFrame, target: JdbcTarget, table: str, batch: str = "checkid", writers: int | None = None
) -> None:
    """Make the batches in ``df`` appear exactly once, without touching other batches.

    The new rows are written out before anything is deleted.  If the append is cut
    short, part of them is missing until the same rows are written again: for rows that are
    read back from the table itself use ``replace_in_transaction``.
    """
    rows = materialize(df, "jdbc-batches")
    values = [r[0] for r in rows.select(batch).distinct().collect()]
    delete_values(df.sparkSession, target, table, batch, values)
    append(rows, target, table, writers)


def run_in_transaction(spark: SparkSession, target: JdbcTarget, statements: Sequence[str]) -> None:
    """Run the statements from the driver, all or none of them."""
    manager = spark._jvm.java.sql.DriverManager
    properties = spark._jvm.java.util.Properties()
    for key, value in target.properties().items():
        properties.setProperty(key, value)
    connection = manager.getConnection(target.url, properties)
    try:
        connection.setAutoCommit(False)
        for statement in statements:
            prepared = connection.prepareStatement(statement)
            prepared.executeUpdate()
            prepared.close()
        connection.commit()
    except Exception:
        connection.rollback()
        raise
    finally:
        connection.close()


def replacement(table: str, staging: str, batch: str, columns: Sequence[str]) -> list[str]:
    """Statements that put the batches of the staging table in place of those of the table."""
    names = ", ".join(columns)
    return [
        f"DELETE FROM {table} WHERE {batch} IN (SELECT DISTINCT {batch} FROM {staging})",
        f"INSERT INTO {table} ({names}) SELECT {names} FROM {staging}",
    ]


def replace_in_transaction(
    df: DataFrame, target: JdbcTarget, table: str, batch: str = "checkid", writers: int | None = None
) -> None:
    """Make the batches in ``df`` appear exactly once, without touching other batches.

    The rows are written to a staging table in parallel, and one transaction then deletes
    the batches and inserts them anew: whoever reads the table sees them before or after,
    and a run cut short at any point leaves the table as it was.  Running it again starts
    with a new staging table.  One writer per table.
    """
    staging = f"{table}_staging"
    overwrite(df, target, staging, writers)
    run_in_transaction(df.sparkSession, target, replacement(table, staging, batch, df.columns))
