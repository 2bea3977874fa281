"""U1/K3 against a bucketed catalog table.

The stored side is an external table bucketed by its key, so the existence test reads it
bucket by bucket where it lies: only the incoming rows are shuffled, into the table's
buckets, and what is absent is appended to them without another shuffle.  The cost
of a load in the shuffle is that of its own rows, however large the table is.

Defined cases: of incoming rows with one key the earliest by ``order`` enters; rows with a
NULL key cannot enter a keyed table; a load that is repeated adds nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from .upsert import collapse_source

BUCKETS = 64


def create_bucketed(spark: SparkSession, name: str, path: str, ddl: str, key: str, buckets: int = BUCKETS) -> str:
    """The external table ``name`` over ``path`` (found again by a later session's call).

    The number of buckets is that of the table's life: choose it for the final size, so that
    a bucket's keys fit in a task.
    """
    location = path.replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING parquet "
        f"CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS LOCATION '{location}'"
    )
    return name


def absent_rows(spark: SparkSession, name: str, rows: DataFrame, key: str, order: Sequence[str] = ()) -> DataFrame:
    """The rows whose key the table does not hold, one per key, in the table's columns."""
    stored = spark.table(name)
    one = collapse_source(rows.select(*stored.columns), [key], list(order), latest=False)
    # a merge join: the incoming side comes to the stored buckets, never the other way round
    return one.join(stored.select(key).hint("merge"), key, "left_anti").select(*stored.columns)


def insert_absent(spark: SparkSession, name: str, rows: DataFrame, key: str, order: Sequence[str] = ()) -> None:
    """Append the absent rows to the table's buckets; rows that are there never change."""
    absent_rows(spark, name, rows, key, order).write.mode("append").insertInto(name)
    spark.catalog.refreshTable(name)
