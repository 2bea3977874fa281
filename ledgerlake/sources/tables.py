"""Parquet table scans.

Scans are lazy; Catalyst prunes columns and pushes filters into the Parquet
reader, so callers should select only what they need.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def read_table(spark: SparkSession, base_dir: str, name: str) -> DataFrame:
    """Read ``<base_dir>/<name>.parquet`` (a file or a folder of files)."""
    return spark.read.parquet(f"{base_dir.rstrip('/')}/{name}.parquet")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists, asked of its own file system."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p))


def table_exists(spark: SparkSession, path_or_name: str) -> bool:
    """Q5: a catalog table or a folder is present.

    Only absence is answered with False; a folder that is there but cannot be
    read raises when it is read.
    """
    if "/" not in path_or_name:
        return spark.catalog.tableExists(path_or_name)
    return path_exists(spark, path_or_name)
