"""CSV seed tables (header row, empty field = NULL, quoted text)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schemas import BLACKLIST, RAW_EVENT
from ..plans.marts import stg_payments


def read_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").csv(path)


def payments_seed(spark: SparkSession, path: str) -> DataFrame:
    """Seed payments as raw text columns, then the typed staging projection."""
    return stg_payments(read_csv(spark, path, RAW_EVENT))


def blacklist_seed(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, BLACKLIST)
