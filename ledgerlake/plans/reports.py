"""CSV reports.

Report DataFrames are plain queries; ``write_report`` writes them with
Spark's CSV writer (one folder per report, many part files at scale).  The
sort is a global range-partitioned sort, so it is distributed too.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import GOLD_COLUMNS, SUM_AMOUNT


def settlement_report(settlement: DataFrame) -> DataFrame:
    """Settlement rows, newest day first (``dt`` shown as ``date``)."""
    return settlement.select(
        "merchant_id", "currency", F.col("dt").alias("date"), "txn_count", "gross_amount", "fees", "net_amount"
    ).orderBy(F.col("date").desc(), "merchant_id", "currency")


def fraud_report(signals: DataFrame, with_clock: bool = False) -> DataFrame:
    """R2/O2: fraud signals, newest first (``created_at`` only when asked)."""
    cols = [c for c in GOLD_COLUMNS["fact_fraud_signals"] if c != "created_at"]
    out = signals.select(*cols, *(["created_at"] if with_clock else []))
    order = ([F.col("created_at").desc()] if with_clock else []) + [F.col("ts_event").desc(), "transaction_id"]
    return out.orderBy(*order)


def totals_report(transactions: DataFrame) -> DataFrame:
    """Count and total per merchant and currency over all days."""
    return transactions.groupBy("merchant_id", "currency").agg(
        F.count(F.lit(1)).alias("txn_count"), F.sum("amount").cast(SUM_AMOUNT).alias("total_amount")
    )


def write_report(df: DataFrame, path: str, run_date: dt.date | str | None = None) -> str:
    """K7 (fixed folder) / K8 (``run_date=YYYY-MM-DD`` sub-folder)."""
    target = path.rstrip("/")
    if run_date is not None:
        target = f"{target}/run_date={run_date if isinstance(run_date, str) else run_date.isoformat()}"
    df.write.option("header", True).mode("overwrite").csv(target)
    return target


def write_table_report(spark: SparkSession, table_path: str, out_path: str, run_date=None) -> str | None:
    """Full table dump; an absent table is skipped (returns None)."""
    from ..sources.tables import table_exists

    if not table_exists(spark, table_path):
        return None
    return write_report(spark.read.parquet(table_path), out_path, run_date)
