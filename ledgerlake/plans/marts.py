"""Marts: staging, dimensions, fact flags, buckets, settlement, totals.

Each function maps DataFrame(s) to a DataFrame; nothing is materialised here.
Aggregations are hash aggregates with a map-side partial step, so hot merchants
or days are pre-combined before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators.dedup import distinct_rows, keep_latest
from ..operators.joins import lookup_join
from ..schemas import FEE_AMOUNT, SUM_AMOUNT

DEFAULT_FEE_RATE = "0.02"


def stg_payments(raw: DataFrame) -> DataFrame:
    """Typed staging projection of raw payment rows."""
    ts = F.col("ts_event")
    ts_typed = C.parse_event_time(ts) if dict(raw.dtypes)["ts_event"] == "string" else ts
    amount = F.col("amount")
    amount_typed = C.to_amount(amount) if dict(raw.dtypes)["amount"] != "decimal(18,2)" else amount
    return raw.select(
        "transaction_id",
        ts_typed.alias("ts_event"),
        "card_hash",
        "merchant_id",
        amount_typed.alias("amount"),
        "currency",
        "mcc",
        "channel",
        "auth_result",
        "location",
        C.event_date(ts_typed).alias("event_date"),
    )


def clean_blacklist(blacklist: DataFrame) -> DataFrame:
    """One row per listed merchant so the left join cannot multiply rows."""
    return blacklist.select("merchant_id").filter(F.col("merchant_id").isNotNull()).distinct()


def fact_transactions(tx: DataFrame, blacklist: DataFrame, threshold: str = C.HIGH_AMOUNT_THRESHOLD) -> DataFrame:
    """Transactions with the high-amount and blacklist flags."""
    bl = clean_blacklist(blacklist).withColumn("_listed", F.lit(True))
    joined = lookup_join(tx, bl, "merchant_id", "left")
    return joined.select(
        "transaction_id",
        "ts_event",
        "card_hash",
        "merchant_id",
        "amount",
        "currency",
        "auth_result",
        C.high_amount("amount", threshold).alias("flag_high_amount"),
        F.coalesce(F.col("_listed"), F.lit(False)).alias("flag_blacklisted"),
    )


def fact_fraud_signals(facts: DataFrame) -> DataFrame:
    """mart fraud signals = high amount OR blacklisted."""
    return facts.filter(F.col("flag_high_amount") | F.col("flag_blacklisted"))


def amount_buckets(facts: DataFrame) -> DataFrame:
    """Amount bucket per transaction."""
    return facts.select("transaction_id", "amount", C.amount_bucket("amount").alias("amount_bucket"))


def dim_card(tx: DataFrame) -> DataFrame:
    """Distinct non-NULL cards with their md5 fingerprint."""
    return distinct_rows(tx, ["card_hash"], not_null=["card_hash"]).withColumn(
        "card_fingerprint", C.card_fingerprint("card_hash")
    )


def dim_date(tx: DataFrame) -> DataFrame:
    """A5: distinct event days."""
    return tx.select(C.event_date("ts_event").alias("date_id")).filter(F.col("date_id").isNotNull()).distinct()


def dim_merchant_pairs(tx: DataFrame) -> DataFrame:
    """A5: distinct (merchant, mcc) pairs, NULL merchants dropped."""
    return distinct_rows(tx, ["merchant_id", "mcc"], not_null=["merchant_id"])


def dim_merchant(tx: DataFrame, order=("ts_event", "transaction_id")) -> DataFrame:
    """U2 source side: one row per merchant, mcc of its latest event."""
    latest = keep_latest(
        tx.filter(F.col("merchant_id").isNotNull()).select("merchant_id", *order, "mcc"), ["merchant_id"], list(order)
    )
    return latest.select("merchant_id", "mcc")


def settlement_daily(tx: DataFrame, fee_rate: str = DEFAULT_FEE_RATE) -> DataFrame:
    """Count, gross, fee and net per merchant, currency and day.

    The fee stays decimal (``fee_rate`` is decimal text, never a float).  The
    NULL-merchant group is kept, as the mart SELECT keeps it.
    """
    rate = C.decimal_literal(fee_rate)
    agg = tx.groupBy("merchant_id", "currency", C.event_date("ts_event").alias("dt")).agg(
        F.count(F.lit(1)).alias("txn_count"), F.sum("amount").alias("_gross")
    )
    return agg.select(
        "merchant_id",
        "currency",
        "dt",
        "txn_count",
        F.col("_gross").cast(SUM_AMOUNT).alias("gross_amount"),
        (F.col("_gross") * rate).cast(FEE_AMOUNT).alias("fees"),
        (F.col("_gross") - F.col("_gross") * rate).cast(FEE_AMOUNT).alias("net_amount"),
    )


def merchant_totals(tx: DataFrame) -> DataFrame:
    """A2: count and total amount per merchant and currency over all days."""
    return tx.groupBy("merchant_id", "currency").agg(
        F.count(F.lit(1)).alias("txn_count"), F.sum("amount").cast(SUM_AMOUNT).alias("total_amount")
    )


def register_views(tables: dict[str, DataFrame]) -> list[str]:
    """Expose DataFrames (Gold tables, marts) as temp views for SQL users."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return sorted(tables)
