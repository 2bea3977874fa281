"""Adapter: payment feeds derived from the driver's Parquet tables.

Feed ``P`` (payments from ``lineitem``): one payment per line item.  Every
payment column is a function of one ``lineitem`` row plus foreign-key lookups
(orders -> card, part -> mcc, supplier/nation -> location).  The lookups are
kept apart (``enrich_payments``) so that a query which needs no card, mcc or
location never joins, and so that deduplication can run *before* the joins on
the narrow lineitem rows.

Feed ``E`` (payments from ``events``): one payment per event; used for the
per-card fraud rules because it carries many events per user and real times.

Feed ``B`` (blacklist from ``supplier``): suppliers with a low account balance.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import AMOUNT
from .tables import read_table

# Fixed mappings of the adapter (kept identical in the oracle SQL).
CURRENCIES = ["USD", "EUR", "GBP", "JPY"]  # by l_orderkey % 4
CHANNELS = ["POS", "WEB", "MOBILE"]  # by l_linenumber % 3
EVENT_COUNTRIES = ["US", "DE", "FR"]  # by event_id % 3
EVENT_CURRENCIES = ["USD", "EUR"]  # by user_id % 2
BLACKLIST_MAX_BALANCE = 1000
BLACKLIST_REASON = "LOW_BALANCE"

PAYMENT_COLUMNS = [
    "transaction_id",
    "ts_event",
    "card_hash",
    "merchant_id",
    "amount",
    "currency",
    "mcc",
    "channel",
    "auth_result",
    "location",
]
# Hidden lineitem columns carried until enrichment; ``seq`` is the tie-break
# that makes (ts_event, amount, seq) a total order inside one transaction id.
LINE_KEYS = ["_orderkey", "_partkey", "_suppkey"]


def _pick(values: list[str], index) -> F.Column:
    expr = None
    for i, v in enumerate(values):
        expr = F.when(index == i, F.lit(v)) if expr is None else expr.when(index == i, F.lit(v))
    return expr


def line_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed P without lookups: payment columns computable from lineitem alone."""
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(
        F.concat(F.lit("TXN"), F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")).alias(
            "transaction_id"
        ),
        F.col("l_shipdate").alias("ts_event"),
        F.concat(F.lit("M"), F.col("l_suppkey").cast("string")).alias("merchant_id"),
        F.col("l_extendedprice").cast(AMOUNT).alias("amount"),
        _pick(CURRENCIES, F.col("l_orderkey") % 4).alias("currency"),
        _pick(CHANNELS, F.col("l_linenumber") % 3).alias("channel"),
        F.when(F.col("l_returnflag") == "R", F.lit("DECLINED")).otherwise(F.lit("APPROVED")).alias("auth_result"),
        F.col("l_partkey").alias("seq"),
        F.col("l_orderkey").alias("_orderkey"),
        F.col("l_partkey").alias("_partkey"),
        F.col("l_suppkey").alias("_suppkey"),
    )


def enrich_payments(
    spark: SparkSession,
    sf_dir: str,
    df: DataFrame,
    card: bool = True,
    mcc: bool = True,
    location: bool = True,
) -> DataFrame:
    """Foreign-key lookups of feed P.  Left joins keep every payment.

    No broadcast hints: orders, part and supplier grow with the data, so the
    join strategy is left to Catalyst/AQE, which broadcasts only when the
    measured side is under ``spark.sql.adaptive.autoBroadcastJoinThreshold``.
    ``nation`` has 25 rows by definition and is broadcast.
    """
    out = df
    if card:
        orders = read_table(spark, sf_dir, "orders").select(
            F.col("o_orderkey").alias("_orderkey"),
            F.concat(F.lit("card"), F.col("o_custkey").cast("string")).alias("card_hash"),
        )
        out = out.join(orders, "_orderkey", "left")
    else:
        out = out.withColumn("card_hash", F.lit(None).cast("string"))
    if mcc:
        part = read_table(spark, sf_dir, "part").select(F.col("p_partkey").alias("_partkey"), F.col("p_type").alias("mcc"))
        out = out.join(part, "_partkey", "left")
    else:
        out = out.withColumn("mcc", F.lit(None).cast("string"))
    if location:
        nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
        supp = (
            read_table(spark, sf_dir, "supplier")
            .select("s_suppkey", "s_nationkey")
            .join(F.broadcast(nation), F.col("s_nationkey") == F.col("n_nationkey"), "left")
            .select(
                F.col("s_suppkey").alias("_suppkey"),
                F.concat(F.lit("City "), F.col("s_suppkey").cast("string"), F.lit(", "), F.col("n_name")).alias("location"),
            )
        )
        out = out.join(supp, "_suppkey", "left")
    else:
        out = out.withColumn("location", F.lit(None).cast("string"))
    return out


def lineitem_payments(
    spark: SparkSession, sf_dir: str, card: bool = True, mcc: bool = True, location: bool = True, keep_seq: bool = False
) -> DataFrame:
    """Feed P: all payment columns (plus ``seq`` when asked)."""
    df = enrich_payments(spark, sf_dir, line_payments(spark, sf_dir), card, mcc, location)
    cols = PAYMENT_COLUMNS + (["seq"] if keep_seq else [])
    return df.select(*cols)


def event_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed E: payments from the events table (many events per card, real times)."""
    ev = read_table(spark, sf_dir, "events")
    country = _pick(EVENT_COUNTRIES, F.col("event_id") % 3)
    return ev.select(
        F.concat(F.lit("E"), F.col("event_id").cast("string")).alias("transaction_id"),
        F.col("ts").alias("ts_event"),
        F.concat(F.lit("card"), F.col("user_id").cast("string")).alias("card_hash"),
        F.concat(F.lit("M"), F.get_json_object("props", "$.k")).alias("merchant_id"),
        F.col("value").cast(AMOUNT).alias("amount"),
        _pick(EVENT_CURRENCIES, F.col("user_id") % 2).alias("currency"),
        F.col("event_type").alias("mcc"),
        F.lit("WEB").alias("channel"),
        F.when(F.col("event_type") == "error", F.lit("DECLINED")).otherwise(F.lit("APPROVED")).alias("auth_result"),
        F.concat(F.lit("City "), F.col("user_id").cast("string"), F.lit(", "), country).alias("location"),
    )


def supplier_blacklist(spark: SparkSession, sf_dir: str, max_balance: float = BLACKLIST_MAX_BALANCE) -> DataFrame:
    """Feed B: merchants (suppliers) whose balance is below ``max_balance``."""
    return (
        read_table(spark, sf_dir, "supplier")
        .filter(F.col("s_acctbal") < max_balance)
        .select(
            F.concat(F.lit("M"), F.col("s_suppkey").cast("string")).alias("merchant_id"),
            F.lit(BLACKLIST_REASON).alias("reason"),
        )
    )
