"""Explicit schemas for every table of the payments data model."""

from pyspark.sql import types as T

AMOUNT = T.DecimalType(18, 2)
# Aggregated measures are cast to fixed wide decimals so that results do not
# depend on the engine's precision-widening rules.
SUM_AMOUNT = T.DecimalType(38, 2)
FEE_AMOUNT = T.DecimalType(38, 4)

# Raw event as it arrives on the wire: every field is text, typed later with
# try_cast so bad values become NULL instead of failing the batch.
RAW_FIELDS = [
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
RAW_EVENT = T.StructType([T.StructField(f, T.StringType()) for f in RAW_FIELDS])

# Required keys of a well-formed generated event (producer contract).
REQUIRED_EVENT_FIELDS = [
    "transaction_id",
    "ts_event",
    "card_hash",
    "merchant_id",
    "amount",
    "currency",
    "auth_result",
]

PAYMENT = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("ts_event", T.TimestampType()),
        T.StructField("card_hash", T.StringType()),
        T.StructField("merchant_id", T.StringType()),
        T.StructField("amount", AMOUNT),
        T.StructField("currency", T.StringType()),
        T.StructField("mcc", T.StringType()),
        T.StructField("channel", T.StringType()),
        T.StructField("auth_result", T.StringType()),
        T.StructField("location", T.StringType()),
    ]
)

BLACKLIST = T.StructType(
    [
        T.StructField("merchant_id", T.StringType()),
        T.StructField("reason", T.StringType()),
    ]
)

STATE_EVENT = T.StructType(
    [
        T.StructField("ts", T.TimestampType()),
        T.StructField("auth_result", T.StringType()),
        T.StructField("country", T.StringType()),
    ]
)

CARD_STATE = T.StructType(
    [
        T.StructField("card_hash", T.StringType()),
        T.StructField("last_events", T.ArrayType(STATE_EVENT)),
        T.StructField("updated_at", T.TimestampType()),
    ]
)

# Gold star schema: column order of each table (keys first).
GOLD_COLUMNS = {
    "dim_date": ["date_id"],
    "dim_card": ["card_hash"],
    "dim_merchant": ["merchant_id", "mcc"],
    "fact_transactions": [
        "transaction_id",
        "ts_event",
        "date_id",
        "card_hash",
        "merchant_id",
        "amount",
        "currency",
        "auth_result",
    ],
    "fact_settlement_daily": [
        "merchant_id",
        "currency",
        "dt",
        "txn_count",
        "gross_amount",
        "fees",
        "net_amount",
    ],
    "fact_fraud_signals": [
        "transaction_id",
        "ts_event",
        "card_hash",
        "merchant_id",
        "amount",
        "currency",
        "auth_result",
        "location",
        "reason",
        "created_at",
    ],
}

GOLD_KEYS = {
    "dim_date": ["date_id"],
    "dim_card": ["card_hash"],
    "dim_merchant": ["merchant_id"],
    "fact_transactions": ["transaction_id"],
    "fact_settlement_daily": ["merchant_id", "currency", "dt"],
    "fact_fraud_signals": ["transaction_id"],
    "review_signals": ["transaction_id"],
}

GOLD_DDL = {
    "dim_date": "date_id DATE",
    "dim_card": "card_hash STRING",
    "dim_merchant": "merchant_id STRING, mcc STRING",
    "fact_transactions": (
        "transaction_id STRING, ts_event TIMESTAMP, date_id DATE, card_hash STRING, "
        "merchant_id STRING, amount DECIMAL(18,2), currency STRING, auth_result STRING"
    ),
    "fact_settlement_daily": (
        "merchant_id STRING, currency STRING, dt DATE, txn_count BIGINT, "
        "gross_amount DECIMAL(38,2), fees DECIMAL(38,4), net_amount DECIMAL(38,4)"
    ),
    "fact_fraud_signals": (
        "transaction_id STRING, ts_event TIMESTAMP, card_hash STRING, merchant_id STRING, "
        "amount DECIMAL(18,2), currency STRING, auth_result STRING, location STRING, "
        "reason STRING, created_at TIMESTAMP"
    ),
}

# F8's rows marked for review: the same columns, never mixed with real signals.
GOLD_COLUMNS["review_signals"] = GOLD_COLUMNS["fact_fraud_signals"]
GOLD_DDL["review_signals"] = GOLD_DDL["fact_fraud_signals"]
