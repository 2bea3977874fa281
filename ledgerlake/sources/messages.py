"""Payment messages (one JSON object per message) and their decoding.

The wire contract is Kafka's: a ``value`` column holding the JSON bytes or
text.  ``read_stream`` opens Kafka when servers are given and otherwise a folder
of JSON-lines files with the same downstream contract.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import columns as C
from ..schemas import RAW_EVENT, RAW_FIELDS
from . import feeds

CORRUPT = "_corrupt_record"
MESSAGE_SCHEMA = T.StructType(RAW_EVENT.fields + [T.StructField(CORRUPT, T.StringType())])
ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
# Event types that are account events, not payments: their messages carry no
# amount (the producer contract's "missing amount" case).
NON_PAYMENT_EVENTS = ("signup",)


def event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed E as wire messages: JSON text in ``value``; NULL fields are left
    out of the object, so non-payment events arrive without ``amount``."""
    return event_messages_with_time(spark, sf_dir).select("value")


def event_messages_with_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``event_messages`` plus the event time (for ordered replays)."""
    ev = feeds.event_payments(spark, sf_dir)
    payload = F.struct(
        "transaction_id",
        F.date_format("ts_event", ISO_MICROS).alias("ts_event"),
        "card_hash",
        "merchant_id",
        F.when(~F.col("mcc").isin(*NON_PAYMENT_EVENTS), F.col("amount").cast("string")).alias("amount"),
        "currency",
        "mcc",
        "channel",
        "auth_result",
        "location",
    )
    return ev.select(F.to_json(payload).alias("value"), "ts_event")


# Faults of ``faulty_messages``, by event id % 40: what every producer sends now and then.
FAULTS = {0: "malformed", 1: "no id", 2: "empty id", 3: "no card", 4: "bad time", 5: "no result", 6: "bad amount"}


def faulty_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed E as wire messages with malformed text and missing or unusable fields.

    ``ts_event``: the time to replay by, NULL where the message has none.
    """
    ev = feeds.event_payments(spark, sf_dir)
    fault = F.substring("transaction_id", 2, 30).cast("long") % 40
    is_ = lambda name: fault == next(k for k, v in FAULTS.items() if v == name)
    payload = F.to_json(
        F.struct(
            F.when(is_("empty id"), F.lit("")).when(~is_("no id"), F.col("transaction_id")).alias("transaction_id"),
            F.when(is_("bad time"), F.lit("soon")).otherwise(F.date_format("ts_event", ISO_MICROS)).alias("ts_event"),
            F.when(~is_("no card"), F.col("card_hash")).alias("card_hash"),
            "merchant_id",
            F.when(is_("bad amount"), F.lit("much")).otherwise(F.col("amount").cast("string")).alias("amount"),
            "currency",
            "mcc",
            "channel",
            F.when(~is_("no result"), F.col("auth_result")).alias("auth_result"),
            "location",
        )
    )
    cut = F.when(is_("malformed"), F.concat(F.lit('{"transaction_id": '), "transaction_id")).otherwise(payload)
    return ev.select(cut.alias("value"), F.when(~is_("bad time"), F.col("ts_event")).alias("ts_event"))


def decode(messages: DataFrame, value: str = "value") -> DataFrame:
    """bytes/text -> raw string fields; unparsable text is kept whole in
    ``_corrupt_record`` (PERMISSIVE mode) instead of failing the batch."""
    text = F.col(value).cast("string")
    parsed = F.from_json(text, MESSAGE_SCHEMA, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    out = messages.select(parsed.alias("_lk_m"), text.alias("_lk_text"))
    malformed = F.col("_lk_m").isNull() | F.col(f"_lk_m.{CORRUPT}").isNotNull()
    return out.select(
        *[F.col(f"_lk_m.{f}").alias(f) for f in RAW_FIELDS],
        malformed.alias("malformed"),
        F.col("_lk_text").alias("raw_value"),
    )


def typed(decoded: DataFrame) -> DataFrame:
    """P2/P3/P5 + F1: typed payment columns, validity and the original text."""
    return decoded.select(
        "transaction_id",
        C.parse_event_time("ts_event").alias("ts_event"),
        F.col("ts_event").alias("ts_text"),
        "card_hash",
        "merchant_id",
        C.to_amount("amount").alias("amount"),
        "currency",
        "mcc",
        "channel",
        "auth_result",
        "location",
        "malformed",
        # the whole original text: a dead letter must hold all that was sent
        "raw_value",
        # an amount that cannot be read is no amount
        (~F.col("malformed") & C.is_valid_event("transaction_id", C.to_amount("amount"))).alias("valid"),
    )


def read_stream(
    spark: SparkSession,
    path: str | None = None,
    servers: str | None = None,
    topic: str = "payments.raw",
    starting_offsets: str = "earliest",
    max_files_per_trigger: int | None = None,
    max_offsets_per_trigger: int | None = None,
) -> DataFrame:
    """Streaming DataFrame with a ``value`` column.

    ``max_*_per_trigger`` bounds each micro-batch (back-pressure for replays
    and backfills from ``earliest``)."""
    if servers:  # fails by itself where the connector is missing
        reader = (
            spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic)
            .option("startingOffsets", starting_offsets)
        )
        if max_offsets_per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
        return reader.load()
    if path is None:
        raise ValueError("give Kafka servers or a folder of JSON-lines files")
    reader = spark.readStream.schema("value string")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.text(path)
