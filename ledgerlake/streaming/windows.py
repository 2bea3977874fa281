"""Event-time streaming operators with watermarks.

* ``dedup_stream``       -- drop repeated transaction ids arriving within the
                            watermark delay (state is bounded by the delay).
* ``velocity_windows``   -- events per card in tumbling/sliding event-time
                            windows (the documented one-minute velocity).
* ``settlement_windows`` -- daily settlement as one-day event-time windows.

All run in append mode: a window is emitted once the watermark passes its
end, and its state is dropped then.  Watermarks need ``TIMESTAMP`` columns;
``to_instant`` turns wall-clock ``TIMESTAMP_NTZ`` (read as UTC) into one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..schemas import FEE_AMOUNT, SUM_AMOUNT

DEFAULT_DELAY = "10 minutes"  # the longest rule window


def to_instant(c: str | Column) -> Column:
    """TIMESTAMP_NTZ wall clock, taken as UTC, to a TIMESTAMP instant --
    computed from calendar fields so the session time zone plays no part."""
    ts = F.col(c) if isinstance(c, str) else c
    micros = (
        F.unix_date(F.to_date(ts)).cast("long") * 86_400_000_000
        + F.hour(ts).cast("long") * 3_600_000_000
        + F.minute(ts).cast("long") * 60_000_000
        + F.second(ts).cast("long") * 1_000_000
        + F.date_format(ts, "SSSSSS").cast("long")
    )
    return F.timestamp_micros(micros)


def dedup_stream(df: DataFrame, key: str = "transaction_id", ts: str = "ts_event", delay: str = DEFAULT_DELAY) -> DataFrame:
    """First arrival of each key within the watermark delay."""
    return df.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


def velocity_windows(
    df: DataFrame,
    window: str = "1 minute",
    slide: str | None = None,
    key: str = "card_hash",
    ts: str = "ts_event",
    delay: str = DEFAULT_DELAY,
) -> DataFrame:
    """Event count per card and event-time window."""
    w = F.window(ts, window, slide) if slide else F.window(ts, window)
    agg = df.withWatermark(ts, delay).groupBy(w.alias("w"), key).agg(F.count(F.lit(1)).alias("n"))
    return agg.select(key, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "n")


def settlement_windows(df: DataFrame, ts: str = "ts_event", delay: str = DEFAULT_DELAY, fee_rate: str = "0.02") -> DataFrame:
    """A1 as one-day event-time windows (days aligned to UTC midnight)."""
    rate = C.decimal_literal(fee_rate)
    agg = (
        df.withWatermark(ts, delay)
        .groupBy(F.window(ts, "1 day").alias("w"), "merchant_id", "currency")
        .agg(F.count(F.lit(1)).alias("txn_count"), F.sum("amount").alias("_gross"))
    )
    return agg.select(
        "merchant_id",
        "currency",
        F.col("w.start").alias("window_start"),
        "txn_count",
        F.col("_gross").cast(SUM_AMOUNT).alias("gross_amount"),
        (F.col("_gross") * rate).cast(FEE_AMOUNT).alias("fees"),
        (F.col("_gross") - F.col("_gross") * rate).cast(FEE_AMOUNT).alias("net_amount"),
    )
