"""J3 as a stream-stream join: events with a counterpart in another country nearby in time.

A left semi join of the stream with itself: same card, other country, at most
``window_s`` seconds apart in either direction.  It emits events, each once, as
soon as its first counterpart is there (itself or the counterpart may be the late
one), and never the pairs.  Both sides carry a watermark and the condition bounds
the time between them, so a row leaves the join state when the watermark passes its
time by the window: state is that of the last minutes, whatever the stream's age.

A card that sends very many events within the window has its left rows dealt
over ``salts`` keys, each with its own copy of the right rows, so its probes
run in that many tasks.

Defined cases: events without card, time or country have no counterpart and are never
emitted; a repeated event is emitted once per copy; an event that comes later than the
watermark allows is dropped and counted in the query's progress.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from .windows import DEFAULT_DELAY


def cross_border_events(
    df: DataFrame,
    window_s: int = 600,
    delay: str = DEFAULT_DELAY,
    salts: int = 1,
    key: str = "card_hash",
    ts: str = "ts_event",
    tie: str = "transaction_id",
) -> DataFrame:
    """Rows of the stream ``df`` that have a counterpart; all its columns unchanged."""
    columns = df.columns
    country = F.nullif(C.country_from_location("location"), F.lit(""))
    seen = df.withWatermark(ts, delay).withColumn("_lk_country", country)
    seen = seen.filter(F.col(key).isNotNull() & F.col(ts).isNotNull() & F.col("_lk_country").isNotNull())
    left = seen.withColumn("_lk_salt", F.pmod(F.xxhash64(tie), F.lit(salts)).cast("int"))
    right = seen.select(
        F.col(key).alias("_lk_key"),
        F.col(ts).alias("_lk_ts"),
        F.col("_lk_country").alias("_lk_other"),
        F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_lk_part"),
    )
    near = F.expr(f"INTERVAL {window_s} SECONDS")
    meets = (
        (F.col(key) == F.col("_lk_key"))
        & (F.col("_lk_salt") == F.col("_lk_part"))
        & (F.col("_lk_country") != F.col("_lk_other"))
        & (F.col("_lk_ts") >= F.col(ts) - near)
        & (F.col("_lk_ts") <= F.col(ts) + near)
    )
    return left.join(right, meets, "left_semi").select(*columns)
