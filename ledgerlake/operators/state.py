"""Per-card history state (last N events).

The state is a keyed table ``card_hash -> last_events array<struct<ts,
auth_result, country>>`` (oldest first).  A new state version is the last N
of (stored events, then the batch's events in time order) per card.

"Last N per card" is ``row_number() <= N``, which Spark plans with a partial
``WindowGroupLimit`` before the shuffle: every map task keeps at most N rows
of a card, so a hot card cannot pile up in one task.  Arrays are only built
from those <= N rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as C

HISTORY = 10
_SRC = "_lk_src"
_POS = "_lk_pos"
_TIE = "_lk_tie"


def _event_struct(ts: str = "ts", auth: str = "auth_result", country: str = "country"):
    return F.struct(F.col(ts).alias("ts"), F.col(auth).alias("auth_result"), F.col(country).alias("country"))


def batch_events(batch: DataFrame, key: str = "card_hash", ts: str = "ts_event", tie: str = "transaction_id") -> DataFrame:
    """Event rows of a batch in state form (cards without id are skipped)."""
    return batch.filter(F.col(key).isNotNull()).select(
        F.col(key).alias("card_hash"),
        F.col(ts).alias("ts"),
        "auth_result",
        C.country_from_location("location").alias("country"),
        F.lit(1).alias(_SRC),
        F.lit(None).cast("int").alias(_POS),
        F.col(tie).cast("string").alias(_TIE),
    )


def state_events(state: DataFrame) -> DataFrame:
    """Stored events of a state table as rows, keeping their stored order."""
    ex = state.select("card_hash", F.posexplode("last_events").alias(_POS, "_lk_ev"))
    return ex.select(
        "card_hash",
        F.col("_lk_ev.ts").alias("ts"),
        F.col("_lk_ev.auth_result").alias("auth_result"),
        F.col("_lk_ev.country").alias("country"),
        F.lit(0).alias(_SRC),
        F.col(_POS).cast("int").alias(_POS),
        F.lit(None).cast("string").alias(_TIE),
    )


# Row order of a card's history: stored events (by position) before batch
# events (by time, NULL first, then id; the event fields break any remaining
# tie so the kept rows are the same on every run).
_ORDER = [_SRC, _POS, "ts", _TIE, "auth_result", "country"]


def last_events(rows: DataFrame, n: int = HISTORY, with_clock: bool = True) -> DataFrame:
    """Build state rows: per card the last ``n`` rows of the history order."""
    w = Window.partitionBy("card_hash").orderBy(*[F.col(c).desc_nulls_last() for c in _ORDER])
    top = rows.withColumn("_lk_rn", F.row_number().over(w)).filter(F.col("_lk_rn") <= n)
    packed = F.struct(*[F.col(c) for c in _ORDER], _event_struct().alias("ev"))
    state = top.groupBy("card_hash").agg(F.sort_array(F.collect_list(packed)).alias("_lk_arr"))
    state = state.select("card_hash", F.transform("_lk_arr", lambda x: x["ev"]).alias("last_events"))
    clock = F.current_timestamp() if with_clock else F.lit(None).cast("timestamp")
    return state.withColumn("updated_at", clock)


def merge_state(prev_state: DataFrame | None, batch: DataFrame, n: int = HISTORY, with_clock: bool = True) -> DataFrame:
    """Next state version.  Cards of the batch get the last ``n`` of
    (stored + batch) events; other cards keep their stored row."""
    rows = batch_events(batch)
    if prev_state is None:
        return last_events(rows, n, with_clock)
    cards = rows.select("card_hash").distinct()
    touched = prev_state.join(cards, "card_hash", "left_semi")
    merged = last_events(state_events(touched).unionByName(rows), n, with_clock)
    untouched = prev_state.join(cards, "card_hash", "left_anti")
    return untouched.select(*merged.columns).unionByName(merged)


def explode_state(state: DataFrame) -> DataFrame:
    """State as one row per stored event (pos 1 = oldest), for checks."""
    ex = state.select("card_hash", F.posexplode("last_events").alias("pos", "ev"))
    return ex.select(
        "card_hash",
        (F.col("pos") + 1).alias("pos"),
        F.col("ev.ts").alias("ts"),
        F.col("ev.auth_result").alias("auth_result"),
        F.col("ev.country").alias("country"),
    )
