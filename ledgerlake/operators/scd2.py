"""Type-2 history (snapshot with the "newer timestamp" strategy).

A new version of a key starts at every row whose tracked columns differ
(NULL-safe) from the key's previous row in (ts, tie) order; it is valid until
the next version starts.  Both neighbour look-ups avoid a window over the
whole key (a hot merchant would sit in one task):

* previous row: ``lag`` inside (key, time bucket) with the last row of the
  earlier buckets carried in as context (``operators.ordered``);
* next version: ``lead`` inside (key, bucket); the last version of a bucket
  takes the first version of the next bucket that has one, found by a window
  over one aggregated row per (key, bucket).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import ordered as O


def versions(
    df: DataFrame,
    key: str,
    tracked: Sequence[str],
    ts: str = "ts_event",
    tie: str = "transaction_id",
    bucket_seconds: int = O.DAY,
    split: str = "auto",
    hot_rows: int = O.DEFAULT_HOT_ROWS,
    hot_source: DataFrame | None = None,
) -> DataFrame:
    """History rows ``key, tracked..., valid_from, valid_to, is_current``.

    ``hot_source``: a cheaper DataFrame whose per-key row counts bound those
    of ``df`` (e.g. the raw feed before deduplication) for hot-key detection.
    """
    tracked = list(tracked)
    rows = df.filter(F.col(key).isNotNull()).select(key, *tracked, ts, tie)
    probe = rows if hot_source is None else hot_source
    hot = True if split == "always" else (O.hot_keys(probe, key, hot_rows) if split == "auto" else None)
    marked = O.mark_hot(rows, key, hot)
    if hot is None:
        framed = marked.withColumn(O.BKT, F.lit(O.COLD_BUCKET).cast("long")).withColumn(O.ROLE, F.lit(None).cast("int"))
    else:
        framed = O.split_with_context(marked, key, ts, [ts, tie, *tracked], bucket_seconds, 0, [(F.lit(True), 1)])
    # (ts, tie) then the tracked values: a total order up to identical rows
    order = [F.col(c).asc_nulls_first() for c in (ts, tie, *tracked)]
    w = Window.partitionBy(key, O.BKT).orderBy(*order)
    state = F.struct(*[F.col(c) for c in tracked])
    prev = F.lag(F.struct(state.alias("v")), 1).over(w)
    changed = prev.isNull() | ~prev["v"].eqNullSafe(state)
    starts = framed.withColumn("_lk_chg", changed).filter(F.col(O.ROLE).isNull() & F.col("_lk_chg"))
    starts = starts.select(key, *tracked, ts, tie, O.BKT)

    # Next version inside the bucket ...
    starts = starts.withColumn("_lk_next", F.lead(F.col(ts), 1).over(w)).withColumn(
        "_lk_has_next", F.lead(F.lit(1), 1).over(w).isNotNull()
    )
    valid_to = F.col("_lk_next")
    is_current = ~F.col("_lk_has_next")
    if hot is not None:
        # ... or the first version of the next bucket that has one.
        firsts = starts.groupBy(key, O.BKT).agg(F.min(F.struct(F.col(ts), F.col(tie), *[F.col(c) for c in tracked]))[ts].alias("_lk_first"))
        bw = Window.partitionBy(key).orderBy(F.col(O.BKT).asc_nulls_first())
        firsts = firsts.select(
            key,
            O.BKT,
            F.lead("_lk_first", 1).over(bw).alias("_lk_after"),
            F.lead(F.lit(1), 1).over(bw).isNotNull().alias("_lk_has_after"),
        )
        starts = starts.join(firsts, [key, O.BKT], "left")
        valid_to = F.when(F.col("_lk_has_next"), F.col("_lk_next")).otherwise(F.col("_lk_after"))
        is_current = ~(F.col("_lk_has_next") | F.coalesce(F.col("_lk_has_after"), F.lit(False)))
    return starts.select(
        key, *tracked, F.col(ts).alias("valid_from"), valid_to.alias("valid_to"), is_current.alias("is_current")
    )


def is_newer(ts: str, since: str = "_lk_since", known: str = "_lk_known"):
    """Does a row count for a key whose current version began at ``since``?

    Rows of unknown keys do; of known ones those after the version's start.  A row without
    time is before every other: it can only begin the history of an unknown key.
    """
    return F.col(known).isNull() | F.coalesce(F.col(ts) > F.col(since), F.col(since).isNull() & F.col(ts).isNotNull())


def _beside_current(snapshot: DataFrame, current: DataFrame, key: str) -> DataFrame:
    begun = current.select(key, F.col("valid_from").alias("_lk_since"), F.lit(True).alias("_lk_known"))
    return snapshot.filter(F.col(key).isNotNull()).join(begun, key, "left")


def ignored_rows(current: DataFrame, snapshot: DataFrame, key: str, ts: str = "ts_event") -> DataFrame:
    """Rows of a snapshot that change nothing as they are not newer than their key's current
    version (rows without time of known keys among them), or have no key: to be counted."""
    beside = _beside_current(snapshot, current, key)
    return beside.filter(~is_newer(ts)).select(*snapshot.columns).unionByName(snapshot.filter(F.col(key).isNull()))


def changes(
    current: DataFrame, snapshot: DataFrame, key: str, tracked: Sequence[str], ts: str = "ts_event", tie: str = "transaction_id"
) -> DataFrame:
    """What a snapshot makes of the keys it touches: their current version (closed or not) and those after it.

    Only newer rows and the current versions of their keys take part, so the cost is that
    of the snapshot and of one look at the current versions, never of the closed ones.
    """
    tracked = list(tracked)
    newer = _beside_current(snapshot, current, key).filter(is_newer(ts)).select(key, *tracked, ts, tie)
    begun = current.select(key, *tracked, F.col("valid_from").alias(ts), F.lit(None).cast("string").alias(tie))
    touched = begun.join(newer.select(key).distinct(), key, "left_semi")
    return versions(touched.unionByName(newer), key, tracked, ts, tie)


def close_and_append(
    current: DataFrame,
    snapshot: DataFrame,
    key: str,
    tracked: Sequence[str],
    ts: str = "ts_event",
    tie: str = "transaction_id",
) -> tuple[DataFrame, DataFrame]:
    """(current versions after the snapshot, versions closed by it): the closed ones are appended to
    those before and never read again.  The changes are written once, below the checkpoint folder."""
    new = _staged(changes(current, snapshot, key, tracked, ts, tie))
    after = current.join(new.select(key).distinct(), key, "left_anti").unionByName(
        new.filter("is_current").select(*current.columns)
    )
    return after, new.filter("NOT is_current").select(*current.columns)


def _staged(df: DataFrame) -> DataFrame:
    from ..session import scratch_path

    path = scratch_path(df.sparkSession, "scd2")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def apply_snapshot(
    history: DataFrame,
    snapshot: DataFrame,
    key: str,
    tracked: Sequence[str],
    ts: str = "ts_event",
    tie: str = "transaction_id",
) -> DataFrame:
    """``close_and_append`` on a history in one table: the whole history after the snapshot."""
    current, closed = close_and_append(history.filter("is_current"), snapshot, key, tracked, ts, tie)
    return history.filter("NOT is_current").unionByName(current).unionByName(closed)
