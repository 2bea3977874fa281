"""Per-key ordered windows that stay parallel when one key is hot.

A window ``PARTITION BY card_hash`` sends every event of a card to one task;
if one card holds a third of all rows, that task holds a third of the data,
and AQE cannot split a window partition.  So:

1. ``hot_keys`` finds the keys with more than ``hot_rows`` rows (a
   map-side-combined count; only keys above the bound survive, so the list is
   at most rows / hot_rows long and its size is checked before it is used).
2. Rows of hot keys are cut into time buckets (``PARTITION BY key, bucket``);
   rows of all other keys keep one bucket per key (plain partitioning).
3. Every bucket of a hot key receives, as *context rows*, exactly the earlier
   rows its frames can see:

   * time context (role 0): rows of the previous bucket within ``lookback``
     of the bucket start -- what ``RANGE ... PRECEDING`` frames of at most
     ``lookback`` need.  Emitted in the same scan with ``explode``; frames
     reaching ``FOLLOWING`` get the mirror image (role -1, ``lookahead``);
   * carried context (role i >= 1): for carry ``i = (condition, k)``, the last
     ``k`` earlier rows satisfying the condition however far back -- what a
     ``ROWS k PRECEDING`` frame or ``lag`` over those rows needs.  Found from
     per-bucket tails (<= k rows per bucket, cut map-side by
     ``WindowGroupLimit``) with a window over one row per (key, bucket).

Context rows are marked in ``ROLE`` and dropped after the window functions;
results equal the unsplit window (tests compare both, and DuckDB).  NULL
timestamps of a hot key form one bucket that sorts first (``NULLS FIRST``).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BKT = "_lk_bkt"
ROLE = "_lk_role"
HOT = "_lk_hot"
_TAIL = "_lk_tail"
_PREV = "_lk_prev"
_ROW = "_lk_r"
_RANK = "_lk_rank"
COLD_BUCKET = -1
_OWN = -100  # marker of the own row while exploding copies (becomes NULL)

DAY = 86_400
# A key with more rows than this is split; below it one task holds the key.
DEFAULT_HOT_ROWS = 2_000_000
# Hot keys are matched with an IN-list up to this many, with a join beyond.
MAX_INLIST_KEYS = 1_000


def epoch_seconds(ts: Column, dtype: str) -> Column:
    """Whole seconds since 1970 as a monotone long, for both timestamp types.

    TIMESTAMP_NTZ is wall-clock time: its seconds are computed from the
    calendar fields so the session time zone (and DST) cannot change them.
    """
    if dtype == "timestamp_ntz":
        return (
            F.unix_date(F.to_date(ts)).cast("long") * DAY
            + F.hour(ts).cast("long") * 3600
            + F.minute(ts).cast("long") * 60
            + F.second(ts).cast("long")
        )
    return F.unix_seconds(ts.cast("timestamp"))


def bucket_of(ts: Column, dtype: str, bucket_seconds: int) -> Column:
    return F.floor(epoch_seconds(ts, dtype) / F.lit(bucket_seconds)).cast("long")


def interval(seconds: int) -> Column:
    return F.expr(f"INTERVAL {int(seconds)} SECONDS")


def default_bucket_seconds(lookback_seconds: int) -> int:
    """Bucket width: an hour, or six look-backs when that is longer (time
    context then copies at most a sixth of a hot key's rows).  Only hot keys
    are cut, so narrow buckets cost nothing elsewhere; a key with a billion
    rows a day comes to some 40 million rows a bucket."""
    return max(3_600, 6 * int(lookback_seconds))


def hot_keys(df: DataFrame, key: str, hot_rows: int = DEFAULT_HOT_ROWS) -> Column | DataFrame | None:
    """Which keys to split: ``None`` (no hot key), a boolean Column (short
    IN-list), or a one-column DataFrame of keys (join it in).

    Runs one small job: a count per key with map-side combine, filtered to
    the keys above ``hot_rows``; at most ``MAX_INLIST_KEYS + 1`` rows come
    back to the driver, so the check is bounded whatever the data size.
    """
    counts = (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("_lk_n"))
        .filter(F.col("_lk_n") > hot_rows)
        .select(key)
    )
    sample = [r[0] for r in counts.limit(MAX_INLIST_KEYS + 1).collect()]
    if not sample:
        return None
    if len(sample) <= MAX_INLIST_KEYS:
        return F.col(key).isin(sample)
    return counts


def mark_hot(df: DataFrame, key: str, hot: Column | DataFrame | bool | None) -> DataFrame:
    """Add the boolean ``HOT`` column from the result of ``hot_keys``."""
    if hot is None or hot is False:
        return df.withColumn(HOT, F.lit(False))
    if hot is True:
        return df.withColumn(HOT, F.col(key).isNotNull())
    if isinstance(hot, Column):
        return df.withColumn(HOT, F.coalesce(hot, F.lit(False)))
    flagged = hot.select(key).withColumn(HOT, F.lit(True))
    return df.join(flagged, key, "left").withColumn(HOT, F.coalesce(F.col(HOT), F.lit(False)))


def split_with_context(
    df: DataFrame,
    key: str,
    ts: str,
    order: Sequence[str],
    bucket_seconds: int,
    lookback_seconds: int = 0,
    carries: Sequence[tuple[Column, int]] = (),
    lookahead_seconds: int = 0,
) -> DataFrame:
    """Rows of ``df`` (ROLE NULL) plus context rows, tagged with ``BKT``.

    ``df`` must carry ``HOT`` (see ``mark_hot``): only hot rows are bucketed
    and only they produce context.  ``order`` lists the frame order columns
    (ascending, NULLS FIRST, ``ts`` first); tails are ranked by its reverse.
    ``lookahead_seconds`` adds the mirror image of the time context (rows at
    the start of the next bucket, role -1) for frames reaching FOLLOWING.
    """
    if max(lookback_seconds, lookahead_seconds) > bucket_seconds:
        raise ValueError("look-back and look-ahead must not exceed the bucket width")
    dtype = dict(df.dtypes)[ts]
    cols = df.columns
    hot = F.col(HOT)
    timed = hot & F.col(ts).isNotNull()
    base = df.withColumn(BKT, F.when(hot, bucket_of(F.col(ts), dtype, bucket_seconds)).otherwise(F.lit(COLD_BUCKET)))
    next_bucket = prev_bucket = None
    # One scan: a row near the end (start) of its bucket is also emitted as
    # time context of the next (previous) bucket.
    own = F.lit(_OWN)
    roles = [own]
    if lookback_seconds > 0:
        next_bucket = bucket_of(F.col(ts) + interval(lookback_seconds), dtype, bucket_seconds)
        roles.append(F.when(timed & (next_bucket != F.col(BKT)), F.lit(0)))
    if lookahead_seconds > 0:
        prev_bucket = bucket_of(F.col(ts) - interval(lookahead_seconds), dtype, bucket_seconds)
        roles.append(F.when(timed & (prev_bucket != F.col(BKT)), F.lit(-1)))
    if len(roles) > 1:
        # the own row plus the context copies that apply (others are NULL)
        copies = F.filter(F.array(*roles), lambda r: r.isNotNull())
        framed = base.withColumn(ROLE, F.explode(copies))
        framed = framed.withColumn(ROLE, F.when(F.col(ROLE) != _OWN, F.col(ROLE)))
        bkt = F.col(BKT)
        if next_bucket is not None:
            bkt = F.when(F.col(ROLE) == 0, next_bucket).otherwise(bkt)
        if prev_bucket is not None:
            bkt = F.when(F.col(ROLE) == -1, prev_bucket).otherwise(bkt)
        framed = framed.withColumn(BKT, bkt)
    else:
        framed = base.withColumn(ROLE, F.lit(None).cast("int"))
    parts = [framed]
    for i, (cond, k) in enumerate(carries, start=1):
        if k > 0:
            parts.append(_carried(base, cols, key, ts, list(order), hot & cond, k, i, next_bucket))
    return reduce(lambda a, b: a.unionByName(b), parts)


def _carried(
    base: DataFrame,
    cols: list[str],
    key: str,
    ts: str,
    order: list[str],
    cond: Column,
    k: int,
    role: int,
    next_bucket: Column | None,
) -> DataFrame:
    """The last ``k`` rows satisfying ``cond`` before each bucket having such rows."""
    rank_w = Window.partitionBy(key, BKT).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    tails = base.filter(cond).withColumn(_RANK, F.row_number().over(rank_w)).filter(F.col(_RANK) <= k)
    # Order fields first: sorting the structs then sorts by row order
    # (struct comparison is field by field, NULL lowest = NULLS FIRST).
    packed = F.struct(*[F.col(c).alias(f"_o{j}") for j, c in enumerate(order)], F.struct(*[F.col(c) for c in cols]).alias(_ROW))
    per_bucket = tails.groupBy(key, BKT).agg(F.collect_list(packed).alias(_TAIL))
    # Buckets of one key, oldest first (NULL-time bucket first); each earlier
    # bucket adds >= 1 qualifying row, so the k previous buckets suffice.
    prev_w = Window.partitionBy(key).orderBy(F.col(BKT).asc_nulls_first()).rowsBetween(-k, -1)
    prev = per_bucket.select(key, BKT, F.sort_array(F.flatten(F.collect_list(_TAIL).over(prev_w))).alias(_PREV))
    prev = prev.select(
        BKT,
        F.explode(F.expr(f"slice({_PREV}, greatest(size({_PREV}) - {k} + 1, 1), {k})")).alias("_lk_item"),
    ).select(BKT, F.col(f"_lk_item.{_ROW}").alias(_ROW))
    ctx = prev.select(*[F.col(f"{_ROW}.{c}").alias(c) for c in cols], BKT).withColumn(ROLE, F.lit(role))
    if next_bucket is not None:
        # Rows within the look-back already arrive as time context.
        ctx = ctx.filter(F.col(ts).isNull() | (next_bucket != F.col(BKT)))
    return ctx


def member(role: int | None, cond: Column) -> Column:
    """Row takes part in the frames of carry ``role``: own rows, time context
    and the rows carried for that role (never another role's copies)."""
    ok = F.col(ROLE).isNull() | (F.col(ROLE) <= 0)
    if role is not None:
        ok = ok | (F.col(ROLE) == role)
    return F.coalesce(cond & ok, F.lit(False))
