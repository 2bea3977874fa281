"""Fraud rules as parameterised, set-based Spark operators.

Per-event rules (one flag per payment, looking only at the card's earlier
events):

* V1 velocity     -- more than ``limit`` timed events of the card in the
                     trailing ``window`` (RANGE frame, inclusive).
* V2 cross_border -- another country among the card's timed events in the
                     trailing ``window`` (inclusive); ``min``/``max`` of the
                     frame instead of a pair search.
* V4 cross_border_prev -- the previous timed event (with a country) has
                     another country and is at most ``window`` earlier.
* J3 cross_border_pair -- the card has an event with another country at most
                     ``window`` before *or after* (the self-join's predicate
                     ``same card, other country, |dt| <= window``), answered
                     with a centred RANGE frame instead of emitting pairs.
* V3 decline_rate -- share of DECLINED among the card's last ``n`` attempts
                     (rows with an auth result) above ``threshold``, with at
                     least ``min_attempts`` attempts.
* P10 high_amount -- amount strictly above ``threshold``.

All frames of one call share the partitioning (card, time bucket), so they
run after one shuffle; see ``operators.ordered`` for the hot-card split.
Rows without a card take part in no per-card rule (only high amount).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import ordered as O
from . import columns as C

COUNTRY = "_lk_country"


@dataclass(frozen=True)
class RuleParams:
    """Rule parameters; defaults are the reference's fixed values."""

    high_threshold: str = C.HIGH_AMOUNT_THRESHOLD
    velocity_limit: int = 5
    velocity_window_s: int = 60
    cross_window_s: int = 600
    decline_threshold: str = "0.5"
    decline_n: int = 10
    decline_min_attempts: int = 1
    bucket_seconds: int | None = None


DEFAULT_PARAMS = RuleParams()
ALL_RULES = ("high_amount", "velocity", "cross_border", "cross_border_pair", "cross_border_prev", "decline_rate")


def with_country(df: DataFrame, location: str = "location") -> DataFrame:
    """P3 as a rule input: empty country text counts as no country."""
    return df.withColumn(COUNTRY, F.nullif(C.country_from_location(location), F.lit("")))


def event_flags(
    df: DataFrame,
    rules: tuple[str, ...] = ("high_amount", "velocity", "cross_border", "decline_rate"),
    params: RuleParams = DEFAULT_PARAMS,
    key: str = "card_hash",
    ts: str = "ts_event",
    tie: str = "transaction_id",
    eligible: Column | None = None,
    split: str = "auto",
    hot_rows: int = O.DEFAULT_HOT_ROWS,
    hot_source: DataFrame | None = None,
) -> DataFrame:
    """Add one boolean column per rule in ``rules`` (named like the rule).

    Rows without a card, and rows where ``eligible`` is false, take part in no
    frame and get only the high-amount flag (ineligible rows: no flag at all).
    ``split``: ``"auto"`` buckets the keys above ``hot_rows`` rows,
    ``"always"`` buckets every key, ``"never"`` is the plain
    ``PARTITION BY key`` form.  ``hot_source``: a cheaper DataFrame whose
    per-key counts bound those of ``df``, used for hot-key detection.
    """
    per_card = any(r in rules for r in ("velocity", "cross_border", "cross_border_prev", "cross_border_pair", "decline_rate"))
    if not per_card:  # row-level rules only: no frame, no shuffle, one pass
        high = C.high_amount("amount", params.high_threshold)
        if eligible is not None:
            high = high & F.coalesce(eligible, F.lit(False))
        return df.select("*", *[(high if r == "high_amount" else F.lit(False)).alias(r) for r in _ordered(rules)])
    x = with_country(df)
    cols = x.columns
    elig = F.col(key).isNotNull()
    if eligible is not None:
        elig = elig & F.coalesce(eligible, F.lit(False))
    # Rows outside the rules (no card, not eligible) bypass the windows: one
    # shared NULL-key window partition could hold a large share of the data.
    x = x.withColumn(_ELIG, elig)
    outside = x.filter(~F.col(_ELIG))
    x = x.filter(F.col(_ELIG))

    windows = []
    if "velocity" in rules:
        windows.append(params.velocity_window_s)
    if any(r in rules for r in ("cross_border", "cross_border_prev", "cross_border_pair")):
        windows.append(params.cross_window_s)
    lookback = max(windows) if windows else 0
    lookahead = params.cross_window_s if "cross_border_pair" in rules else 0

    t = F.col(ts)
    attempt = F.col("auth_result").isNotNull()
    located = t.isNotNull() & F.col(COUNTRY).isNotNull()
    carries: list[tuple[Column, int]] = []
    role = {}
    if "decline_rate" in rules:
        carries.append((attempt, params.decline_n - 1))
        role["decline_rate"] = len(carries)
    if "cross_border_prev" in rules:
        carries.append((located, 1))
        role["cross_border_prev"] = len(carries)

    # Row order of the ROWS frames, lag and carried tails: time, id, then the
    # rule inputs, so rows that tie on (time, id) still order the same way on
    # every run (only rows identical in all of them remain tied, harmlessly).
    order_cols = [ts, tie] + [c for c in ("auth_result", "location", "amount") if c in cols and c not in (ts, tie)]
    order_sql = ", ".join(f"{c} ASC NULLS FIRST" for c in order_cols)
    if split == "always":
        hot = True
    elif split == "auto":
        hot = O.hot_keys(x if hot_source is None else hot_source, key, hot_rows)
    else:
        hot = None
    marked = O.mark_hot(x, key, hot)
    marked = marked.withColumn(O.HOT, F.col(O.HOT) & F.col(_ELIG))
    if hot is None:
        framed = marked.withColumn(O.BKT, F.lit(O.COLD_BUCKET).cast("long")).withColumn(O.ROLE, F.lit(None).cast("int"))
    else:
        bucket = params.bucket_seconds or O.default_bucket_seconds(max(lookback, lookahead))
        framed = O.split_with_context(marked, key, ts, order_cols, bucket, lookback, carries, lookahead)

    out_cols = []
    part_sql = f"{key}, {O.BKT}"
    ok = F.col(_ELIG)
    if "velocity" in rules:
        n = F.expr(
            f"count({ts}) OVER (PARTITION BY {part_sql} ORDER BY {ts} "
            f"RANGE BETWEEN INTERVAL {params.velocity_window_s} SECONDS PRECEDING AND CURRENT ROW)"
        )
        framed = framed.withColumn("_lk_vel_n", n)
        out_cols.append((ok & t.isNotNull() & (F.col("_lk_vel_n") > params.velocity_limit)).alias("velocity"))
    if "cross_border" in rules:
        spec = (
            f"OVER (PARTITION BY {part_sql} ORDER BY {ts} "
            f"RANGE BETWEEN INTERVAL {params.cross_window_s} SECONDS PRECEDING AND CURRENT ROW)"
        )
        framed = framed.withColumn("_lk_cmin", F.expr(f"min({COUNTRY}) {spec}")).withColumn(
            "_lk_cmax", F.expr(f"max({COUNTRY}) {spec}")
        )
        other = (F.col("_lk_cmin") != F.col(COUNTRY)) | (F.col("_lk_cmax") != F.col(COUNTRY))
        out_cols.append(F.coalesce(ok & located & other, F.lit(False)).alias("cross_border"))
    if "cross_border_pair" in rules:
        spec = (
            f"OVER (PARTITION BY {part_sql} ORDER BY {ts} RANGE BETWEEN INTERVAL {params.cross_window_s} SECONDS "
            f"PRECEDING AND INTERVAL {params.cross_window_s} SECONDS FOLLOWING)"
        )
        framed = framed.withColumn("_lk_pmin", F.expr(f"min({COUNTRY}) {spec}")).withColumn(
            "_lk_pmax", F.expr(f"max({COUNTRY}) {spec}")
        )
        other = (F.col("_lk_pmin") != F.col(COUNTRY)) | (F.col("_lk_pmax") != F.col(COUNTRY))
        out_cols.append(F.coalesce(ok & located & other, F.lit(False)).alias("cross_border_pair"))
    if "cross_border_prev" in rules:
        framed = framed.withColumn("_lk_loc", O.member(role["cross_border_prev"], located))
        w = f"OVER (PARTITION BY {part_sql}, _lk_loc ORDER BY {order_sql})"
        framed = framed.withColumn("_lk_pc", F.expr(f"lag({COUNTRY}) {w}")).withColumn("_lk_pt", F.expr(f"lag({ts}) {w}"))
        hit = (
            ok
            & F.col("_lk_loc")
            & (F.col("_lk_pc") != F.col(COUNTRY))
            & (t <= F.col("_lk_pt") + O.interval(params.cross_window_s))
        )
        out_cols.append(F.coalesce(hit, F.lit(False)).alias("cross_border_prev"))
    if "decline_rate" in rules:
        framed = framed.withColumn("_lk_att", O.member(role["decline_rate"], attempt))
        w = (
            f"OVER (PARTITION BY {part_sql}, _lk_att ORDER BY {order_sql} "
            f"ROWS BETWEEN {params.decline_n - 1} PRECEDING AND CURRENT ROW)"
        )
        framed = framed.withColumn(
            "_lk_dec", F.expr(f"sum(CASE WHEN auth_result = '{C.DECLINED}' THEN 1 ELSE 0 END) {w}")
        ).withColumn("_lk_cnt", F.expr(f"count(1) {w}"))
        # declined / attempts > threshold, in exact decimal arithmetic
        hit = (
            ok
            & F.col("_lk_att")
            & (F.col("_lk_cnt") >= params.decline_min_attempts)
            & (F.col("_lk_dec") > C.decimal_literal(params.decline_threshold) * F.col("_lk_cnt"))
        )
        out_cols.append(F.coalesce(hit, F.lit(False)).alias("decline_rate"))
    if "high_amount" in rules:
        high = C.high_amount("amount", params.high_threshold)
        if eligible is not None:
            high = high & F.coalesce(eligible, F.lit(False))
        out_cols.append(high.alias("high_amount"))

    out = framed.filter(F.col(O.ROLE).isNull()).select(*cols, *out_cols).select(*cols, *_ordered(rules))
    high_only = C.high_amount("amount", params.high_threshold)
    if eligible is not None:
        high_only = high_only & F.coalesce(eligible, F.lit(False))
    rest = outside.select(
        *cols, *[(high_only if r == "high_amount" else F.lit(False)).alias(r) for r in _ordered(rules)]
    )
    return out.unionByName(rest).drop(COUNTRY, _ELIG)


_ELIG = "_lk_elig"


def _ordered(rules) -> list[str]:
    order = ["velocity", "cross_border", "cross_border_pair", "cross_border_prev", "decline_rate", "high_amount"]
    return [r for r in order if r in rules]


def card_scope(
    flags: DataFrame,
    rules: tuple[str, ...],
    key: str = "card_hash",
    ts: str = "ts_event",
    tie: str = "transaction_id",
    eligible: Column | None = None,
) -> DataFrame:
    """A3: a card's rule hit marks all of its events.

    Velocity and cross-border: any event of the card hit.  Decline rate: the
    value at the card's last attempt (the rate over its last n attempts).
    Per-card values come from a map-side-combined aggregate (one row per card)
    joined back on the card; a hot card is split by AQE's skew join.
    """
    aggs = []
    for r in rules:
        if r == "decline_rate":
            last = F.max_by(
                F.col("decline_rate"),
                F.when(F.col("auth_result").isNotNull(), F.struct(F.col(ts), F.col(tie))),
            )
            aggs.append(F.coalesce(last, F.lit(False)).alias(f"_lk_card_{r}"))
        else:
            aggs.append(F.max(F.col(r)).alias(f"_lk_card_{r}"))
    elig = F.lit(True) if eligible is None else F.coalesce(eligible, F.lit(False))
    per_card = flags.filter(F.col(key).isNotNull() & elig).groupBy(key).agg(*aggs)
    joined = flags.join(per_card, key, "left")
    out = joined
    for r in rules:
        out = out.withColumn(r, F.coalesce(F.col(f"_lk_card_{r}") & elig, F.lit(False))).drop(f"_lk_card_{r}")
    return out.select(*flags.columns)


def velocity_as_coded(df: DataFrame, limit: int = 5, key: str = "card_hash", ts: str = "ts_event") -> DataFrame:
    """A4: more than ``limit`` timed events of the card in scope (the whole
    batch), i.e. the one-sided test of the original job.  Adds ``velocity``."""
    per_card = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(ts).alias("_lk_timed"))
    return (
        df.join(per_card, key, "left")
        .withColumn("velocity", F.coalesce(F.col("_lk_timed") > limit, F.lit(False)))
        .drop("_lk_timed")
    )


def reasons(flags: DataFrame, rules: tuple[str, ...] = ("high_amount", "velocity", "cross_border", "decline_rate")) -> DataFrame:
    """Add ``reason`` = comma-joined codes of the hit rules (empty if none)."""
    codes = [*C.REASON_CODES, C.BLACKLIST_CODE]
    return flags.withColumn("reason", C.reason_text({r: r for r in rules if r in codes}))


def blacklisted(df: DataFrame, blacklist: DataFrame, eligible: Column | None = None) -> DataFrame:
    """D6/J1 on the stream side: add ``blacklisted`` (merchant on the list).

    The list is deduplicated first so the left join cannot multiply rows; AQE
    chooses the join from its measured size (``lookup_join``)."""
    from ..operators.joins import lookup_join

    listed = blacklist.select("merchant_id").filter(F.col("merchant_id").isNotNull()).distinct()
    flag = F.coalesce(F.col("_lk_listed"), F.lit(False))
    if eligible is not None:
        flag = flag & F.coalesce(eligible, F.lit(False))
    joined = lookup_join(df, listed.withColumn("_lk_listed", F.lit(True)), "merchant_id", "left")
    return joined.withColumn(C.BLACKLIST_CODE, flag).drop("_lk_listed")
