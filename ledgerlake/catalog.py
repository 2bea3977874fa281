"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Every query reads the driver's tables (through the feeds of
``sources.feeds``) and runs over them whole.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import columns as C
from .functions import rules as R
from .operators import scd2 as H
from .operators import upsert as U
from .operators.dedup import keep_earliest
from . import schemas as SCH
from .operators import state as S
from .operators import quality as Q
from .plans import gold, marts, silver
from .plans import reports as RP
from .plans import screening as SCR
from .sources import messages as M
from .schemas import PAYMENT
from .sources import feeds

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return deco


def _s(spark, sf_dir, card=True, mcc=True, location=True, columns=None):
    return silver.silver_payments(spark, sf_dir, card=card, mcc=mcc, location=location, columns=columns)


SETTLE_COLS = ["merchant_id", "currency", "ts_event", "amount"]
FACT_COLS = ["transaction_id", "ts_event", "card_hash", "merchant_id", "amount", "currency", "auth_result"]
MERCHANT_COLS = ["transaction_id", "ts_event", "merchant_id", "mcc"]


def _facts(spark, sf_dir):
    tx = _s(spark, sf_dir, columns=FACT_COLS)
    return marts.fact_transactions(tx, feeds.supplier_blacklist(spark, sf_dir))


@register("stg_payments")
def q_stg_payments(spark, sf_dir):
    return marts.stg_payments(feeds.lineitem_payments(spark, sf_dir))


@register("silver_dedup")
def q_silver_dedup(spark, sf_dir):
    return _s(spark, sf_dir)


@register("backfill_range")
def q_backfill_range(spark, sf_dir):
    return silver.silver_payments(spark, sf_dir, date_from="1996-01-01", date_to="1996-12-31")


@register("backfill_columns")
def q_backfill_columns(spark, sf_dir):
    without_mcc = _s(spark, sf_dir, columns=[c for c in feeds.PAYMENT_COLUMNS if c != "mcc"])
    return silver.backfill_columns(without_mcc, PAYMENT)


@register("country_extract")
def q_country_extract(spark, sf_dir):
    tx = _s(spark, sf_dir, columns=["location"])
    return tx.groupBy(C.country_from_location("location").alias("country")).agg(F.count(F.lit(1)).alias("n"))


@register("dim_card")
def q_dim_card(spark, sf_dir):
    return marts.dim_card(_s(spark, sf_dir, columns=["card_hash"]))


@register("dim_date")
def q_dim_date(spark, sf_dir):
    return marts.dim_date(_s(spark, sf_dir, columns=["ts_event"]))


@register("dim_merchant_pairs")
def q_dim_merchant_pairs(spark, sf_dir):
    return marts.dim_merchant_pairs(feeds.lineitem_payments(spark, sf_dir, card=False, location=False))


@register("dim_merchant")
def q_dim_merchant(spark, sf_dir):
    return marts.dim_merchant(_s(spark, sf_dir, columns=MERCHANT_COLS))


@register("fact_transactions")
def q_fact_transactions(spark, sf_dir):
    return _facts(spark, sf_dir)


@register("fact_fraud_signals")
def q_fact_fraud_signals(spark, sf_dir):
    return marts.fact_fraud_signals(_facts(spark, sf_dir))


@register("amount_buckets")
def q_amount_buckets(spark, sf_dir):
    return marts.amount_buckets(_s(spark, sf_dir, columns=["transaction_id", "amount"]))


@register("settlement_daily")
def q_settlement_daily(spark, sf_dir):
    return marts.settlement_daily(_s(spark, sf_dir, columns=SETTLE_COLS))


@register("merchant_totals")
def q_merchant_totals(spark, sf_dir):
    return marts.merchant_totals(_s(spark, sf_dir, columns=SETTLE_COLS))


@register("gold_review_backfill")
def q_gold_review_backfill(spark, sf_dir):
    return gold.review_backfill(_s(spark, sf_dir, columns=FACT_COLS + ["location"]))


# --- fraud rules over feed E ------------------------------------------------

E_HIGH_THRESHOLD = "200"  # feed E amounts stay below 500
VELOCITY_DAY = R.RuleParams(velocity_window_s=86_400)


def _e(spark, sf_dir):
    return feeds.event_payments(spark, sf_dir)


def _flagged(df, rule):
    return df.filter(F.col(rule)).select("transaction_id", "card_hash", "ts_event")


@register("velocity_event")
def q_velocity_event(spark, sf_dir):
    return _flagged(R.event_flags(_e(spark, sf_dir), ("velocity",), VELOCITY_DAY), "velocity")


@register("velocity_card_scope")
def q_velocity_card_scope(spark, sf_dir):
    flags = R.event_flags(_e(spark, sf_dir), ("velocity",), VELOCITY_DAY)
    return _flagged(R.card_scope(flags, ("velocity",)), "velocity")


@register("velocity_batch_count")
def q_velocity_batch_count(spark, sf_dir):
    return _flagged(R.velocity_as_coded(_e(spark, sf_dir)), "velocity")


@register("cross_border_event")
def q_cross_border_event(spark, sf_dir):
    return _flagged(R.event_flags(_e(spark, sf_dir), ("cross_border",)), "cross_border")


@register("cross_border_prev")
def q_cross_border_prev(spark, sf_dir):
    return _flagged(R.event_flags(_e(spark, sf_dir), ("cross_border_prev",)), "cross_border_prev")


@register("cross_border_selfjoin")
def q_cross_border_selfjoin(spark, sf_dir):
    # The pair search's question, answered per event by a centred frame
    return _flagged(R.event_flags(_e(spark, sf_dir), ("cross_border_pair",)), "cross_border_pair")


@register("cross_border_card_scope")
def q_cross_border_card_scope(spark, sf_dir):
    flags = R.event_flags(_e(spark, sf_dir), ("cross_border",))
    return _flagged(R.card_scope(flags, ("cross_border",)), "cross_border")


@register("decline_rate_event")
def q_decline_rate_event(spark, sf_dir):
    return _flagged(R.event_flags(_e(spark, sf_dir), ("decline_rate",)), "decline_rate")


@register("decline_rate_card_scope")
def q_decline_rate_card_scope(spark, sf_dir):
    flags = R.event_flags(_e(spark, sf_dir), ("decline_rate",))
    return _flagged(R.card_scope(flags, ("decline_rate",)), "decline_rate")


@register("high_amount")
def q_high_amount(spark, sf_dir):
    e = _e(spark, sf_dir)
    return e.filter(C.high_amount("amount", E_HIGH_THRESHOLD)).select("transaction_id", "card_hash", "ts_event")


@register("fraud_reasons")
def q_fraud_reasons(spark, sf_dir):
    rules = ("high_amount", "velocity", "cross_border", "decline_rate")
    flags = R.event_flags(_e(spark, sf_dir), rules, R.RuleParams(high_threshold=E_HIGH_THRESHOLD))
    return R.reasons(flags, rules).select("transaction_id", "reason")


# --- card state, history ---------------------------------------------------

STATE_SPLIT_TS = "2024-01-16 00:00:00"


@register("card_state_last10")
def q_card_state_last10(spark, sf_dir):
    state = S.merge_state(None, _e(spark, sf_dir), with_clock=False)
    return S.explode_state(state)


@register("card_state_merge")
def q_card_state_merge(spark, sf_dir):
    e = _e(spark, sf_dir)
    cut = F.lit(STATE_SPLIT_TS).cast("timestamp_ntz")
    first = S.merge_state(None, e.filter(F.col("ts_event") < cut), with_clock=False)
    second = S.merge_state(first, e.filter(F.col("ts_event") >= cut), with_clock=False)
    return S.explode_state(second)


@register("merchant_scd2")
def q_merchant_scd2(spark, sf_dir):
    tx = _s(spark, sf_dir, columns=MERCHANT_COLS)
    # hot merchants are found on the raw feed (a plain column scan): its
    # counts per merchant bound those after deduplication
    raw = feeds.line_payments(spark, sf_dir).select("merchant_id")
    return H.versions(tx, "merchant_id", ["mcc"], hot_source=raw)


@register("merchant_scd2_incremental")
def q_merchant_scd2_incremental(spark, sf_dir):
    """History up to a day, then two later snapshots: each closes and appends versions."""
    from .session import scratch_path

    path = scratch_path(spark, "scd2-input")
    tx = _s(spark, sf_dir, columns=MERCHANT_COLS)
    part = sum((F.coalesce(F.col("ts_event") >= F.lit(d).cast("timestamp_ntz"), F.lit(False)).cast("int")
                for d in ("1995-01-01", "1997-01-01")), F.lit(0))
    tx.withColumn("part", part).write.partitionBy("part").parquet(path)  # as three loads
    parts = spark.read.parquet(path)
    loads = [parts.filter(F.col("part") == k).drop("part") for k in range(3)]
    history = H._staged(H.versions(loads[0], "merchant_id", ["mcc"]))
    current, closed = history.filter("is_current"), [history.filter("NOT is_current")]
    for load in loads[1:]:
        current, more = H.close_and_append(current, load, "merchant_id", ["mcc"])
        closed.append(more)
    out = current
    for rows in closed:
        out = out.unionByName(rows)
    return out


# --- upserts ----------------------------------------------------------------

# An incremental load: the table holds the first copy of every transaction
# shipped before TARGET_BEFORE; the new batch carries every copy shipped from
# SOURCE_FROM on (overlapping a year of existing keys).
TARGET_BEFORE = "1998-04-01"
SOURCE_FROM = "1997-01-01"


def _fact_rows(df, keep_seq=False):
    return df.select(
        "transaction_id",
        "ts_event",
        C.event_date("ts_event").alias("date_id"),
        "card_hash",
        "merchant_id",
        "amount",
        "currency",
        "auth_result",
        *(["seq"] if keep_seq else []),
    )


def _load_pair(spark, sf_dir, card=True):
    """(current fact table, incoming batch with its ``seq`` tie-break)."""
    base = feeds.line_payments(spark, sf_dir)
    lo = F.lit(SOURCE_FROM).cast("timestamp_ntz")
    hi = F.lit(TARGET_BEFORE).cast("timestamp_ntz")
    first = keep_earliest(base.filter(F.col("ts_event") < hi), ["transaction_id"], list(silver.LINE_ORDER))
    target = _fact_rows(feeds.enrich_payments(spark, sf_dir, first, card, mcc=False, location=False))
    incoming = feeds.enrich_payments(spark, sf_dir, base.filter(F.col("ts_event") >= lo), card, mcc=False, location=False)
    return target, _fact_rows(incoming, keep_seq=True)


@register("upsert_transactions")
def q_upsert_transactions(spark, sf_dir):
    target, source = _load_pair(spark, sf_dir)
    return U.upsert(target, source, ["transaction_id"], order=list(silver.LINE_ORDER))


@register("insert_if_absent")
def q_insert_if_absent(spark, sf_dir):
    target, source = _load_pair(spark, sf_dir)
    return U.insert_if_absent(target, source, ["transaction_id"], order=list(silver.LINE_ORDER), latest=False)


@register("upsert_settlement")
def q_upsert_settlement(spark, sf_dir):
    target, source = _load_pair(spark, sf_dir, card=False)  # settlement needs no lookup
    src_tx = U.collapse_source(source, ["transaction_id"], list(silver.LINE_ORDER)).drop("seq")
    return U.upsert(marts.settlement_daily(target), marts.settlement_daily(src_tx), SCH.GOLD_KEYS["fact_settlement_daily"])


# --- messages, validation, routing ------------------------------------------

E_PARAMS = R.RuleParams(high_threshold=E_HIGH_THRESHOLD)


def _cards(spark, sf_dir):
    """Card column of the source table: bounds the per-card counts of the
    decoded messages, and is a plain column scan (hot-key detection)."""
    return _e(spark, sf_dir).select("card_hash")


@register("validate_route")
def q_validate_route(spark, sf_dir):
    typed = M.typed(M.decode(M.event_messages(spark, sf_dir)))
    return SCR.screen(typed, E_PARAMS, hot_source=_cards(spark, sf_dir)).select("transaction_id", "route", "reason")


@register("ts_normalize")
def q_ts_normalize(spark, sf_dir):
    e = _e(spark, sf_dir).select("transaction_id", F.date_format("ts_event", M.ISO_MICROS).alias("ts_text"))
    parsed = C.parse_event_time("ts_text")
    return e.select(
        "transaction_id",
        "ts_text",
        F.unix_millis(parsed).alias("epoch_ms"),
        C.utc_iso_text(C.millis(parsed)).alias("iso_ms"),
    )


# --- data quality -----------------------------------------------------------


@register("quality_not_null")
def q_quality_not_null(spark, sf_dir):
    """Account events carry no amount: those messages violate the check."""
    typed = M.typed(M.decode(M.event_messages(spark, sf_dir)))
    return Q.not_null(typed.select("transaction_id", "amount"), "amount")


@register("quality_unique")
def q_quality_unique(spark, sf_dir):
    return Q.unique(feeds.line_payments(spark, sf_dir), "transaction_id")


@register("quality_relationships")
def q_quality_relationships(spark, sf_dir):
    """Payments whose merchant is not on the list: most are orphans."""
    child = _e(spark, sf_dir).select("transaction_id", "merchant_id")
    return Q.relationships(child, "merchant_id", feeds.supplier_blacklist(spark, sf_dir), "merchant_id")


@register("quality_non_negative")
def q_quality_non_negative(spark, sf_dir):
    """Suppliers in debt violate the check."""
    from .sources.tables import read_table

    return Q.non_negative(read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal"), "s_acctbal")


def gold_checks() -> list:
    K = Q.Check
    return [
        K("stg_tx_not_null", "stg_payments", "transaction_id", "not_null"),
        K("dim_merchant_not_null", "dim_merchant", "merchant_id", "not_null"),
        K("dim_merchant_unique", "dim_merchant", "merchant_id", "unique"),
        K("dim_card_not_null", "dim_card", "card_hash", "not_null"),
        K("dim_card_unique", "dim_card", "card_hash", "unique"),
        K("fact_tx_not_null", "fact_transactions", "transaction_id", "not_null"),
        K("fact_tx_unique", "fact_transactions", "transaction_id", "unique"),
        K("fact_merchant_fk", "fact_transactions", "merchant_id", "relationships", "dim_merchant", "merchant_id"),
        K("fact_card_fk", "fact_transactions", "card_hash", "relationships", "dim_card", "card_hash"),
        K("fact_amount_non_negative", "fact_transactions", "amount", "expression", condition="amount >= 0"),
        K("settlement_merchant_not_null", "settlement_daily", "merchant_id", "not_null"),
        K("settlement_dt_not_null", "settlement_daily", "dt", "not_null"),
    ]


@register("quality_suite")
def q_quality_suite(spark, sf_dir):
    # The marts as the mart models define them, over the undeduplicated
    # staging feed (so the unique tests have something to find).
    from .session import scratch_path

    # every check reads the staged feed: it is built once
    path = scratch_path(spark, "quality-stg")
    stg = feeds.lineitem_payments(spark, sf_dir, location=False)
    stg.write.parquet(path)
    stg = spark.read.schema(stg.schema).parquet(path)
    tables = {
        "stg_payments": stg,
        "dim_merchant": marts.dim_merchant_pairs(stg),
        "dim_card": marts.dim_card(stg),
        "fact_transactions": stg,
        "settlement_daily": marts.settlement_daily(stg),
    }
    return Q.suite(tables, gold_checks())


# --- reports -----------------------------------------------------------------


@register("report_settlement")
def q_report_settlement(spark, sf_dir):
    return RP.settlement_report(marts.settlement_daily(_s(spark, sf_dir, columns=SETTLE_COLS)))


@register("report_fraud")
def q_report_fraud(spark, sf_dir):
    typed = M.typed(M.decode(M.event_messages(spark, sf_dir)))
    routed = SCR.screen(typed, E_PARAMS, hot_source=_cards(spark, sf_dir)).filter(F.col("route") == SCR.ROUTE_FLAGGED)
    return RP.fraud_report(routed.withColumn("ts_event", F.col("ts_text")))


@register("report_totals")
def q_report_totals(spark, sf_dir):
    return RP.totals_report(_s(spark, sf_dir, columns=SETTLE_COLS))


# --- streaming ----------------------------------------------------------------


@register("stream_screening")
def q_stream_screening(spark, sf_dir):
    from .session import scratch_path
    from .streaming import runner, screening_job

    layout = screening_job.StreamLayout(scratch_path(spark, "stream-screening"))
    msgs = M.event_messages_with_time(spark, sf_dir)
    runner.replay(spark, msgs, layout, chunks=3, params=E_PARAMS)
    return screening_job.routes(spark, layout)


STREAM_DAY = R.RuleParams(high_threshold=E_HIGH_THRESHOLD, velocity_window_s=86_400)


@register("stream_contents")
def q_stream_contents(spark, sf_dir):
    """K1-K4 after a replay of messages with faults: what Bronze, the dead letters, the signals
    and the card state hold, one row per record, its fields joined."""
    from .session import scratch_path
    from .streaming import runner, screening_job as J

    layout = J.StreamLayout(scratch_path(spark, "stream-contents"))
    runner.replay(spark, M.faulty_messages(spark, sf_dir), layout, chunks=3, params=STREAM_DAY)
    out = J.read_outputs(spark, layout)
    text = lambda *cols: F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in cols])
    time = C.utc_iso_text("ts_event").alias("ts_event")
    fields = ["transaction_id", "card_hash", "merchant_id", "amount", "currency", "auth_result", "location"]
    accepted = out["bronze"].select(time, *fields, "date", "route").select(
        F.lit("accepted").alias("kind"), text("ts_event", *fields, "date").alias("fields")
    )
    letters = J.dead_letters(spark, layout).select(
        F.col("route").alias("kind"), text("ts_event", *fields, "reason", "raw_value").alias("fields")
    )
    signals = out["signals"].select(time, *fields, "reason").select(
        F.lit("signal").alias("kind"), text("ts_event", *fields, "reason").alias("fields")
    )
    state = S.explode_state(J.card_state(spark, layout)).withColumn("ts", C.utc_iso_text("ts"))
    cards = state.select(F.lit("card").alias("kind"), text("card_hash", "pos", "ts", "auth_result", "country").alias("fields"))
    return accepted.unionByName(letters).unionByName(signals).unionByName(cards)


MESSAGE_CHECKS = [
    Q.Check("transaction_id_not_null", "messages", "transaction_id", "not_null"),
    Q.Check("ts_event_not_null", "messages", "ts_event", "not_null"),
    Q.Check("card_hash_not_null", "messages", "card_hash", "not_null"),
    Q.Check("amount_not_null", "messages", "amount", "not_null"),
    Q.Check("amount_non_negative", "messages", "amount", "expression", condition="amount >= 0"),
    Q.Check("well_formed", "messages", "malformed", "expression", condition="NOT malformed"),
    Q.Check("required_fields", "messages", "valid", "expression", condition="valid"),
]


@register("stream_quality")
def q_stream_quality(spark, sf_dir):
    """Q1/Q4/Q6 counted on the stream's way over restarts, read from its progress."""
    from .session import scratch_path
    from .streaming import runner

    def transform(stream):
        sent = stream.filter(F.col("value").isNotNull())  # the closing marker has no text
        return Q.observed_stream(M.typed(M.decode(sent)), MESSAGE_CHECKS)

    metrics: dict[str, int] = {}
    runner.run_in_order(spark, M.faulty_messages(spark, sf_dir), transform, scratch_path(spark, "stream-quality"), metrics=metrics)
    return spark.createDataFrame(sorted(metrics.items()), "check_name string, violations long")


@register("signals_bucketed")
def q_signals_bucketed(spark, sf_dir):
    """The signals into a bucketed table, then again on another day and without an id."""
    from .operators import bucketed as B
    from .session import scratch_path

    typed = M.typed(M.decode(M.event_messages(spark, sf_dir)))
    routed = SCR.screen(typed, E_PARAMS, hot_source=_cards(spark, sf_dir)).filter(F.col("route") == SCR.ROUTE_FLAGGED)
    path = scratch_path(spark, "signals-bucketed")
    types = {"ts_event": "TIMESTAMP", "amount": "DECIMAL(18,2)"}
    columns = [c for c in SCH.GOLD_COLUMNS["fact_fraud_signals"] if c != "created_at"]
    ddl = ", ".join(f"{c} {types.get(c, 'STRING')}" for c in columns)
    name = B.create_bucketed(spark, "q_signals_" + path.rsplit("-", 1)[1], f"{path}/table", ddl, "transaction_id", 16)
    routed.select(*columns).write.parquet(f"{path}/first")
    first = spark.read.parquet(f"{path}/first")
    again = first.withColumn("ts_event", F.col("ts_event") + F.expr("INTERVAL 3 DAYS")).withColumn("reason", F.lit("resent"))
    B.insert_absent(spark, name, first, "transaction_id", ["ts_event"])
    B.insert_absent(spark, name, again.unionByName(again.withColumn("transaction_id", F.lit(None).cast("string"))), "transaction_id")
    return spark.table(name).withColumn("ts_event", C.utc_iso_text("ts_event"))


def _in_order(spark, df, name, transform, **options):
    """Feed a derived table to a streaming operator in five restarts; all windows are closed."""
    from .session import scratch_path
    from .streaming import runner, windows

    rows = df.withColumn("ts_event", windows.to_instant("ts_event"))
    return runner.run_in_order(spark, rows, transform, scratch_path(spark, name), **options)[0]


@register("stream_dedup")
def q_stream_dedup(spark, sf_dir):
    """Every event is delivered again four minutes later, within the watermark's ten."""
    from .streaming import windows

    e = _e(spark, sf_dir).select("transaction_id", "ts_event", "card_hash")
    first = e.withColumn("arrived", F.col("ts_event"))
    again = e.withColumn("arrived", F.col("ts_event") + F.expr("INTERVAL 4 MINUTES"))
    # Which copy of a repeated id survives is arrival order; the set of ids is
    # defined, so that is what the query returns.
    out = _in_order(spark, first.unionByName(again), "stream-dedup", windows.dedup_stream, arrival="arrived")
    # the closing marker has no id
    return out.filter(F.col("transaction_id").isNotNull()).select("transaction_id")


@register("stream_velocity_window")
def q_stream_velocity_window(spark, sf_dir):
    from .streaming import windows

    rows = _e(spark, sf_dir).select("transaction_id", "ts_event", "card_hash")
    out = _in_order(spark, rows, "stream-velocity", windows.velocity_windows)
    return out.select("card_hash", C.utc_iso_text("window_start").alias("window_start"), "n")


@register("stream_velocity_sliding")
def q_stream_velocity_sliding(spark, sf_dir):
    from .streaming import windows

    rows = _e(spark, sf_dir).select("transaction_id", "ts_event", "card_hash")
    sliding = lambda s: windows.velocity_windows(s, "1 minute", "30 seconds")
    out = _in_order(spark, rows, "stream-velocity-sliding", sliding)
    return out.select("card_hash", C.utc_iso_text("window_start").alias("window_start"), "n")


@register("stream_settlement")
def q_stream_settlement(spark, sf_dir):
    from .streaming import windows

    rows = feeds.line_payments(spark, sf_dir).select("ts_event", "merchant_id", "currency", "amount")
    out = _in_order(spark, rows, "stream-settlement", windows.settlement_windows)
    return out.select(
        "merchant_id",
        "currency",
        F.to_date(F.substring(C.utc_iso_text("window_start"), 1, 10)).alias("dt"),
        "txn_count",
        "gross_amount",
        "fees",
        "net_amount",
    )


@register("stream_cross_border_join")
def q_stream_cross_border_join(spark, sf_dir):
    """Every event arrives up to four minutes late, within the watermark's ten; the hits, each once."""
    from .streaming import joins

    e = _e(spark, sf_dir).select("transaction_id", "ts_event", "card_hash", "location")
    late = F.make_dt_interval(mins=F.pmod(F.xxhash64("transaction_id"), F.lit(5)).cast("int"))
    rows = e.withColumn("arrived", F.col("ts_event") + late)
    out = _in_order(
        spark, rows, "stream-cross-border", lambda s: joins.cross_border_events(s, salts=2), arrival="arrived"
    )
    return out.select("transaction_id", "card_hash", C.utc_iso_text("ts_event").alias("ts_event"))


@register("stream_card_state")
def q_stream_card_state(spark, sf_dir):
    """The last ten events of every card, kept in the state store over five restarts."""
    from .streaming import card_state

    e = _e(spark, sf_dir).select("transaction_id", "ts_event", "card_hash", "auth_result", "location")
    out = _in_order(spark, e, "stream-card-state", card_state.card_state_versions)
    return S.explode_state(card_state.current(out))


# --- the hot-key split forced on every key (same results as the plain form) --

BUCKETED = R.RuleParams(high_threshold=E_HIGH_THRESHOLD, bucket_seconds=3_600)


@register("fraud_reasons_bucketed")
def q_fraud_reasons_bucketed(spark, sf_dir):
    rules = ("high_amount", "velocity", "cross_border", "decline_rate")
    flags = R.event_flags(_e(spark, sf_dir), rules, BUCKETED, split="always")
    return R.reasons(flags, rules).select("transaction_id", "reason")


@register("cross_border_prev_bucketed")
def q_cross_border_prev_bucketed(spark, sf_dir):
    flags = R.event_flags(_e(spark, sf_dir), ("cross_border_prev",), BUCKETED, split="always")
    return _flagged(flags, "cross_border_prev")


@register("cross_border_selfjoin_bucketed")
def q_cross_border_selfjoin_bucketed(spark, sf_dir):
    flags = R.event_flags(_e(spark, sf_dir), ("cross_border_pair",), BUCKETED, split="always")
    return _flagged(flags, "cross_border_pair")


@register("merchant_scd2_bucketed")
def q_merchant_scd2_bucketed(spark, sf_dir):
    tx = _s(spark, sf_dir, columns=MERCHANT_COLS)
    return H.versions(tx, "merchant_id", ["mcc"], bucket_seconds=30 * 86_400, split="always")


# --- Gold loads, read back -----------------------------------------------------

# Load 1 holds what was shipped before LOAD_TO; load 2 what was shipped from
# LOAD_FROM on, with the amounts of the overlap raised by one, the last line of
# an order without a time, and line 6 without an id.
LOAD_TO = "1996-07-01"
LOAD_FROM = "1996-01-01"


def _two_loads(spark, sf_dir):
    from .session import scratch_path

    # every load reads Silver, the later one twice: it is deduplicated once
    path = scratch_path(spark, "gold-silver")
    tx = _s(spark, sf_dir, columns=FACT_COLS)
    tx.write.parquet(path)
    tx = spark.read.schema(tx.schema).parquet(path)
    to, since = (F.lit(d).cast("timestamp_ntz") for d in (LOAD_TO, LOAD_FROM))
    line = F.substring_index("transaction_id", "-", -1)
    later = (
        tx.filter(F.col("ts_event") >= since)
        .withColumn("amount", F.when(F.col("ts_event") < to, F.col("amount") + 1).otherwise(F.col("amount")).cast("decimal(18,2)"))
        .withColumn("ts_event", F.when(line != "7", F.col("ts_event")))
        .withColumn("transaction_id", F.when(line != "6", F.col("transaction_id")))
    )
    first = tx.filter(F.col("ts_event") < to).withColumn("ts_event", F.when(line != "5", F.col("ts_event")))
    return first, later.unionByName(later.filter(line == "4"))


@register("gold_load_facts")
def q_gold_load_facts(spark, sf_dir):
    """Two overlapping loads through the Gold log, read back through the named tables."""
    from .session import scratch_path

    base = scratch_path(spark, "gold-facts")
    for load in _two_loads(spark, sf_dir):
        gold.add_rows(spark, base, "fact_transactions", gold.fact_transactions_rows(gold.stage(load)))
    gold.create_tables(spark, base, "q_gold_load_facts_")
    facts = spark.table("q_gold_load_facts_fact_transactions")
    return facts.select("transaction_id", "date_id", "card_hash", "merchant_id", "amount", "currency", "auth_result")


# The ranged load: everything shipped before LOAD_TO, then Silver's days of a summer in
# which line 3 of every order has moved forty days on (partly past the range).
RANGE = ("1996-06-01", "1996-08-31")


def _ranged_gold(spark, sf_dir):
    from .session import scratch_path

    base = scratch_path(spark, "gold-ranged")
    tx = _s(spark, sf_dir, columns=FACT_COLS)
    lo, hi, to = (F.lit(d).cast("timestamp_ntz") for d in (RANGE[0], "1996-09-01", LOAD_TO))
    moved = F.when(F.substring_index("transaction_id", "-", -1) == "3", F.col("ts_event") + F.expr("INTERVAL 40 DAYS"))
    later = tx.filter((F.col("ts_event") >= lo) & (F.col("ts_event") < hi)).withColumn(
        "ts_event", F.coalesce(moved, "ts_event")
    )
    for load in (tx.filter(F.col("ts_event") < to), later):
        gold.add_rows(spark, base, "fact_transactions", gold.fact_transactions_rows(gold.stage(load)))
        gold.refresh_settlement(spark, base)
    gold.create_tables(spark, base, "q_gold_ranged_")


@register("gold_load_ranged")
def q_gold_load_ranged(spark, sf_dir):
    """Facts after a ranged load with moved days: one day's partition per row, read by name."""
    _ranged_gold(spark, sf_dir)
    facts = spark.table("q_gold_ranged_fact_transactions")
    return facts.select("transaction_id", "date_id", "card_hash", "merchant_id", "amount", "currency", "auth_result")


@register("gold_settlement_incremental")
def q_gold_settlement_incremental(spark, sf_dir):
    """U4/A1 kept up from the days that the loads touched: equal to A1 over all facts."""
    _ranged_gold(spark, sf_dir)
    return spark.table("q_gold_ranged_fact_settlement_daily")


@register("gold_load_signals")
def q_gold_load_signals(spark, sf_dir):
    """The stream's signals in Gold, re-sent on another day and without an id: the first stays."""
    from .session import scratch_path

    base = scratch_path(spark, "gold-signals")
    typed = M.typed(M.decode(M.event_messages(spark, sf_dir)))
    routed = SCR.screen(typed, E_PARAMS, hot_source=_cards(spark, sf_dir)).filter(F.col("route") == SCR.ROUTE_FLAGGED)
    signals = routed.withColumn("created_at", F.lit(None).cast("timestamp"))
    gold.load_signals(spark, signals, base)
    again = signals.withColumn("ts_event", F.col("ts_event") + F.expr("INTERVAL 3 DAYS")).withColumn("reason", F.lit("resent"))
    gold.load_signals(spark, again.unionByName(again.withColumn("transaction_id", F.lit(None).cast("string"))), base)
    return RP.fraud_report(gold.read_gold(spark, base, "fact_fraud_signals")).withColumn(
        "ts_event", C.utc_iso_text("ts_event")
    )
