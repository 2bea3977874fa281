"""Metamorphic checks: input order, duplication and repetition do not change results."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from ledgerlake.functions import rules as R
from ledgerlake.operators import upsert as U
from ledgerlake.plans import marts, silver
from ledgerlake.sources import feeds


def _rows(df):
    return sorted(repr(tuple(r)) for r in df.collect())


def test_silver_ignores_order_and_duplicates(spark):
    base = feeds.line_payments(spark, SF_SMALL)
    ref = _rows(silver.dedup_latest(base, silver.LINE_ORDER))
    shuffled = base.repartition(7).orderBy(F.rand(seed=3))
    assert _rows(silver.dedup_latest(shuffled, silver.LINE_ORDER)) == ref
    doubled = base.unionByName(base)
    assert _rows(silver.dedup_latest(doubled, silver.LINE_ORDER)) == ref


def test_rules_ignore_input_order(spark):
    e = feeds.event_payments(spark, SF_SMALL)
    rules = ("high_amount", "velocity", "cross_border", "decline_rate", "cross_border_prev")
    a = R.event_flags(e, rules).select("transaction_id", *rules)
    b = R.event_flags(e.repartition(5).orderBy(F.rand(seed=7)), rules).select("transaction_id", *rules)
    assert _rows(a) == _rows(b)


def test_upsert_twice_is_once(spark):
    s = silver.silver_payments(spark, SF_SMALL, columns=["transaction_id", "ts_event", "merchant_id", "amount", "currency"])
    target = s.filter("ts_event < TIMESTAMP_NTZ'1998-01-01 00:00:00'")
    source = s.filter("ts_event >= TIMESTAMP_NTZ'1997-06-01 00:00:00'").withColumn("amount", F.col("amount") + 1)
    once = U.upsert(target, source, ["transaction_id"])
    assert _rows(U.upsert(once, source, ["transaction_id"])) == _rows(once)
    assert once.count() == s.count()


def test_settlement_is_additive_over_days(spark):
    s = silver.silver_payments(spark, SF_SMALL, columns=["merchant_id", "currency", "ts_event", "amount"])
    whole = marts.settlement_daily(s)
    cut = "ts_event < TIMESTAMP_NTZ'1997-01-01 00:00:00'"
    parts = marts.settlement_daily(s.filter(cut)).unionByName(marts.settlement_daily(s.filter(f"NOT ({cut})")))
    assert _rows(whole) == _rows(parts)
