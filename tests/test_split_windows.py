"""The hot-key split gives the same flags as the plain per-card window."""

import pytest
from conftest import SF_SMALL
from helpers import at, payments

from ledgerlake.functions import rules as R
from ledgerlake.operators import scd2 as H
from ledgerlake.operators import ordered as O
from ledgerlake.sources import feeds


def _flags(df, params, split, hot_rows=O.DEFAULT_HOT_ROWS):
    out = R.event_flags(df, R.ALL_RULES, params, split=split, hot_rows=hot_rows)
    return sorted(tuple(r) for r in out.select("transaction_id", *R.ALL_RULES).collect())


@pytest.mark.parametrize("bucket", [600, 3_600, 86_400])
def test_events_split_equals_plain(spark, bucket):
    e = feeds.event_payments(spark, SF_SMALL)
    params = R.RuleParams(high_threshold="200", velocity_window_s=300, bucket_seconds=bucket)
    assert _flags(e, params, "always") == _flags(e, params, "never")


def test_hot_card_with_null_times(spark):
    # one hot card: bursts around bucket edges, NULL times, other countries
    rows = []
    for i in range(120):
        rows.append({
            "card_hash": "hot",
            "ts_event": at(i * 3.7) if i % 17 else "not a time",
            "auth_result": None if i % 11 == 0 else ("DECLINED" if i % 3 else "APPROVED"),
            "location": f"x, {'US' if (i // 4) % 3 else 'FR'}",
        })
    rows += [{"card_hash": "cold", "ts_event": at(i), "auth_result": "DECLINED"} for i in range(5)]
    df = payments(spark, rows)
    params = R.RuleParams(velocity_limit=2, velocity_window_s=300, cross_window_s=600, decline_n=4, bucket_seconds=1_800)
    plain = _flags(df, params, "never")
    assert _flags(df, params, "always") == plain
    # auto mode: only the hot card is bucketed
    assert O.hot_keys(df, "card_hash", hot_rows=50) is not None
    assert _flags(df, params, "auto", hot_rows=50) == plain
    assert O.hot_keys(df, "card_hash", hot_rows=1000) is None


def test_scd2_split_equals_plain(spark):
    rows = []
    for i in range(200):
        rows.append({"merchant_id": "Mh", "mcc": str((i // 7) % 3), "ts_event": at(i * 13)})
    rows += [{"merchant_id": "Mc", "mcc": str(i % 2), "ts_event": at(i * 50)} for i in range(9)]
    df = payments(spark, rows)
    plain = sorted(tuple(r) for r in H.versions(df, "merchant_id", ["mcc"], split="never").collect())
    split = sorted(tuple(r) for r in H.versions(df, "merchant_id", ["mcc"], bucket_seconds=3_600, split="always").collect())
    auto = sorted(tuple(r) for r in H.versions(df, "merchant_id", ["mcc"], bucket_seconds=3_600, hot_rows=100).collect())
    assert split == plain == auto
    assert sum(1 for r in plain if r[-1]) == 2  # one current version per merchant


def test_many_hot_keys_use_a_join(spark, monkeypatch):
    rows = [{"card_hash": f"k{i % 3}", "ts_event": at(i * 2.5), "auth_result": "DECLINED" if i % 2 else "APPROVED",
             "location": f"x, {'US' if i % 5 else 'DE'}"} for i in range(90)]
    df = payments(spark, rows)
    params = R.RuleParams(velocity_limit=1, velocity_window_s=300, decline_n=3, bucket_seconds=1_800)
    monkeypatch.setattr(O, "MAX_INLIST_KEYS", 1)
    hot = O.hot_keys(df, "card_hash", hot_rows=10)
    assert hot is not None and not isinstance(hot, bool) and hasattr(hot, "columns")
    assert _flags(df, params, "auto", hot_rows=10) == _flags(df, params, "never")
