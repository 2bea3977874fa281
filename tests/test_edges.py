"""Edge rows of FIXTURES.md section 4."""

from decimal import Decimal

from helpers import at, flags_by_id, payments

from ledgerlake.functions import columns as C
from ledgerlake.functions import rules as R
from ledgerlake.operators import quality as Q
from ledgerlake.operators.dedup import keep_latest
from ledgerlake.plans import marts
from ledgerlake.plans.screening import screen
from ledgerlake.sources import messages as M


def _route(spark, values):
    msgs = spark.createDataFrame([(v,) for v in values], "value string")
    out = screen(M.typed(M.decode(msgs))).collect()
    return [((r.transaction_id, str(r.amount), r.raw_value), r.route, r.reason) for r in out]


def test_message_routing(spark):
    good = '{"transaction_id":"A","ts_event":"2025-01-01T00:00:00Z","card_hash":"c","amount":3}'
    text_amount = '{"transaction_id":"Y","ts_event":"2025-01-01T00:00:00Z","card_hash":"c","amount":"12.5"}'
    values = ["{bad", '{"amount":3}', '{"transaction_id":"","amount":1}', '{"transaction_id":"X"}', good, text_amount]
    got = {k: (route, reason) for k, route, reason in _route(spark, values)}
    assert got == {
        (None, "None", "{bad"): ("dead", "malformed_json"),
        (None, "3.00", values[1]): ("dead", "missing_tx_or_amount"),
        ("", "1.00", values[2]): ("dead", "missing_tx_or_amount"),
        ("X", "None", values[3]): ("dead", "missing_tx_or_amount"),
        ("A", "3.00", good): ("accepted", ""),
        ("Y", "12.50", text_amount): ("accepted", ""),
    }


def test_amount_edges(spark):
    df = payments(spark, [{"amount": "0"}, {"amount": "-5"}, {"amount": None}, {"amount": "10000"}])
    b = {r.transaction_id: r.amount_bucket for r in marts.amount_buckets(df).collect()}
    assert b == {"T0000": "<10", "T0001": "<10", "T0002": "10000+", "T0003": "10000+"}
    assert [r.transaction_id for r in Q.non_negative(df).collect()] == ["T0001"]
    assert not any(flags_by_id(R.event_flags(df, ("high_amount",)), "high_amount").values())


def test_bad_time_and_locations(spark):
    df = payments(spark, [
        {"ts_event": "oops", "location": None},
        {"ts_event": at(0), "location": ""},
        {"ts_event": at(1), "location": "Unknown"},
        {"ts_event": at(2), "location": "A, B, C "},
        {"ts_event": at(3), "location": "New York,"},
    ])
    got = {r.transaction_id: (r.ts_event, r.c) for r in df.select("*", C.country_from_location("location").alias("c")).collect()}
    assert got["T0000"] == (None, None)
    assert [got[f"T000{i}"][1] for i in range(1, 5)] == [None, "Unknown", "C", ""]
    f = {r.transaction_id: r.cross_border for r in R.event_flags(df, ("cross_border",)).collect()}
    # no time, no country and empty country take no part; "Unknown" is a country
    assert f == {"T0000": False, "T0001": False, "T0002": False, "T0003": True, "T0004": False}


def test_window_edges_inclusive(spark):
    rows = [
        {"card_hash": "x", "ts_event": at(0), "location": "a, US"},
        {"card_hash": "x", "ts_event": at(10), "location": "a, DE"},  # exactly 600 s later
    ]
    five = [{"card_hash": "v5", "ts_event": at(i / 4)} for i in range(5)]  # 5 in 60 s
    six = [{"card_hash": "v6", "ts_event": at(i / 5)} for i in range(6)]  # 6 within 60 s inclusive
    df = payments(spark, rows + five + six)
    f = R.event_flags(df, ("velocity", "cross_border"))
    cb = {r.transaction_id: r.cross_border for r in f.filter("card_hash = 'x'").collect()}
    assert cb == {"T0000": False, "T0001": True}
    vel = {r.card_hash for r in f.filter("velocity").collect()}
    assert vel == {"v6"}


def test_null_card_only_high_amount(spark):
    df = payments(spark, [{"card_hash": None, "amount": "20000", "ts_event": at(i / 10), "auth_result": "DECLINED"} for i in range(7)])
    f = R.event_flags(df, R.ALL_RULES).collect()
    assert all(r.high_amount for r in f)
    assert not any(r.velocity or r.cross_border or r.decline_rate or r.cross_border_prev for r in f)


def test_v2_and_v4_differ(spark):
    rows = [
        {"card_hash": "k", "ts_event": at(0), "location": "a, US"},
        {"card_hash": "k", "ts_event": at(2), "location": "a, US"},
        {"card_hash": "k", "ts_event": at(5), "location": "a, DE"},
        {"card_hash": "k", "ts_event": at(6), "location": "a, DE"},
    ]
    f = R.event_flags(payments(spark, rows), ("cross_border", "cross_border_prev"))
    got = {r.transaction_id: (r.cross_border, r.cross_border_prev) for r in f.collect()}
    assert got == {"T0000": (False, False), "T0001": (False, False), "T0002": (True, True), "T0003": (True, False)}


def test_velocity_as_coded_vs_documented(spark):
    rows = [{"card_hash": "h", "ts_event": at(i * 12)} for i in range(6)]  # six events over an hour
    df = payments(spark, rows)
    assert not any(flags_by_id(R.event_flags(df, ("velocity",)), "velocity").values())
    assert all(flags_by_id(R.velocity_as_coded(df), "velocity").values())


def test_duplicate_id_equal_times(spark):
    df = payments(spark, [
        {"transaction_id": "D", "ts_event": at(0), "amount": "1.00"},
        {"transaction_id": "D", "ts_event": at(0), "amount": "2.00"},
    ])
    out = keep_latest(df, ["transaction_id"], ["ts_event"]).collect()
    assert len(out) == 1 and out[0].amount == Decimal("2.00")
    again = keep_latest(df.orderBy("amount"), ["transaction_id"], ["ts_event"]).collect()
    assert again == out


def test_blacklist_repeats_do_not_grow_rows(spark):
    df = payments(spark, [{"merchant_id": "M9"}, {"merchant_id": "M1"}])
    bl = spark.createDataFrame([("M9", "a"), ("M9", "b")], "merchant_id string, reason string")
    facts = marts.fact_transactions(df, bl)
    assert facts.count() == 2
    assert flags_by_id(facts, "flag_blacklisted") == {"T0000": True, "T0001": False}
