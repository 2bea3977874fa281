"""Rule vectors of the reference's unit tests, as DataFrame tests."""

from helpers import at, flags_by_id, payments

from ledgerlake.functions import rules as R


def test_high_amount(spark):
    df = payments(spark, [{"amount": "15000"}, {"amount": "9999"}, {"amount": "100"}, {"amount": None}])
    got = flags_by_id(R.event_flags(df, ("high_amount",)), "high_amount")
    assert got == {"T0000": True, "T0001": False, "T0002": False, "T0003": False}


def test_velocity_limit_5(spark):
    six = [{"card_hash": "c6", "ts_event": at(i / 10)} for i in range(6)]
    three = [{"card_hash": "c3", "ts_event": at(i / 10)} for i in range(3)]
    two = [{"card_hash": "c2", "ts_event": at(i / 10)} for i in range(2)]
    df = payments(spark, six + three + two)
    got = R.event_flags(df, ("velocity",)).filter("velocity").select("card_hash").distinct().collect()
    assert [r[0] for r in got] == ["c6"]


def test_cross_border_10_minutes(spark):
    rows = [
        {"card_hash": "a", "ts_event": at(0), "location": "X, USA"},
        {"card_hash": "a", "ts_event": at(5), "location": "Y, CAN"},
        {"card_hash": "b", "ts_event": at(0), "location": "X, USA"},
        {"card_hash": "b", "ts_event": at(25), "location": "Y, CAN"},
        {"card_hash": "c", "ts_event": at(0), "location": "X, USA"},
        {"card_hash": "c", "ts_event": at(5), "location": "Y, USA"},
    ]
    got = flags_by_id(R.event_flags(payments(spark, rows), ("cross_border",)), "cross_border")
    assert [k for k, v in sorted(got.items()) if v] == ["T0001"]


def _decline_rows(card, results):
    return [{"card_hash": card, "ts_event": at(i), "auth_result": a} for i, a in enumerate(results)]


def test_decline_rate_thresholds(spark):
    df = payments(spark, _decline_rows("d", ["APPROVED", "DECLINED", "DECLINED", "DECLINED"]))
    last = "T0003"
    assert flags_by_id(R.event_flags(df, ("decline_rate",), R.RuleParams(decline_threshold="0.6")), "decline_rate")[last]
    assert not flags_by_id(R.event_flags(df, ("decline_rate",), R.RuleParams(decline_threshold="0.8")), "decline_rate")[last]


def test_decline_rate_half(spark):
    nine = payments(spark, _decline_rows("n", ["APPROVED"] + ["DECLINED"] * 9))
    assert flags_by_id(R.event_flags(nine, ("decline_rate",)), "decline_rate")["T0009"]
    low = payments(spark, _decline_rows("l", ["APPROVED", "APPROVED", "DECLINED"]))
    assert not flags_by_id(R.event_flags(low, ("decline_rate",)), "decline_rate")["T0002"]


def test_decline_rate_min_attempts(spark):
    one = payments(spark, _decline_rows("m", ["DECLINED"]))
    assert flags_by_id(R.event_flags(one, ("decline_rate",)), "decline_rate")["T0000"]
    p = R.RuleParams(decline_min_attempts=3)
    assert not flags_by_id(R.event_flags(one, ("decline_rate",), p), "decline_rate")["T0000"]
