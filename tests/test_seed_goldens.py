"""Goldens of the seed rows in tests/data, worked out by hand from the rules."""

from decimal import Decimal as D

from ledgerlake.functions import rules as R
from ledgerlake.plans import marts


def test_settlement(seed):
    got = {
        (r.merchant_id, r.currency, str(r.dt)): (r.txn_count, r.gross_amount, r.fees, r.net_amount)
        for r in marts.settlement_daily(seed).collect()
    }
    assert got == {
        (None, "USD", "2026-03-03"): (1, D("64.00"), D("1.2800"), D("62.7200")),
        ("M20010", "GBP", "2026-03-02"): (2, D("20.35"), D("0.4070"), D("19.9430")),
        ("M20011", "EUR", "2026-03-02"): (1, D("48.00"), D("0.9600"), D("47.0400")),
        ("M20012", "USD", "2026-03-02"): (1, D("12000.01"), D("240.0002"), D("11760.0098")),
        ("M20013", "EUR", "2026-03-02"): (6, D("46.00"), D("0.9200"), D("45.0800")),
        ("M20014", "EUR", "2026-03-02"): (3, D("453.00"), D("9.0600"), D("443.9400")),
        ("M20015", "USD", "None"): (1, D("20.00"), D("0.4000"), D("19.6000")),
        ("M20015", "USD", "2026-03-02"): (1, D("55.00"), D("1.1000"), D("53.9000")),
        ("M20016", "USD", "2026-03-02"): (1, D("33.30"), D("0.6660"), D("32.6340")),
        # the row with the unreadable amount counts, its amount does not
        ("M20016", "USD", "2026-03-03"): (2, D("33.30"), D("0.6660"), D("32.6340")),
        ("M20666", "USD", "2026-03-02"): (1, D("310.00"), D("6.2000"), D("303.8000")),
    }


def test_buckets_dims_and_flags(seed, blacklist):
    facts = marts.fact_transactions(seed, blacklist)
    buckets = {r.amount_bucket: r["count"] for r in marts.amount_buckets(facts).groupBy("amount_bucket").count().collect()}
    # a NULL amount falls through all bounds into the last bucket
    assert buckets == {"<10": 6, "10-99": 8, "100-999": 4, "10000+": 2}
    assert marts.dim_card(seed).count() == 6
    assert marts.dim_merchant(seed).count() == 8
    assert marts.dim_date(seed).count() == 2
    signals = {r.transaction_id: (r.flag_high_amount, r.flag_blacklisted) for r in marts.fact_fraud_signals(facts).collect()}
    assert signals == {"P-04": (True, False), "P-05": (False, True)}
    assert facts.count() == 20


def test_event_rules(seed):
    f = R.event_flags(seed, R.ALL_RULES).collect()
    hit = lambda c: sorted(r.transaction_id for r in f if r[c])
    assert hit("high_amount") == ["P-04"]
    assert hit("velocity") == ["P-11"]  # the sixth within a minute
    assert hit("cross_border") == hit("cross_border_prev") == ["P-03"]
    assert hit("cross_border_pair") == ["P-01", "P-02", "P-03"]
    assert hit("decline_rate") == ["P-12", "P-14"]  # one of one, two of three; one of two is not above half


def test_card_scope(seed):
    rules = ("high_amount", "cross_border", "decline_rate")
    want = {f"P-{i:02d}": "" for i in range(1, 20)} | {"P-04": "high_amount"}
    want |= {f"P-{i:02d}": "cross_border" for i in (1, 2, 3)}
    want |= {f"P-{i:02d}": "velocity" for i in range(6, 12)}
    want |= {f"P-{i:02d}": "decline_rate" for i in (12, 13, 14)}
    flags = R.card_scope(R.event_flags(seed, rules), ("cross_border", "decline_rate"))
    coded = R.reasons(R.velocity_as_coded(flags), rules + ("velocity",)).collect()
    assert {r.transaction_id: r.reason for r in coded} == want
    documented = R.card_scope(R.event_flags(seed, rules + ("velocity",)), ("velocity", "cross_border", "decline_rate"))
    assert {r.transaction_id: r.reason for r in R.reasons(documented, rules + ("velocity",)).collect()} == want
