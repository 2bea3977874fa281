"""Small DataFrame builders for table-driven tests."""

from __future__ import annotations

from ledgerlake.plans.marts import stg_payments
from ledgerlake.schemas import RAW_EVENT, RAW_FIELDS

DEFAULTS = {
    "card_hash": "card1",
    "merchant_id": "M1",
    "amount": "10.00",
    "currency": "USD",
    "mcc": "5411",
    "channel": "POS",
    "auth_result": "APPROVED",
    "location": "City, US",
}


def payments(spark, rows):
    """Typed payments from dicts of text values (missing keys -> defaults)."""
    data = []
    for i, r in enumerate(rows):
        full = {"transaction_id": f"T{i:04d}", "ts_event": None, **DEFAULTS, **r}
        data.append(tuple(full.get(f) for f in RAW_FIELDS))
    return stg_payments(spark.createDataFrame(data, RAW_EVENT)).drop("event_date")


def at(minute: float, base: str = "2025-01-01T00:00:00") -> str:
    """ISO text ``minute`` minutes after ``base`` (seconds resolution)."""
    import datetime as dt

    t = dt.datetime.fromisoformat(base) + dt.timedelta(seconds=round(minute * 60))
    return t.isoformat() + "Z"


def flags_by_id(df, col):
    return {r["transaction_id"]: r[col] for r in df.select("transaction_id", col).collect()}
