"""Row-level Column builders (no window, no shuffle).

All are plain ``pyspark.sql.functions`` expressions, so they stay inside
whole-stage codegen and can be pushed or pruned by Catalyst.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import AMOUNT

# Fixed values of the payments domain (must equal the reference's).
DECLINED = "DECLINED"
APPROVED = "APPROVED"
HIGH_AMOUNT_THRESHOLD = "10000"
# Reason codes, in the fixed order they are joined into the reason text.
REASON_CODES = ["high_amount", "velocity", "cross_border", "decline_rate"]
# Stream-side blacklist check (documented rule, absent from the original
# stream); its code goes after the fixed ones.
BLACKLIST_CODE = "blacklisted"
DEAD_MISSING = "missing_tx_or_amount"
DEAD_MALFORMED = "malformed_json"
# Amount buckets: (label, lower bound inclusive, upper bound exclusive); the
# last label catches everything else, NULL amounts included.
AMOUNT_BUCKETS = [
    ("<10", None, "10"),
    ("10-99", "10", "100"),
    ("100-999", "100", "1000"),
    ("1000-9999", "1000", "10000"),
]
AMOUNT_BUCKET_ELSE = "10000+"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def decimal_literal(text: str) -> Column:
    """A decimal literal that keeps exact arithmetic (never a double).

    ``F.lit(0.02)`` would be a double and turn every product into a double.
    """
    text = str(text).strip()
    digits = text.lstrip("+-")
    scale = len(digits.split(".", 1)[1]) if "." in digits else 0
    precision = max(len(digits.replace(".", "")), scale + 1)
    return F.expr(f"CAST('{text}' AS DECIMAL({precision},{scale}))")


_dec = decimal_literal


def parse_event_time(c: str | Column) -> Column:
    """ISO-8601 text (``Z`` / offsets accepted) to timestamp, bad text -> NULL."""
    return F.try_to_timestamp(_col(c))


def to_amount(c: str | Column) -> Column:
    """P5: number or numeric text to decimal(18,2); bad text -> NULL."""
    return _col(c).try_cast(AMOUNT)


def country_from_location(c: str | Column) -> Column:
    """Trimmed last comma-separated part; NULL/empty location -> NULL."""
    loc = _col(c)
    return F.when(loc.isNotNull() & (loc != ""), F.trim(F.element_at(F.split(loc, ",", -1), -1)))


def event_date(c: str | Column) -> Column:
    """Calendar day of the event time."""
    return F.to_date(_col(c))


def millis(c: str | Column) -> Column:
    """Truncate a timestamp to millisecond precision."""
    return F.date_trunc("millisecond", _col(c))


def iso_text(c: str | Column, fraction: str = "SSS") -> Column:
    """ISO-8601 text with a ``Z`` suffix (session zone is UTC)."""
    return F.date_format(_col(c), f"yyyy-MM-dd'T'HH:mm:ss.{fraction}'Z'")


def utc_iso_text(c: str | Column) -> Column:
    """ISO-8601 UTC text with milliseconds and ``Z``, independent of the
    session time zone (the instant is re-based on the NTZ epoch)."""
    micros = F.unix_micros(_col(c).cast("timestamp"))
    wall = F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), (micros.cast("decimal(20,0)") / F.lit(1_000_000)).cast("decimal(18,6)")
    )
    return F.date_format(wall, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def card_fingerprint(c: str | Column = "card_hash") -> Column:
    """md5 fingerprint of the card hash."""
    return F.md5(_col(c))


def high_amount(amount: str | Column = "amount", threshold: str | float | int = HIGH_AMOUNT_THRESHOLD) -> Column:
    """P10: strictly above threshold; NULL amount -> false."""
    return F.coalesce(_col(amount) > _dec(str(threshold)), F.lit(False))


def amount_bucket(amount: str | Column = "amount") -> Column:
    """First matching bucket; NULL falls through to the last bucket."""
    a = _col(amount)
    expr = None
    for label, lo, hi in AMOUNT_BUCKETS:
        cond = a < _dec(hi) if lo is None else (a >= _dec(lo)) & (a < _dec(hi))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(AMOUNT_BUCKET_ELSE))


def reason_text(flags: dict[str, str | Column]) -> Column:
    """Comma-joined codes of the true flags, in the fixed code order."""
    parts = [F.when(_col(flags[code]), F.lit(code)) for code in [*REASON_CODES, BLACKLIST_CODE] if code in flags]
    return F.concat_ws(",", *parts)


def is_valid_event(tx: str | Column = "transaction_id", amount: str | Column = "amount") -> Column:
    """transaction id present and non-empty, amount present (never NULL)."""
    return F.coalesce(_col(tx) != "", F.lit(False)) & _col(amount).isNotNull()


def auth_declined(c: str | Column = "auth_result") -> Column:
    return _col(c) == F.lit(DECLINED)
