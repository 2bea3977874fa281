"""Screen payments and route them dead / flagged / accepted.

The same Column rules serve batch and streaming: a micro-batch is screened
together with the retained history of its cards, and only the batch's rows
are routed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import rules as R

ROUTE_DEAD = "dead"
ROUTE_FLAGGED = "flagged"
ROUTE_ACCEPTED = "accepted"
HIST = "_lk_hist"
STREAM_RULES = ("high_amount", "velocity", "cross_border", "decline_rate")


def screen(
    typed_rows: DataFrame,
    params: R.RuleParams = R.DEFAULT_PARAMS,
    rules: tuple[str, ...] = STREAM_RULES,
    history: DataFrame | None = None,
    card_scope: bool = False,
    split: str = "auto",
    hot_source: DataFrame | None = None,
    blacklist: DataFrame | None = None,
) -> DataFrame:
    """Flags, ``reason`` and ``route`` for every row of ``typed_rows``.

    ``typed_rows`` needs a boolean ``valid`` and ``malformed`` (see
    ``sources.messages.typed``); ``history`` holds earlier valid rows of the
    same cards (same columns) that take part in the frames but are not output.
    Invalid rows and rows without a card bypass the frames and are unioned
    back, so ``typed_rows`` is evaluated twice: when it is expensive to
    produce (e.g. JSON decoding of a large backfill), persist it or write it
    as a table first, as the streaming job does with each micro-batch.
    """
    rows = typed_rows.withColumn(HIST, F.lit(False))
    if history is not None:
        rows = rows.unionByName(history.select(*typed_rows.columns).withColumn(HIST, F.lit(True)))
    valid = F.col("valid")
    flags = R.event_flags(rows, rules, params, eligible=valid, split=split, hot_source=hot_source)
    if card_scope:
        flags = R.card_scope(flags, tuple(r for r in rules if r != "high_amount"), eligible=valid)
    if blacklist is not None:
        flags = R.blacklisted(flags, blacklist, eligible=valid)
        rules = (*rules, C.BLACKLIST_CODE)
    flags = R.reasons(flags, rules).filter(~F.col(HIST)).drop(HIST)
    dead_reason = F.when(F.col("malformed"), F.lit(C.DEAD_MALFORMED)).otherwise(F.lit(C.DEAD_MISSING))
    return flags.withColumn("reason", F.when(valid, F.col("reason")).otherwise(dead_reason)).withColumn(
        "route",
        F.when(~valid, F.lit(ROUTE_DEAD))
        .when(F.col("reason") != "", F.lit(ROUTE_FLAGGED))
        .otherwise(F.lit(ROUTE_ACCEPTED)),
    )
