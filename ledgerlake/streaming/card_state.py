"""T3 as a stateful operator: the last events of every card in Spark's state store.

``applyInPandasWithState`` keeps, per card, its last ``n`` events and the number of
events taken in.  Cards are dealt to ``shards`` groups by hash, and a group's state holds
its cards: a call of Python costs milliseconds whatever it does, so a call takes a batch of
cards, not one.  A micro-batch reads and writes the state of the shards of its own cards
only, so there are no epoch folders, snapshots or merges of tables: only changed shards go
to the checkpoint, and a lost executor's state is rebuilt from there.  A shard is read and
written whole: with more cards or smaller micro-batches, take more shards (their number
stays with the checkpoint).  A card that sends nothing for ``idle_days`` is forgotten by
an event-time timeout, that of its shard being the earliest of its cards'.

Every touched card's state is emitted with a version (the events taken in), so the
output is an append-only table of versions; ``current`` reads the newest of each card.

Defined cases: events without card are left out; a NULL time sorts before others of the
same batch; stored events come before those of a batch; ties are broken by id, result
and country; a replayed batch writes the same versions again; a card that comes back
after its timeout starts anew.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions import columns as C
from ..operators.dedup import keep_latest
from ..operators.state import HISTORY
from .windows import DEFAULT_DELAY

_SHARD = "_lk_shard"
_LISTS = "micros array<long>, auth_results array<string>, countries array<string>"
#: A shard: per card its newest time, events taken in, timeout and number of events; the events, card by card.
STATE = f"cards array<string>, newest array<long>, versions array<long>, due array<long>, sizes array<int>, {_LISTS}"
VERSIONS = f"card_hash string, newest long, version long, {_LISTS}"
IDLE_DAYS = 90
SHARDS = 4096


def _place(event: tuple):
    """Order of a card's events in a batch: time (NULL first), id, result, country, NULL before text."""
    micros, tie, auth, country = event
    return (micros is not None, micros or 0, tie is not None, tie or "", auth is not None, auth or "", country is not None, country or "")


def _events(part) -> dict[str, list[tuple]]:
    """A part's events by card."""
    texts = [[v if isinstance(v, str) else None for v in part[c].tolist()] for c in ("tie", "auth_result", "country")]
    micros = [None if m is None or m != m else int(m) for m in part["micros"].tolist()]
    out: dict[str, list[tuple]] = {}
    for card, *event in zip(part["card_hash"].tolist(), micros, *texts):
        out.setdefault(card, []).append(tuple(event))
    return out


def _unpack(state: tuple) -> dict[str, tuple]:
    """card -> newest, version, due, events."""
    cards, newest, versions, due, sizes, *lists = state
    events = zip(*lists)
    return {c: (m, v, d, [next(events) for _ in range(k)]) for c, m, v, d, k in zip(cards, newest, versions, due, sizes)}


def _pack(known: dict[str, tuple]) -> tuple:
    newest, versions, due, events = (list(x) for x in zip(*known.values()))
    lists = [list(x) for x in zip(*(e for es in events for e in es))]
    return (list(known), newest, versions, due, [len(es) for es in events], *lists)


def take_in(n: int, idle_ms: int):
    """The function applied to a shard's new events and its state."""

    def run(key: tuple, parts: Iterator, state: GroupState) -> Iterator:
        import pandas as pd

        watermark = state.getCurrentWatermarkMs()
        known = _unpack(state.get) if state.exists else {}
        fresh: dict[str, tuple] = {}  # card -> newest, number, last n events
        for part in parts if not state.hasTimedOut else ():
            for card, batch in _events(part).items():
                newest, taken, last = fresh.get(card, (None, 0, []))
                newest = max([e[0] for e in batch if e[0] is not None] + ([newest] if newest is not None else []), default=None)
                # never more than n events of a card are held, however many come
                fresh[card] = (newest, taken + len(batch), sorted(last + batch, key=_place)[-n:])
        touched = {}
        for card, (latest, taken, last) in fresh.items():
            newest, version, _, stored = known.get(card, (None, 0, None, []))
            newest = max((m for m in (newest, latest) if m is not None), default=None)
            # a timeout has to lie ahead of the watermark
            due = None if newest is None else max(newest // 1000 + idle_ms, watermark + 1)
            touched[card] = (newest, version + taken, due, (stored + [(m, a, c) for m, _, a, c in last])[-n:])
        # cards without news whose timeout has passed are forgotten
        known = {c: x for c, x in known.items() if x[2] is None or x[2] >= watermark} | touched
        if not known:
            state.remove()
            return
        state.update(_pack(known))
        due = min((x[2] for x in known.values() if x[2] is not None), default=None)
        if due is not None:
            state.setTimeoutTimestamp(max(due, watermark + 1))
        if touched:
            newest, versions, _, events = zip(*touched.values())
            row = {"card_hash": list(touched), "newest": pd.array(newest, dtype="Int64"), "version": versions}
            for k, c in enumerate(("micros", "auth_results", "countries")):
                row[c] = [[e[k] for e in es] for es in events]
            yield pd.DataFrame(row)

    return run


def card_state_versions(
    df: DataFrame, n: int = HISTORY, idle_days: float = IDLE_DAYS, delay: str = DEFAULT_DELAY, ts: str = "ts_event",
    shards: int = SHARDS,
) -> DataFrame:
    """Streaming: one row per touched card and micro-batch (``VERSIONS``).

    ``df``: transaction_id, the event time ``ts`` (TIMESTAMP), card_hash, auth_result, location.
    """
    events = df.withWatermark(ts, delay).select(
        F.pmod(F.xxhash64("card_hash"), F.lit(shards)).cast("int").alias(_SHARD),
        "card_hash",
        ts,
        F.unix_micros(ts).alias("micros"),
        F.col("transaction_id").cast("string").alias("tie"),
        "auth_result",
        C.country_from_location("location").alias("country"),
    )
    return (
        events.filter(F.col("card_hash").isNotNull())
        .groupBy(_SHARD)
        .applyInPandasWithState(
            take_in(n, int(idle_days * 86_400_000)), VERSIONS, STATE, "append", GroupStateTimeout.EventTimeTimeout
        )
    )


def current(versions: DataFrame) -> DataFrame:
    """card_hash, last_events (ts, auth_result, country; oldest first): the newest version of every card."""
    newest = keep_latest(versions, ["card_hash"], ["newest", "version"])
    wall = F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")
    seconds = lambda m: (m.cast("decimal(20,0)") / F.lit(1_000_000)).cast("decimal(18,6)")
    events = F.arrays_zip("micros", "auth_results", "countries")
    return newest.select(
        "card_hash",
        F.transform(
            events,
            lambda e: F.struct(
                (wall + F.make_dt_interval(secs=seconds(e["micros"]))).alias("ts"),
                e["auth_results"].alias("auth_result"),
                e["countries"].alias("country"),
            ),
        ).alias("last_events"),
    )
