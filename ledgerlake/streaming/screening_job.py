"""The streaming screening job.

``readStream`` (Kafka, or JSON-lines files) -> ``foreachBatch`` whose body is
made only of DataFrame operations:

1. decode + validate the micro-batch (S2, F1) and persist it once;
2. read the retained history of the batch's cards (latest version per card
   from epochs before this one) -- the rules need earlier events because
   RANGE/ROWS frames are not supported on streams;
3. screen batch rows together with that history (the same rules as batch);
4. write, each under ``.../epoch=<id>/`` with overwrite, so a replayed epoch
   rewrites exactly the same folders (exactly-once outputs):
   Bronze (accepted, partitioned by date), dead letter (dead + flagged, JSON),
   fraud signals (insert-if-absent), card state (last 10 per card), history.

Nothing is collected to the driver; every step is a distributed job keyed by
card (history, state) or transaction id (signals).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark import StorageLevel

from ..functions import columns as C
from ..functions import rules as R
from ..operators import state as ST
from ..operators.dedup import keep_earliest
from ..plans import screening as SCR
from ..sources import messages as M

EPOCH = "epoch"
HISTORY_COLUMNS = [
    "transaction_id",
    "ts_event",
    "ts_text",
    "card_hash",
    "merchant_id",
    "amount",
    "currency",
    "mcc",
    "channel",
    "auth_result",
    "location",
    "malformed",
    "raw_value",
    "valid",
]


@dataclass
class StreamLayout:
    """Folders of one screening deployment (below a shared file system)."""

    base: str
    bronze: str = field(init=False)
    deadletter: str = field(init=False)
    signals: str = field(init=False)
    state: str = field(init=False)
    history: str = field(init=False)
    checkpoint: str = field(init=False)

    def __post_init__(self):
        b = self.base.rstrip("/")
        self.bronze = f"{b}/bronze"
        self.deadletter = f"{b}/deadletter"
        self.signals = f"{b}/signals"
        self.state = f"{b}/card_state"
        self.history = f"{b}/history"
        self.checkpoint = f"{b}/_checkpoint"


def _epochs(spark: SparkSession, path: str, before: int, since: int = -1) -> list[int]:
    """Epochs written to a table, from one listing of its folder; none if there is no folder."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    names = [st.getPath().getName() for st in fs.listStatus(p)]
    found = [int(n.split("=")[1]) for n in names if n.startswith(f"{EPOCH}=")]
    return sorted(n for n in found if since <= n < before)


def _read_epochs(spark: SparkSession, path: str, epochs: list[int]) -> DataFrame | None:
    """The given epochs by explicit path.  Absence is the only case answered with
    None; files that are there but cannot be read raise."""
    if not epochs:
        return None
    return spark.read.option("basePath", path).parquet(*[f"{path}/{EPOCH}={n}" for n in epochs])


def _snapshot_epoch(spark: SparkSession, path: str, epoch: int) -> int:
    """Latest snapshot epoch below ``epoch`` (-1 if none)."""
    return max(_epochs(spark, f"{path}/_snapshots", epoch), default=-1)


def _read_keyed(spark: SparkSession, path: str, epoch: int) -> DataFrame | None:
    """Per-card delta table: epochs from the latest snapshot up to ``epoch``-1.

    Each epoch holds the rows of the cards it touched; a snapshot epoch holds
    every card.  Reading therefore never goes further back than the last
    snapshot, so the work per micro-batch stays bounded as epochs accumulate.
    """
    return _read_epochs(spark, path, _epochs(spark, path, epoch, _snapshot_epoch(spark, path, epoch)))


def _retire(spark: SparkSession, path: str, epoch: int) -> None:
    """Remove the epochs before the snapshot that precedes the one just written.

    The snapshot before it stays, so an epoch that is replayed after a restart
    still finds what it read the first time.
    """
    before = _snapshot_epoch(spark, path, epoch)
    for n in _epochs(spark, path, before):
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{EPOCH}={n}")
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def _latest_per_card(df: DataFrame, cards: DataFrame | None) -> DataFrame:
    """Rows of each card's latest epoch (only ``cards`` when given)."""
    mine = df.join(cards, "card_hash", "left_semi") if cards is not None else df
    latest = mine.groupBy("card_hash").agg(F.max(EPOCH).alias(EPOCH))
    return mine.join(latest, ["card_hash", EPOCH], "left_semi").drop(EPOCH)


def _write_keyed(spark, fresh: DataFrame, prev: DataFrame | None, cards: DataFrame, path: str, epoch: int, snapshot: bool):
    """Write the touched cards' rows; on a snapshot epoch, all cards' rows."""
    out = fresh
    if snapshot and prev is not None:
        untouched = _latest_per_card(prev, None).join(cards, "card_hash", "left_anti")
        out = untouched.select(*fresh.columns).unionByName(fresh)
    out.write.mode("overwrite").parquet(f"{path}/{EPOCH}={epoch}")
    if snapshot:
        spark.range(1).select(F.lit(epoch).alias(EPOCH)).write.mode("overwrite").parquet(
            f"{path}/_snapshots/{EPOCH}={epoch}"
        )
        _retire(spark, path, epoch)


def retain(rows: DataFrame, params: R.RuleParams, rules: tuple[str, ...]) -> DataFrame:
    """History to keep per card: every event within the longest time window
    of the newest event, plus the last ``n - 1`` attempts before that (for
    the decline rate).  The two parts are disjoint by construction."""
    windows = [params.velocity_window_s if "velocity" in rules else 0, params.cross_window_s]
    lookback = max(windows)
    newest = rows.groupBy("card_hash").agg(F.max("ts_event").alias("_lk_newest"))
    x = rows.join(newest, "card_hash", "left")
    cutoff = F.col("_lk_newest") - F.expr(f"INTERVAL {lookback} SECONDS")
    recent = x.filter(F.col("ts_event") >= cutoff)
    older = x.filter(~F.coalesce(F.col("ts_event") >= cutoff, F.lit(False)) & F.col("auth_result").isNotNull())
    if "decline_rate" in rules and params.decline_n > 1:
        from pyspark.sql import Window

        # reverse of the rules' row order (time, id, auth, location, amount)
        w = Window.partitionBy("card_hash").orderBy(
            *[F.col(c).desc_nulls_last() for c in ("ts_event", "transaction_id", "auth_result", "location", "amount")]
        )
        older = older.withColumn("_lk_rn", F.row_number().over(w)).filter(F.col("_lk_rn") < params.decline_n).drop("_lk_rn")
    else:
        older = older.filter(F.lit(False))
    return recent.unionByName(older).drop("_lk_newest")


class ScreeningBatch:
    """The ``foreachBatch`` body (callable with ``(batch_df, epoch_id)``)."""

    def __init__(
        self,
        layout: StreamLayout,
        params: R.RuleParams = R.DEFAULT_PARAMS,
        rules: tuple[str, ...] = SCR.STREAM_RULES,
        value_column: str = "value",
        snapshot_every: int = 32,
        card_scope: bool = False,
        deadletter_servers: str | None = None,
        deadletter_topic: str = "payments.deadletter",
        blacklist: DataFrame | None = None,
    ):
        self.layout = layout
        self.params = params
        self.rules = rules
        self.value_column = value_column
        self.snapshot_every = snapshot_every
        # card_scope=True: a card's hit marks all its events of the batch (and
        # history), the original job's behaviour; default is per event.
        self.card_scope = card_scope
        self.deadletter_servers = deadletter_servers
        self.deadletter_topic = deadletter_topic
        # Merchant blacklist on the stream side as well (optional)
        self.blacklist = blacklist

    def __call__(self, batch_df: DataFrame, epoch_id: int) -> None:
        spark = batch_df.sparkSession
        typed = M.typed(M.decode(batch_df, self.value_column)).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if typed.isEmpty():  # F2: nothing to do for an empty micro-batch
                return
            self._process(spark, typed, epoch_id)
        finally:
            typed.unpersist()

    def _process(self, spark: SparkSession, typed: DataFrame, epoch: int) -> None:
        lay = self.layout
        valid = typed.filter(F.col("valid"))
        # The batch's cards and their retained history feed several joins and
        # writes below: both are bounded by the micro-batch, so they are
        # persisted for the epoch instead of being recomputed per consumer.
        cards = valid.filter(F.col("card_hash").isNotNull()).select("card_hash").distinct()
        cards = cards.persist(StorageLevel.MEMORY_AND_DISK)
        kept = [cards]
        hist_all = _read_keyed(spark, lay.history, epoch)
        history = None
        if hist_all is not None:
            history = _latest_per_card(hist_all, cards).select(*HISTORY_COLUMNS).persist(StorageLevel.MEMORY_AND_DISK)
            kept.append(history)
        routed = SCR.screen(
            typed, self.params, self.rules, history=history, card_scope=self.card_scope, blacklist=self.blacklist
        )
        routed = routed.withColumn("processing_ts", F.current_timestamp()).persist(StorageLevel.MEMORY_AND_DISK)
        kept.append(routed)
        try:
            self._write(spark, routed, valid, hist_all, history, cards, epoch)
        finally:
            for df in kept:
                df.unpersist()

    def _write(self, spark, routed, valid, hist_all, history, cards, epoch: int) -> None:
        lay = self.layout
        ep = f"{EPOCH}={epoch}"
        # counted from the last snapshot: empty epochs do not skip one
        last = max(0, _snapshot_epoch(spark, lay.history, epoch))
        snapshot = 0 < self.snapshot_every <= epoch - last
        # K1 Bronze: accepted rows, partitioned by event date.
        accepted = routed.filter(F.col("route") == SCR.ROUTE_ACCEPTED).drop("raw_value", "malformed", "valid")
        dated = accepted.withColumn("date", C.event_date("ts_event")).hint("rebalance", "date")
        dated.write.mode("overwrite").partitionBy("date").parquet(f"{lay.bronze}/{ep}")
        # K2 dead letter: invalid and flagged rows as JSON (times as ISO text).
        dead = routed.filter(F.col("route") != SCR.ROUTE_ACCEPTED)
        payload = F.to_json(
            F.struct(
                *[F.col(c) for c in ("transaction_id", "card_hash", "merchant_id", "currency", "mcc", "channel", "auth_result", "location")],
                F.col("ts_text").alias("ts_event"),
                F.col("amount").cast("string").alias("amount"),
                "reason",
                "route",
                "raw_value",
            )
        )
        letters = dead.select(payload.alias("value"))
        letters.write.mode("overwrite").text(f"{lay.deadletter}/{ep}")
        if self.deadletter_servers:
            # Kafka copy of the dead letters (at-least-once across replays)
            letters.write.format("kafka").option("kafka.bootstrap.servers", self.deadletter_servers).option(
                "topic", self.deadletter_topic
            ).save()
        # K3 fraud signals: every epoch writes its own; the first signal of a transaction id
        # stays, whatever day a later copy carries (read_outputs), so no epoch reads those before.
        flagged = routed.filter(F.col("route") == SCR.ROUTE_FLAGGED).select(
            "transaction_id",
            F.col("ts_event"),
            "card_hash",
            "merchant_id",
            "amount",
            "currency",
            "auth_result",
            "location",
            "reason",
            F.col("processing_ts").alias("created_at"),
        )
        flagged = keep_earliest(flagged, ["transaction_id"], ["ts_event"])
        flagged.write.mode("overwrite").parquet(f"{lay.signals}/{ep}")
        # K4 card state: last 10 {ts, auth_result, country} per touched card.
        prev_state = _read_keyed(spark, lay.state, epoch)
        prev_rows = _latest_per_card(prev_state, cards) if prev_state is not None else None
        new_state = ST.merge_state(prev_rows, valid, with_clock=True).join(cards, "card_hash", "left_semi")
        _write_keyed(spark, new_state, prev_state, cards, lay.state, epoch, snapshot)
        # History for the rules of later epochs.
        rows = valid.filter(F.col("card_hash").isNotNull()).withColumn("raw_value", F.lit(None).cast("string"))
        rows = rows.select(*HISTORY_COLUMNS)
        if history is not None:
            rows = history.unionByName(rows)
        kept = retain(rows, self.params, self.rules)
        _write_keyed(spark, kept, hist_all, cards, lay.history, epoch, snapshot)


def start(
    source: DataFrame,
    layout: StreamLayout,
    params: R.RuleParams = R.DEFAULT_PARAMS,
    rules: tuple[str, ...] = SCR.STREAM_RULES,
    available_now: bool = False,
    processing_time: str | None = None,
    snapshot_every: int = 32,
    **options,
):
    """Start the query with its checkpoint; returns StreamingQuery.

    ``options``: ``card_scope``, ``blacklist``, ``deadletter_servers`` and
    ``deadletter_topic`` of ``ScreeningBatch``.
    """
    body = ScreeningBatch(layout, params, rules, snapshot_every=snapshot_every, **options)
    writer = source.writeStream.foreachBatch(body).option("checkpointLocation", layout.checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def bronze_schema(spark: SparkSession):
    """Columns of Bronze, from the job's own steps over no messages."""
    typed = M.typed(M.decode(spark.createDataFrame([], "value string")))
    routed = SCR.screen(typed, split="never").withColumn("processing_ts", F.current_timestamp())
    dated = routed.drop("raw_value", "malformed", "valid").withColumn("date", C.event_date("ts_event"))
    return dated.withColumn(EPOCH, F.lit(0)).schema


def read_outputs(spark: SparkSession, layout: StreamLayout) -> dict[str, DataFrame]:
    """The job's tables as DataFrames (all epochs)."""
    dead_schema = "transaction_id string, reason string, route string"
    return {
        "bronze": spark.read.schema(bronze_schema(spark)).parquet(layout.bronze),
        "deadletter": spark.read.text(layout.deadletter).select(F.from_json("value", dead_schema).alias("d")).select("d.*"),
        "signals": keep_earliest(spark.read.parquet(layout.signals), ["transaction_id"], [EPOCH]),
        "card_state": spark.read.parquet(layout.state),
    }


def signal_epochs(spark: SparkSession, layout: StreamLayout, since: int = 0) -> list[int]:
    """Epochs with signals written, from ``since`` on."""
    return _epochs(spark, layout.signals, 1 << 62, since)


def read_signals(spark: SparkSession, layout: StreamLayout, epochs: list[int]) -> DataFrame:
    """The signals of the given epochs (their folders only)."""
    return _read_epochs(spark, layout.signals, epochs).drop(EPOCH)


def card_state(spark: SparkSession, layout: StreamLayout) -> DataFrame:
    """K4: the state of every card, one row each (its newest version)."""
    return _latest_per_card(spark.read.parquet(layout.state), None)


def dead_letters(spark: SparkSession, layout: StreamLayout) -> DataFrame:
    """K2: the dead-lettered and flagged messages with the fields they were sent with, all as text."""
    fields = [*M.RAW_FIELDS, "reason", "route", "raw_value"]
    letters = spark.read.text(layout.deadletter)
    return letters.select(F.from_json("value", ", ".join(f"{f} string" for f in fields)).alias("d")).select("d.*")


def routes(spark: SparkSession, layout: StreamLayout) -> DataFrame:
    """transaction_id, route, reason of every processed message."""
    out = read_outputs(spark, layout)
    accepted = out["bronze"].select("transaction_id", "route", "reason")
    dead = out["deadletter"].select("transaction_id", "route", "reason")
    return accepted.unionByName(dead)


def console_preview(source: DataFrame, rows: int = 20):
    """K9: debugging sink -- decoded messages to the console (no state)."""
    decoded = M.typed(M.decode(source))
    return decoded.writeStream.format("console").option("truncate", False).option("numRows", rows).start()
