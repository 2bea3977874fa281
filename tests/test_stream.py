"""Streaming job: stream = batch, replay of an epoch is idempotent."""

import os

from pyspark.sql import functions as F

from conftest import DATA
from ledgerlake.plans.screening import screen
from ledgerlake.schemas import RAW_EVENT
from ledgerlake.session import scratch_path
from ledgerlake.sources import messages as M
from ledgerlake.streaming import runner
from ledgerlake.streaming import screening_job as J

EXTRA = ['{bad', '{"amount":3}', '{"transaction_id":"X","card_hash":"amber"}',
         '{"transaction_id":"Y","ts_event":"2026-03-02T12:20:00Z","card_hash":"delta","amount":"12.5"}']


def _messages(spark):
    raw = spark.read.schema(RAW_EVENT).option("header", True).csv(os.path.join(DATA, "payments_seed.csv"))
    seed = raw.select(F.to_json(F.struct(*raw.columns)).alias("value"))
    extra = spark.createDataFrame([(v,) for v in EXTRA], "value string")
    msgs = seed.unionByName(extra)
    return msgs.withColumn("ts_event", F.try_to_timestamp(F.get_json_object("value", "$.ts_event")))


def _routes(df):
    return sorted((r.transaction_id or "", r.route, r.reason) for r in df.collect())


def test_stream_equals_batch(spark):
    msgs = _messages(spark)
    batch = screen(M.typed(M.decode(msgs.select("value"))))
    layout = J.StreamLayout(scratch_path(spark, "t-stream"))
    runner.replay(spark, msgs, layout, chunks=3, snapshot_every=2)
    assert _routes(J.routes(spark, layout)) == _routes(batch)
    out = J.read_outputs(spark, layout)
    assert out["bronze"].select("epoch").distinct().count() >= 2  # several epochs ran
    flagged = {r.transaction_id: r.reason for r in out["signals"].collect()}
    assert flagged == {
        "P-03": "cross_border", "P-04": "high_amount", "P-11": "velocity", "P-12": "decline_rate", "P-14": "decline_rate"
    }
    state = {r.card_hash: len(r.last_events) for r in J.read_outputs(spark, layout)["card_state"]
             .groupBy("card_hash").agg(F.max_by("last_events", "epoch").alias("last_events")).collect()}
    assert state["delta"] == 4 and state["amber"] == 3  # invalid messages never enter the state
    bronze = out["bronze"]
    assert "date" in bronze.columns and bronze.filter("transaction_id = 'Y'").count() == 1


def _snapshot(spark, layout):
    out = {}
    for k, v in J.read_outputs(spark, layout).items():
        v = v.drop("processing_ts", "created_at", "updated_at")
        out[k] = sorted(repr(tuple(r)) for r in v.collect())
    return out


def test_replayed_epoch_is_idempotent(spark):
    layout = J.StreamLayout(scratch_path(spark, "t-replay"))
    body = J.ScreeningBatch(layout)
    batch = _messages(spark).select("value")
    body(batch, 0)
    first = _snapshot(spark, layout)
    body(batch, 0)
    again = _snapshot(spark, layout)
    assert first == again
    body(spark.createDataFrame([], "value string"), 1)  # empty micro-batch: nothing written
    assert J.read_outputs(spark, layout)["signals"].select("epoch").distinct().count() == 1


def test_sliding_velocity_windows_and_dedup(spark):
    from helpers import at, payments

    from ledgerlake.streaming import windows

    rows = [{"transaction_id": f"T{i % 4}", "card_hash": "c", "ts_event": at(i * 0.25)} for i in range(8)]
    rows += [{"transaction_id": "Z", "card_hash": "c", "ts_event": at(30)}]  # moves the watermark on
    df = payments(spark, rows).select("transaction_id", "card_hash", "ts_event")
    base = scratch_path(spark, "t-windows")
    runner.stage_table(df, f"{base}/in", files=2)
    stream = spark.readStream.schema(df.schema).parquet(f"{base}/in")
    out = runner.run_to_parquet(
        windows.velocity_windows(stream, "1 minute", "30 seconds"), f"{base}/vel", f"{base}/ck1"
    )
    got = {(r.window_start.isoformat(), r.n) for r in spark.read.parquet(out).filter("card_hash = 'c'").collect()}
    # events every 15 s from 0 to 105 s; 1-minute windows every 30 s from -30 s
    # hold 2, 4, 4, 4, 2 of them; the windows around the last event stay open
    # (the watermark is 10 minutes behind it) and are not emitted
    assert sorted(n for _, n in got) == [2, 2, 4, 4, 4]
    dd = runner.run_to_parquet(windows.dedup_stream(stream), f"{base}/dd", f"{base}/ck2")
    assert sorted(r.transaction_id for r in spark.read.parquet(dd).collect()) == ["T0", "T1", "T2", "T3", "Z"]


def test_card_scope_epoch(spark):
    layout = J.StreamLayout(scratch_path(spark, "t-cardscope"))
    J.ScreeningBatch(layout, card_scope=True)(_messages(spark).select("value"), 0)
    reasons = {r.transaction_id: r.reason for r in J.read_outputs(spark, layout)["signals"].collect()}
    # a hit at card scope marks all of the card's events
    assert reasons["P-01"] == reasons["P-02"] == reasons["P-03"] == "cross_border"
    assert reasons["P-06"] == "velocity" and reasons["P-13"] == "decline_rate"
    assert "P-05" not in reasons


def test_signals_first_write_wins_across_epochs(spark):
    layout = J.StreamLayout(scratch_path(spark, "t-signals"))
    body = J.ScreeningBatch(layout)
    extra = spark.createDataFrame(
        [('{"transaction_id":"H","ts_event":"oops","card_hash":"q","amount":"20000"}',)], "value string"
    )
    batch = _messages(spark).select("value").unionByName(extra)
    body(batch, 0)
    body(batch, 1)  # the same messages delivered again
    sig = J.read_outputs(spark, layout)["signals"]
    # no transaction is signalled twice (also with a NULL event date) ...
    assert sig.count() == sig.select("transaction_id").distinct().count()
    assert sig.filter("transaction_id = 'H' AND ts_event IS NULL").count() == 1
    # ... while re-delivered copies do take part in the rules again, as in the
    # original job: cedar's third event is now the sixth within a minute (which
    # copy of P-13 comes first, and so its decline rate, is open)
    again = {r.transaction_id for r in sig.filter("epoch = 1").collect()}
    assert again - {"P-13"} == {"P-08", "P-09", "P-10"}
    # the same id on another day is still the same transaction
    moved = '{"transaction_id":"P-04","ts_event":"2026-03-05T09:00:00Z","card_hash":"birch","amount":"12000.01"}'
    body(spark.createDataFrame([(moved,)], "value string"), 2)
    assert J.read_outputs(spark, layout)["signals"].filter("transaction_id = 'P-04'").count() == 1


def test_unreadable_history_raises(spark):
    import pytest

    layout = J.StreamLayout(scratch_path(spark, "t-corrupt"))
    body = J.ScreeningBatch(layout)
    body(_messages(spark).select("value"), 0)
    folder = f"{layout.history}/epoch=0".replace("file:", "")
    for name in os.listdir(folder):
        if name.endswith(".parquet"):
            with open(os.path.join(folder, name), "wb") as f:
                f.write(b"not parquet")
            crc = os.path.join(folder, f".{name}.crc")
            if os.path.exists(crc):
                os.remove(crc)
    with pytest.raises(Exception):
        body(_messages(spark).select("value"), 1)


def test_epoch_without_accepted_rows_reads_as_empty(spark):
    from ledgerlake.plans import silver

    layout = J.StreamLayout(scratch_path(spark, "t-flagged-only"))
    only = '{"transaction_id":"H","ts_event":"2026-03-05T09:00:00Z","card_hash":"q","amount":"20000","mcc":"1"}'
    J.ScreeningBatch(layout)(spark.createDataFrame([(only,)], "value string"), 0)
    out = J.read_outputs(spark, layout)
    assert out["bronze"].count() == 0 and out["signals"].count() == 1
    assert silver.read_bronze(spark, layout.bronze).count() == 0
    # the dead letter holds the whole message
    letter = spark.read.text(layout.deadletter).first()["value"]
    assert '"mcc":"1"' in letter and "raw_value" in letter


def test_snapshots_count_from_the_last_one_and_retire_epochs(spark):
    layout = J.StreamLayout(scratch_path(spark, "t-snap"))
    body = J.ScreeningBatch(layout, snapshot_every=2)
    msg = lambda k: spark.createDataFrame(
        [(f'{{"transaction_id":"S{k}","ts_event":"2026-03-05T09:{k:02d}:00Z","card_hash":"c{k % 2}","amount":"3"}}',)], "value string"
    )
    for epoch in (0, 1, 3, 5, 7):  # the epochs between are empty
        body(msg(epoch), epoch)
    epochs = J._epochs(spark, layout.history, 100)
    assert J._epochs(spark, f"{layout.history}/_snapshots", 100) == [3, 5, 7] and epochs == [5, 7]
    assert J._read_keyed(spark, layout.history, 100).filter("card_hash = 'c0'").count() == 1


def test_blacklist_on_the_stream(spark, blacklist):
    layout = J.StreamLayout(scratch_path(spark, "t-blacklist"))
    J.ScreeningBatch(layout, blacklist=blacklist)(_messages(spark).select("value"), 0)
    reasons = {r.transaction_id: r.reason for r in J.read_outputs(spark, layout)["signals"].collect()}
    assert reasons["P-05"] == "blacklisted"
    assert reasons["P-03"] == "cross_border"


def test_replay_stages_every_chunk_in_one_pass(spark):
    """Chunks by time: no time first, equal times together, a chunk without rows too; a second replay takes their place."""
    rows = [("a", 0), ("b", 1), ("c", 90), ("d", None), ("e", 100), ("f", 100)]
    msgs = spark.createDataFrame(rows, "transaction_id string, s long").select(
        F.to_json(F.struct("transaction_id", F.lit("1.5").alias("amount"))).alias("value"),
        F.timestamp_seconds("s").alias("ts_event"),
    )
    layout = J.StreamLayout(scratch_path(spark, "t-chunks"))
    seen = []
    write, runner._arrive = runner._arrive, lambda s, staged, path: seen.append(staged) or write(s, staged, path)
    try:
        runner.replay(spark, msgs, layout, chunks=4)
        runner.replay(spark, msgs.limit(0), J.StreamLayout(scratch_path(spark, "t-none")), chunks=4)
    finally:
        runner._arrive = write
    assert len(seen) == 5  # without a time there are no cuts
    by = spark.read.text(f"{layout.base}/inbox").select(F.get_json_object("value", "$.transaction_id").alias("t"), "chunk")
    assert sorted(map(tuple, by.collect())) == [("a", 0), ("b", 0), ("c", 3), ("d", 0), ("e", 3), ("f", 3)]
    assert sorted(r[0] for r in _routes(J.routes(spark, layout))) == ["a", "b", "c", "d", "e", "f"]
