"""The stream-stream join (J3) and the card state in the state store."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerlake.session import scratch_path
from ledgerlake.streaming import card_state, joins, runner

DDL = "transaction_id string, ts_event timestamp, card_hash string, auth_result string, location string"
T0 = dt.datetime(2026, 3, 2, 12, 0, 0)


def at(minutes):
    return None if minutes is None else T0 + dt.timedelta(minutes=minutes)


def events():
    rows = [
        ("a1", 0, "a", "APPROVED", "Rome, IT"), ("a2", 10, "a", "APPROVED", "Bonn, DE"),  # exactly the window apart
        ("a3", 21, "a", "DECLINED", "Rome, IT"), ("a4", 60, "a", None, "Rome, IT"),
        ("b1", 5, "b", "APPROVED", "Rome, IT"), ("b2", 6, "b", "APPROVED", "Rome, IT"),
        ("n1", 7, None, "APPROVED", "Rome, IT"), ("n2", 7, "a", "APPROVED", None), ("n3", 7, "a", "APPROVED", " , "),
        ("n4", None, "b", "APPROVED", "Bonn, DE"),
        ("c1", 30, "c", "APPROVED", "Rome, IT"), ("c1", 30, "c", "APPROVED", "Rome, IT"), ("c2", 31, "c", "APPROVED", "Bonn, DE"),
    ]
    # a hot card: a burst in one country, a single event elsewhere at its end
    rows += [(f"h{k}", 100 + k / 100, "hot", "APPROVED", "Rome, IT") for k in range(600)]
    rows += [("h-last", 107, "hot", "APPROVED", "Bonn, DE")]
    return [(i, at(m), c, a, loc) for i, m, c, a, loc in rows]


def hits(rows, window=dt.timedelta(minutes=10)):
    def country(loc):
        return (loc or "").split(",")[-1].strip() or None

    known = [(i, t, c, country(loc)) for i, t, c, _, loc in rows if c and t and country(loc)]
    return sorted(
        (i, t) for i, t, c, x in known if any(c == d and x != y and abs(t - u) <= window for _, u, d, y in known)
    )


@pytest.mark.parametrize("salts", [1, 3])
def test_stream_join_emits_every_hit_once(spark, salts):
    df = spark.createDataFrame(events(), DDL).withColumn(
        "arrived", F.col("ts_event") + F.make_dt_interval(mins=F.pmod(F.xxhash64("transaction_id"), F.lit(4)).cast("int"))
    )
    out, late = runner.run_in_order(
        spark, df, lambda s: joins.cross_border_events(s, salts=salts), scratch_path(spark, "t-join"), arrival="arrived", chunks=3
    )
    assert out.columns == [c for c in df.columns if c != "arrived"]
    assert sorted((r.transaction_id, r.ts_event) for r in out.collect()) == hits(events())
    assert late == 0


def test_join_state_expires(spark):
    """Rows leave the state once the watermark has passed the window."""
    base = scratch_path(spark, "t-join-state")
    kept = []
    for day in range(4):
        rows = [(f"{day}-{k}", T0 + dt.timedelta(days=day, seconds=k), f"card{k}", "APPROVED", "Rome, IT") for k in range(50)]
        spark.createDataFrame(rows, DDL).write.mode("append").parquet(f"{base}/in")
        stream = joins.cross_border_events(spark.readStream.schema(DDL).parquet(f"{base}/in"))
        q = stream.writeStream.format("noop").option("checkpointLocation", f"{base}/cp").trigger(availableNow=True).start()
        q.awaitTermination()
        kept.append(q.lastProgress.stateOperators[0].numRowsTotal)
    assert max(kept) <= 2 * 2 * 50  # both sides, never more than the newest two days


def last_of(rows, n):
    out = {}
    for i, t, c, a, loc in rows:
        if c is not None:
            country = loc.split(",")[-1].strip() if loc else None
            out.setdefault(c, []).append((t is not None, t or T0, i, a or "", a, country, t))
    return {c: [(e[6], e[4], e[5]) for e in sorted(v, key=lambda e: e[:4])][-n:] for c, v in out.items()}


def test_card_state_over_restarts(spark):
    # NULL times go first in the first chunk, so the order of arrival is that of the rows
    df = spark.createDataFrame(events(), DDL)
    out, _ = runner.run_in_order(
        spark, df, lambda s: card_state.card_state_versions(s, n=4), scratch_path(spark, "t-state"), chunks=3
    )
    got = {r.card_hash: [tuple(e) for e in r.last_events] for r in card_state.current(out).collect()}
    assert got == last_of(events(), 4)
    versions = {r.card_hash: r.n for r in out.groupBy("card_hash").agg(F.max("version").alias("n")).collect()}
    assert versions["hot"] == 601 and versions["a"] == 6


def test_an_idle_card_is_forgotten(spark):
    rows = [("x1", at(0), "x", "APPROVED", "Rome, IT"), ("y1", at(0), "y", "DECLINED", "Rome, IT")]
    rows += [("y2", at(60 * 24 * 5), "y", "APPROVED", "Rome, IT"), ("y3", at(60 * 24 * 6), "y", "APPROVED", "Rome, IT")]
    rows += [("z1", at(60 * 24 * 8), "z", None, None), ("x2", at(60 * 24 * 12), "x", "APPROVED", "Bonn, DE")]
    out, _ = runner.run_in_order(
        spark, spark.createDataFrame(rows, DDL), lambda s: card_state.card_state_versions(s, idle_days=7),
        scratch_path(spark, "t-idle"), chunks=5,
    )
    got = {r.card_hash: [e.country for e in r.last_events] for r in card_state.current(out).collect()}
    assert got == {"x": ["DE"], "y": ["IT", "IT", "IT"], "z": [None]}


@pytest.mark.parametrize("shards", [1, 3])
def test_cards_share_the_state_of_a_shard(spark, shards):
    """A call takes the cards of a shard, not one; each is still forgotten at its own time."""
    base = scratch_path(spark, "t-shards")
    rows = [[(f"c{k}-{day}", at(60 * 24 * day + k), f"card{k}", "APPROVED", "Rome, IT") for k in range(40) if k % 8 == 0 or day != 2]
            for day in range(4)]
    rows += [[("late", at(60 * 24 * 20), "card1", None, None)], [("last", at(60 * 24 * 21), "card2", "DECLINED", "Bonn, DE")]]
    kept = []
    for part in rows:
        spark.createDataFrame(part, DDL).write.mode("append").parquet(f"{base}/in")
        stream = card_state.card_state_versions(spark.readStream.schema(DDL).parquet(f"{base}/in"), n=2, idle_days=7, shards=shards)
        q = stream.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/cp")
        q = q.trigger(availableNow=True).start()
        q.awaitTermination()
        kept.append(q.lastProgress.stateOperators[0].numRowsTotal)
    assert max(kept) <= shards
    out = spark.read.schema(card_state.VERSIONS).parquet(f"{base}/out")
    versions = {r.card_hash: r.version for r in out.filter("newest < unix_micros(timestamp'2026-03-20')").groupBy("card_hash")
                .agg(F.max("version").alias("version")).collect()}
    assert versions == {f"card{k}": 4 if k % 8 == 0 else 3 for k in range(40)}
    got = {r.card_hash: [(e.auth_result, e.country) for e in r.last_events] for r in card_state.current(out).collect()}
    assert got["card2"] == [("DECLINED", "DE")]  # forgotten when the time had passed its timeout
    assert got["card8"] == [("APPROVED", "IT")] * 2 and len(got) == 40


def test_a_stream_has_partitions_by_its_cores_and_input(spark):
    """A join opens four state stores per partition in every batch: their number is not that of batch shuffles."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    df = spark.createDataFrame(events(), DDL)
    base = scratch_path(spark, "t-partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        out, _ = runner.run_in_order(spark, df, joins.cross_border_events, base, chunks=2)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "40"
        assert runner.stream_partitions(spark, f"{base}/staged") == 2 * spark.sparkContext.defaultParallelism < 40
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{base}/_checkpoint/state/0")
    stores = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(p)
    assert len([s for s in stores if s.getPath().getName().isdigit()]) == 2 * spark.sparkContext.defaultParallelism
    assert sorted((r.transaction_id, r.ts_event) for r in out.collect()) == hits(events())
