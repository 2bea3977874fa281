"""Upserts, card state, SCD-2, Gold load, quality checks and reports."""

import datetime as dt
import os
from decimal import Decimal

from helpers import at, payments
from pyspark.sql import functions as F

from ledgerlake.operators import quality as Q
from ledgerlake.operators import scd2 as H
from ledgerlake.operators import state as S
from ledgerlake.operators import upsert as U
from ledgerlake.plans import gold, reports, silver
from ledgerlake.schemas import PAYMENT
from ledgerlake.session import scratch_path


def _kv(df, k="id", v="v"):
    return {r[k]: r[v] for r in df.collect()}


def test_upserts(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    source = spark.createDataFrame([(2, "B"), (3, "c"), (3, "C"), (None, "n")], "id int, v string")
    up = U.upsert(target, source, ["id"], order=["v"])
    assert _kv(up) == {1: "a", 2: "B", 3: "c"}  # 'c' > 'C': latest by order wins
    assert sorted(map(tuple, U.upsert(up, source, ["id"], order=["v"]).collect())) == sorted(map(tuple, up.collect()))
    ins = U.insert_if_absent(target, source, ["id"], order=["v"])
    assert _kv(ins) == {1: "a", 2: "b", 3: "C"}  # existing rows never change; first by order wins


def test_state_last_ten_and_merge(spark):
    first = payments(spark, [{"card_hash": "c", "ts_event": at(i), "auth_result": "APPROVED"} for i in range(8)])
    second = payments(spark, [{"card_hash": "c", "ts_event": at(10 + i), "auth_result": "DECLINED"} for i in range(5)])
    st1 = S.merge_state(None, first, with_clock=False)
    st2 = S.merge_state(st1, second, with_clock=False)
    ev = S.explode_state(st2).orderBy("pos").collect()
    assert [r.pos for r in ev] == list(range(1, 11))
    assert [r.auth_result for r in ev] == ["APPROVED"] * 5 + ["DECLINED"] * 5
    other = payments(spark, [{"card_hash": "z", "ts_event": at(0)}])
    st3 = S.merge_state(st2, other, with_clock=False)
    assert {r.card_hash: len(r.last_events) for r in st3.collect()} == {"c": 10, "z": 1}


def test_scd2_incremental(spark):
    rows = payments(spark, [
        {"merchant_id": "M", "mcc": "1", "ts_event": at(0)},
        {"merchant_id": "M", "mcc": "1", "ts_event": at(1)},
        {"merchant_id": "M", "mcc": "2", "ts_event": at(2)},
    ])
    hist = H.versions(rows, "merchant_id", ["mcc"])
    assert [(r.mcc, r.is_current) for r in hist.orderBy("valid_from").collect()] == [("1", False), ("2", True)]
    snap = payments(spark, [{"transaction_id": "N", "merchant_id": "M", "mcc": "3", "ts_event": at(5)},
                            {"transaction_id": "O", "merchant_id": "M", "mcc": "9", "ts_event": at(-5)}])
    new = H.apply_snapshot(hist, snap, "merchant_id", ["mcc"]).orderBy("valid_from").collect()
    assert [(r.mcc, r.is_current) for r in new] == [("1", False), ("2", False), ("3", True)]


def test_scd2_close_and_append(spark):
    """Snapshots one after the other equal the history of all rows; rows that change nothing are counted."""
    rows = [(f"M{k % 7}", str((k * k) % 5), at(3 * k), f"T{k:03d}") for k in range(120)]
    rows += [("N", "1", None, "N0"), ("N", "2", at(50), "N1"), ("O", "7", None, "O0")]
    ddl = "merchant_id string, mcc string, ts_event string, transaction_id string"
    frame = lambda rows: spark.createDataFrame(rows, ddl).withColumn("ts_event", F.col("ts_event").cast("timestamp"))
    loads = [rows[:40] + rows[120:121], rows[40:90] + rows[121:], rows[90:120]]
    current, closed = None, []
    for load in loads:
        snapshot = frame(load)
        if current is None:
            history = H.versions(snapshot, "merchant_id", ["mcc"])
            current, closed = history.filter("is_current"), [history.filter("NOT is_current")]
        else:
            current, more = H.close_and_append(current, snapshot, "merchant_id", ["mcc"])
            closed.append(more)
    got = current
    for part in closed:
        got = got.unionByName(part)
    whole = H.versions(frame(rows), "merchant_id", ["mcc"])
    assert sorted(map(repr, got.collect())) == sorted(map(repr, whole.collect()))
    late = [("M1", "9", at(-9), "L1"), ("M1", "9", None, "L2"), (None, "9", at(999), "L3"), ("P", "1", None, "L4"), ("M1", "0", at(999), "L5")]
    ignored = H.ignored_rows(current, frame(late), "merchant_id")
    assert sorted(r.transaction_id for r in ignored.collect()) == ["L1", "L2", "L3"]


def test_backfill_columns(spark, seed):
    out = silver.backfill_columns(seed.drop("mcc", "channel"), PAYMENT)
    assert out.columns[:10] == [f.name for f in PAYMENT.fields]
    assert out.filter("mcc IS NOT NULL").count() == 0


def test_quality(spark, seed):
    dup = seed.unionByName(seed.limit(2))
    assert {r.transaction_id: r.n for r in Q.unique(dup, "transaction_id").collect()} == {"P-01": 2, "P-02": 2, "P-17": 2}
    assert [r.transaction_id for r in Q.not_null(seed, "merchant_id").collect()] == ["P-19"]
    parents = spark.createDataFrame([("M20010",)], "merchant_id string")
    orphans = Q.relationships(seed, "merchant_id", parents, "merchant_id")
    assert orphans.count() == 17  # M20010 rows match, the NULL merchant is exempt
    assert Q.table_has_rows(seed) and not Q.table_has_rows(seed.limit(0))
    req = seed.select("transaction_id", Q.has_required_fields().alias("ok")).filter("NOT ok").collect()
    # no card, no time, no readable amount, no merchant
    assert sorted(r.transaction_id for r in req) == ["P-15", "P-16", "P-18", "P-19"]
    K = Q.Check
    res = Q.suite({"t": dup, "p": parents}, [
        K("nn", "t", "merchant_id", "not_null"),
        K("uq", "t", "transaction_id", "unique"),
        K("fk", "t", "merchant_id", "relationships", "p", "merchant_id"),
        K("pos", "t", "amount", "expression", condition="amount >= 0"),
    ])
    assert {r.check_name: r.violations for r in res.collect()} == {"nn": 1, "uq": 3, "fk": 17, "pos": 0}


def test_reports_round_trip(spark, seed):
    from ledgerlake.plans import marts

    base = scratch_path(spark, "reports")
    rep = reports.settlement_report(marts.settlement_daily(seed))
    path = reports.write_report(rep, f"{base}/settlement", run_date=dt.date(2025, 11, 5))
    assert path.endswith("run_date=2025-11-05")
    back = spark.read.option("header", True).csv(path)
    assert back.count() == 11 and back.columns[2] == "date"
    assert reports.write_table_report(spark, f"{base}/missing_table", f"{base}/out") is None
    tot = {r.merchant_id: r.total_amount for r in reports.totals_report(seed).collect()}
    assert tot["M20014"] == Decimal("453.00")
    assert os.path.isdir(path.replace("file:", ""))


def test_load_gold(spark, seed):
    base = scratch_path(spark, "gold-load")
    staged = gold.stage(silver.standardize(seed, add_clock=False))
    gold.load_gold(spark, staged, base, with_clock=False)
    first = {n: sorted(map(repr, gold.read_gold(spark, base, n).collect())) for n in gold.gold_increment(staged)}
    gold.load_gold(spark, staged, base, with_clock=False)  # same load again: no change
    for n, rows in first.items():
        assert sorted(map(repr, gold.read_gold(spark, base, n).collect())) == rows, n
    facts = gold.read_gold(spark, base, "fact_transactions")
    assert facts.count() == 19 == facts.select("transaction_id").distinct().count()
    assert facts.filter("date_id IS NULL").count() == 1
    assert gold.read_gold(spark, base, "fact_fraud_signals") is None  # review rows are no signals
    # second load: P-01 moves to the next day with a new amount, P-99 is new without a
    # time and comes twice, a row without an id cannot enter, M20010 changes its mcc
    moved = seed.filter("transaction_id IN ('P-01', 'P-02')").withColumn(
        "ts_event", F.col("ts_event") + F.expr("INTERVAL 1 DAY")
    ).withColumn("amount", F.col("amount") + 1).withColumn("mcc", F.lit("7000"))
    no_time = seed.filter("transaction_id = 'P-16'")
    new = no_time.withColumn("transaction_id", F.lit("P-99"))
    nameless = no_time.withColumn("transaction_id", F.lit(None).cast("string"))
    load2 = moved.unionByName(new).unionByName(new).unionByName(nameless)
    gold.load_gold(spark, gold.stage(silver.standardize(load2, add_clock=False)), base, with_clock=False)
    facts = {r.transaction_id: (str(r.date_id), r.amount) for r in gold.read_gold(spark, base, "fact_transactions").collect()}
    assert len(facts) == 20 and None not in facts
    assert facts["P-01"] == ("2026-03-03", Decimal("13.40"))
    assert facts["P-16"] == facts["P-99"] == ("None", Decimal("20.00"))  # no row of the NULL day is lost
    settle = {(r.merchant_id, str(r.dt)): r.txn_count for r in gold.read_gold(spark, base, "fact_settlement_daily").collect()}
    assert settle[("M20010", "2026-03-03")] == 2 and settle[("M20011", "2026-03-02")] == 1
    assert {r.merchant_id: r.mcc for r in gold.read_gold(spark, base, "dim_merchant").collect()}["M20010"] == "7000"
    # a load that was not committed is not there; a compaction changes nothing
    load2.limit(1).write.parquet(f"{base}/fact_transactions/load=77")
    assert gold.compact(spark, base, "fact_transactions") == 4
    again = {r.transaction_id: (str(r.date_id), r.amount) for r in gold.read_gold(spark, base, "fact_transactions").collect()}
    assert again == facts and gold._live_loads(spark, f"{base}/fact_transactions") == [4]
    names = gold.create_tables(spark, base, "t_")
    assert spark.sql("SELECT mcc FROM t_dim_merchant WHERE merchant_id = 'M20010'").collect()[0].mcc == "7000"
    assert spark.table("t_fact_fraud_signals").count() == 0 and len(names) == 7


def test_signals_keep_their_first_row(spark, seed):
    base = scratch_path(spark, "gold-signals")
    sig = gold.review_backfill(gold.stage(seed)).withColumn("created_at", F.current_timestamp())
    one = sig.filter("transaction_id = 'P-04'")
    gold.load_signals(spark, one.withColumn("reason", F.lit("high_amount")), base)
    later = one.withColumn("reason", F.lit("velocity")).withColumn("ts_event", F.col("ts_event") + F.expr("INTERVAL 3 DAYS"))
    null = one.withColumn("transaction_id", F.lit(None).cast("string"))
    gold.load_signals(spark, later.unionByName(later).unionByName(null), base)
    assert [(r.transaction_id, r.reason) for r in gold.read_gold(spark, base, "fact_fraud_signals").collect()] == [("P-04", "high_amount")]


def test_silver_round_trip_and_missing(spark, seed):
    base = scratch_path(spark, "silver")
    silver.write_silver(silver.silver_from_bronze(seed, order=["ts_event"]), f"{base}/silver")
    back = silver.read_silver(spark, f"{base}/silver")
    assert back.count() == 19 and "cleaned_ts" in back.columns
    assert back.filter("cleaned_ts IS NULL").count() == 0
    empty = silver.read_silver(spark, f"{base}/nothing-here")
    assert empty.count() == 0 and "transaction_id" in empty.columns
    assert gold.stage(empty).count() == 0


def test_sql_over_registered_views(spark, seed, blacklist):
    from ledgerlake.plans import marts

    facts = marts.fact_transactions(seed, blacklist)
    names = marts.register_views({"fact_transactions": facts, "settlement_daily": marts.settlement_daily(seed)})
    assert names == ["fact_transactions", "settlement_daily"]
    top = spark.sql(
        "SELECT merchant_id, currency, dt AS date, txn_count FROM settlement_daily "
        "WHERE merchant_id IS NOT NULL ORDER BY dt DESC, txn_count DESC LIMIT 1"
    ).collect()
    assert top[0].merchant_id == "M20016" and top[0].txn_count == 2
    flagged = spark.sql("SELECT count(*) AS n FROM fact_transactions WHERE flag_high_amount OR flag_blacklisted").first()
    assert flagged.n == 2


def test_plans_prune_and_broadcast(spark, seed):
    """The scale claims, read off the physical plans."""
    from ledgerlake.plans import marts

    base = scratch_path(spark, "plans")
    t = spark.createDataFrame(
        [(str(i), dt.date(2025, 1, 1 + i % 5), "v") for i in range(50)], "id string, day date, v string"
    )
    t.write.partitionBy("day").parquet(f"{base}/t")
    target = spark.read.parquet(f"{base}/t")
    pruned = target.filter(F.col("day").isin([dt.date(2025, 1, 2)]))
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "2025-01-02" in plan
    src = spark.createDataFrame([("3", dt.date(2025, 1, 2), "w")], "id string, day date, v string")
    up = U.upsert(target, src, ["id"])
    assert up.count() == 50
    up.collect()  # the measured size of the incoming keys decides
    assert "BroadcastHashJoin" in up._jdf.queryExecution().executedPlan().toString()
    bl = spark.createDataFrame([("M20666",)], "merchant_id string")
    facts = marts.fact_transactions(seed, bl)
    facts.collect()
    assert "BroadcastHashJoin" in facts._jdf.queryExecution().executedPlan().toString()


def test_stage_backfills_typed_columns(spark, seed):
    staged = gold.stage(seed.drop("amount", "location", "mcc"))
    types = dict(staged.dtypes)
    assert types["amount"] == "decimal(18,2)" and types["location"] == "string"
    inc = gold.gold_increment(staged, with_clock=False)
    assert inc["fact_settlement_daily"].filter("gross_amount IS NOT NULL").count() == 0
    assert inc["fact_transactions"].count() == 20


def test_top_k_is_cut_before_the_shuffle(spark):
    from ledgerlake.sources import feeds
    from conftest import SF_SMALL

    state = S.merge_state(None, feeds.event_payments(spark, SF_SMALL), with_clock=False)
    plan = state._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_cluster_conf_sizes_shuffles():
    from ledgerlake.session import cluster_conf

    conf = cluster_conf(input_bytes=100 * 1024**4, total_cores=8000)
    assert int(conf["spark.sql.shuffle.partitions"]) == 100 * 1024**4 // (256 * 1024**2)
    small = cluster_conf(input_bytes=1024, total_cores=16)
    assert int(small["spark.sql.shuffle.partitions"]) == 32
    assert conf["spark.sql.streaming.stateStore.providerClass"].endswith("RocksDBStateStoreProvider")
