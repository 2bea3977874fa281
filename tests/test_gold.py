"""Gold tables: days, manifests, overtaken loads, catalog tables, incremental settlement."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerlake import jobs
from ledgerlake.plans import gold, marts
from ledgerlake.session import scratch_path

FACTS = "fact_transactions"
DDL = "transaction_id string, ts_event timestamp, card_hash string, merchant_id string, amount decimal(18,2), currency string, auth_result string, location string, mcc string"


def rows_of(spark, rows):
    full = [(i, t, f"card-{i}", m, Decimal(a), "EUR", "APPROVED", None, "1") for i, t, m, a in rows]
    return spark.createDataFrame(full, DDL)


def day(n, hour=10):
    return None if n is None else dt.datetime(2026, 3, n, hour)


def ids(df):
    return sorted((r.transaction_id, str(r.date_id), str(r.amount)) for r in df.collect())


def facts(spark, base):
    return gold.read_gold(spark, base, FACTS)


def test_a_load_that_was_overtaken_starts_again(spark, monkeypatch):
    """Writer B reads the manifest, writer A commits, then B commits: nothing committed is lost."""
    base = scratch_path(spark, "race")
    load = lambda rows: gold.add_rows(spark, base, FACTS, gold.fact_transactions_rows(gold.stage(rows_of(spark, rows))))
    load([("a", day(1), "m", 1), ("x", day(1), "m", 1)])
    publish, interrupted = gold._publish, []

    def overtaken(spark_, path, manifest):
        if not interrupted:
            interrupted.append(manifest["number"])
            load([("b", day(1), "m", 2), ("x", day(2), "m", 5)])  # A, in the middle of B
        return publish(spark_, path, manifest)

    monkeypatch.setattr(gold, "_publish", overtaken)
    assert load([("c", day(1), "m", 3), ("x", day(3), "m", 9)]) == 3 and interrupted == [2]
    assert ids(facts(spark, base)) == [
        ("a", "2026-03-01", "1.00"), ("b", "2026-03-01", "2.00"), ("c", "2026-03-01", "3.00"), ("x", "2026-03-03", "9.00")
    ]


def test_overtaken_loads_of_a_list_table(spark, monkeypatch):
    base = scratch_path(spark, "race-list")
    cards = lambda *c: gold.add_rows(spark, base, "dim_card", spark.createDataFrame([(x,) for x in c], "card_hash string"))
    cards("a")
    publish, once = gold._publish, []

    def overtaken(spark_, path, manifest):
        if not once:
            once.append(1)
            cards("b")
        return publish(spark_, path, manifest)

    monkeypatch.setattr(gold, "_publish", overtaken)
    cards("c", "a")
    assert sorted(r[0] for r in gold.read_gold(spark, base, "dim_card").collect()) == ["a", "b", "c"]


def test_a_filter_on_the_day_reaches_the_partitions(spark):
    base = scratch_path(spark, "prune")
    staged = gold.stage(rows_of(spark, [(f"t{n}", day(1 + n % 9), "m", n) for n in range(40)]))
    gold.add_rows(spark, base, FACTS, gold.fact_transactions_rows(staged))
    again = staged.filter("transaction_id = 't5'").withColumn("ts_event", F.lit(day(9)).cast("timestamp")).withColumn("date_id", F.lit(dt.date(2026, 3, 9)))
    gold.add_rows(spark, base, FACTS, gold.fact_transactions_rows(again))
    gold.create_tables(spark, base, "prune_")
    for one in (
        facts(spark, base).filter("date_id = DATE'2026-03-06'"),
        spark.sql("SELECT * FROM prune_fact_transactions WHERE date_id = DATE'2026-03-06'"),
    ):
        plan = one._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(date_id" in plan and "Aggregate" not in plan and "Exchange" not in plan
        assert one.select(F.input_file_name()).distinct().count() == 1
        # t5 lay on this day before
        assert sorted(r.transaction_id for r in one.collect()) == ["t14", "t23", "t32"]


def test_tables_are_found_by_another_session(spark):
    base = scratch_path(spark, "catalog")
    gold.load_gold(spark, gold.stage(rows_of(spark, [("a", day(1), "m", 1), ("b", None, "m", 2)])), base)
    gold.create_tables(spark, base, "cat_")
    other = spark.newSession()
    assert other.sql("SELECT count(*) AS n FROM cat_fact_transactions").first().n == 2
    assert other.sql("SELECT transaction_id FROM cat_fact_transactions WHERE date_id IS NULL").first()[0] == "b"
    assert other.sql("SELECT count(*) AS n FROM cat_fact_fraud_signals").first().n == 0
    gold.load_gold(spark, gold.stage(rows_of(spark, [("a", day(2), "m", 7), ("c", day(2), "n", 1)])), base)
    assert other.sql("SELECT count(*) AS n FROM cat_fact_transactions").first().n == 2  # until the tables are moved
    gold.create_tables(spark, base, "cat_")
    assert ids(other.table("cat_fact_transactions")) == ids(facts(spark, base))
    assert sorted(r[0] for r in other.sql("SELECT merchant_id FROM cat_dim_merchant").collect()) == ["m", "n"]
    assert other.table("cat_fact_transactions").columns == gold.GOLD_COLUMNS[FACTS]
    left = [t.name for t in other.catalog.listTables(pattern="cat_fact_transactions_files_*")]
    assert left == ["cat_fact_transactions_files_2"]


def settlement(df):
    return sorted(map(repr, df.collect()))


def test_settlement_follows_moved_days(spark):
    """After every load equal to A1 over all facts, emptied groups included; only touched days are written."""
    base = scratch_path(spark, "settle")
    loads = [
        [(f"t{n}", day(1 + n % 6), f"m{n % 3}", n) for n in range(30)],
        [("t7", day(5), "m1", 100), ("t8", None, "m2", 8), ("only", day(20), "m9", 4)],
        [("only", day(21), "m9", 4), ("t8", day(2), "m2", 8)],
        [("t8", day(2), "m2", 8)],
    ]
    for k, load in enumerate(loads):
        staged = gold.stage(rows_of(spark, load))
        gold.load_gold(spark, staged, base, with_clock=False)
        want = marts.settlement_daily(facts(spark, base)).filter("merchant_id IS NOT NULL AND dt IS NOT NULL")
        assert settlement(gold.read_gold(spark, base, "fact_settlement_daily")) == settlement(want), k
    m = gold._newest(spark, f"{base}/fact_settlement_daily")
    assert m["touched"] == ["2026-03-02"] and "2026-03-20" not in m["days"] and m["days"]["2026-03-21"].startswith("000000003")
    assert gold.refresh_settlement(spark, base) == []
    # manifests removed in between: all days are computed
    gold.add_rows(spark, base, FACTS, gold.fact_transactions_rows(gold.stage(rows_of(spark, [("z", day(9), "m", 1)]))))
    gold.compact(spark, base, FACTS), gold.compact(spark, base, FACTS), gold.vacuum(spark, base, FACTS, keep=1)
    assert "2026-03-21" in gold.refresh_settlement(spark, base)
    want = marts.settlement_daily(facts(spark, base))
    assert settlement(gold.read_gold(spark, base, "fact_settlement_daily")) == settlement(want)


def test_compaction_and_removal_keep_the_rows(spark):
    base = scratch_path(spark, "vacuum")
    for k in range(4):
        staged = gold.stage(rows_of(spark, [("a", day(1 + k), "m", k), (f"b{k}", day(1), "m", 1)]))
        gold.load_gold(spark, staged, base, with_clock=False)
    names = [n for n in gold.GOLD_KEYS if gold.read_gold(spark, base, n) is not None]
    before = {n: settlement(gold.read_gold(spark, base, n)) for n in names}
    jobs.compact_job(spark, base)
    jobs.compact_job(spark, base)
    assert {n: settlement(gold.read_gold(spark, base, n)) for n in names} == before
    from ledgerlake.sources.tables import path_exists

    p, fs = gold._file_system(spark, f"{base}/{FACTS}")
    folders = [st.getPath().getName() for st in fs.listStatus(p) if st.getPath().getName().startswith("load=")]
    assert len(folders) == 2 and path_exists(spark, f"{base}/{FACTS}/{folders[0]}")


def test_a_ranged_gold_job_reads_and_writes_its_days(spark):
    base = scratch_path(spark, "ranged-job")
    silver = rows_of(spark, [(f"t{n}", day(1 + n % 9), "m", n) for n in range(45)]).withColumn("date", F.to_date("ts_event"))
    silver.write.partitionBy("date").parquet(f"{base}/silver")
    jobs.gold_job(spark, f"{base}/silver", f"{base}/gold")
    whole = gold._newest(spark, f"{base}/gold/{FACTS}")
    jobs.gold_job(spark, f"{base}/silver", f"{base}/gold", "2026-03-03", "2026-03-04")
    m = gold._newest(spark, f"{base}/gold/{FACTS}")
    assert m["touched"] == ["2026-03-03", "2026-03-04"]
    assert {d: x for d, x in m["days"].items() if d not in m["touched"]} == {
        d: x for d, x in whole["days"].items() if d not in m["touched"]
    }
    assert facts(spark, f"{base}/gold").count() == 45
    dims = gold._newest(spark, f"{base}/gold/dim_card")["loads"][-1]
    assert spark.read.parquet(f"{base}/gold/dim_card/load={dims}").count() == 10


def test_signals_are_loaded_from_the_last_epoch_on(spark):
    base = scratch_path(spark, "signal-epochs")
    sig = "transaction_id string, ts_event timestamp, card_hash string, merchant_id string, amount decimal(18,2), currency string, auth_result string, location string, reason string, created_at timestamp"
    for epoch in (0, 1, 4):
        spark.createDataFrame([(f"s{epoch}", None, None, None, None, None, None, None, f"r{epoch}", None)], sig).write.parquet(
            f"{base}/stream/signals/epoch={epoch}"
        )
        if epoch != 1:
            assert jobs.signals_job(spark, f"{base}/stream", f"{base}/gold") is not None
    assert jobs.signals_job(spark, f"{base}/stream", f"{base}/gold") is None and gold.signals_upto(spark, f"{base}/gold") == 4
    loads = gold._newest(spark, f"{base}/gold/fact_fraud_signals")["loads"]
    assert [spark.read.parquet(f"{base}/gold/fact_fraud_signals/load={x}").count() for x in loads] == [1, 2]
    assert sorted(r.reason for r in gold.read_gold(spark, f"{base}/gold", "fact_fraud_signals").collect()) == ["r0", "r1", "r4"]


def test_a_load_counts_its_violations_on_the_way(spark):
    from ledgerlake.operators import quality as Q

    base = scratch_path(spark, "observed")
    loads = [[("a", day(1), "m", 1), ("b", None, None, -2), (None, None, "m", 3)], [("c", day(2), "m", 0)]]
    want = []
    for load in loads:
        staged = gold.stage(rows_of(spark, load))
        want.append({r.check_name: r.violations for r in Q.suite({"staged": staged}, gold.LOAD_CHECKS).collect()} | {"rows": len(load)})
        gold.load_gold(spark, staged, base, with_clock=False)
    assert gold.load_quality(spark, base) == want
    assert want[0]["amount_non_negative"] == want[0]["merchant_id_not_null"] == want[0]["transaction_id_not_null"] == 1


def test_an_unreadable_manifest_raises(spark):
    base = scratch_path(spark, "broken")
    gold.add_rows(spark, base, "dim_card", spark.createDataFrame([("a",)], "card_hash string"))
    p, fs = gold._file_system(spark, f"{base}/dim_card/_manifests/000000002")
    fs.create(p).close()
    with pytest.raises(ValueError):
        gold.read_gold(spark, base, "dim_card")


def test_two_loads_deduplicate_silver_once(spark):
    """Both loads read the staged Silver rows, not the source tables again."""
    from ledgerlake import catalog

    for load in catalog._two_loads(spark, "/root/testdata/sf0.001"):
        files = load.inputFiles()
        assert files and all("gold-silver" in f for f in files)
