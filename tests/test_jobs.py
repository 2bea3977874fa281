"""End to end: stream -> Bronze -> Silver -> Gold -> quality -> reports."""

from pyspark.sql import functions as F

from ledgerlake import jobs
from ledgerlake.plans import silver
from ledgerlake.session import scratch_path
from ledgerlake.streaming import runner
from ledgerlake.streaming import screening_job as J
from test_stream import _messages


def test_jobs_end_to_end(spark):
    base = scratch_path(spark, "e2e")
    layout = J.StreamLayout(f"{base}/stream")
    runner.replay(spark, _messages(spark), layout, chunks=2)
    bronze = silver.read_bronze(spark, layout.bronze)
    accepted = bronze.select("transaction_id").distinct().count()
    one_day = silver.read_bronze(spark, layout.bronze, "2026-03-02", "2026-03-02").count()
    assert one_day == bronze.count() - bronze.filter(F.col("date").isNull() | (F.col("date") != "2026-03-02")).count()
    silver.bronze_silver_job(spark, layout.bronze, f"{base}/silver")
    assert spark.read.parquet(f"{base}/silver").count() == accepted
    # an hourly run over one day replaces only that day's partition
    silver.bronze_silver_job(spark, layout.bronze, f"{base}/silver", "2026-03-02", "2026-03-02")
    assert spark.read.parquet(f"{base}/silver").count() == accepted
    ids = spark.read.parquet(f"{base}/silver")
    assert ids.select("transaction_id").distinct().count() == accepted  # also for the id that came on two days
    jobs.gold_job(spark, f"{base}/silver", f"{base}/gold")
    jobs.gold_job(spark, f"{base}/silver", f"{base}/gold")  # rerun: idempotent
    t = jobs.gold_tables(spark, f"{base}/gold")
    assert t["fact_transactions"].count() == accepted
    qual = {r.check_name: r.violations for r in jobs.quality_job(spark, f"{base}/gold").collect()}
    assert qual["fact_tx_unique"] == 0 and qual["fact_card_fk"] == 0 and qual["fact_merchant_fk"] == 0
    for _ in range(2):  # loading the signals again adds none
        jobs.signals_job(spark, layout.base, f"{base}/gold")
    t = jobs.gold_tables(spark, f"{base}/gold")
    reasons = {r.transaction_id: r.reason for r in t["fact_fraud_signals"].collect()}
    assert reasons["P-04"] == "high_amount" and None not in reasons.values()
    assert t["review_signals"].filter("reason IS NOT NULL").count() == 0
    written = jobs.reports_job(spark, f"{base}/gold", f"{base}/reports", "2026-03-06")
    assert len(written) == 4
    assert spark.read.option("header", True).csv(written[0]).count() == t["fact_settlement_daily"].count()
