"""Batch and streaming jobs, as the scheduled tasks of the original system.

    python -m ledgerlake.jobs stream   --input DIR --base DIR [--servers H:P --topic T] [--once]
                                       [--deadletter-servers H:P] [--blacklist CSV] [--card-scope]
    python -m ledgerlake.jobs signals  --base DIR --gold DIR
    python -m ledgerlake.jobs silver   --bronze DIR --silver DIR [--from D --to D]
    python -m ledgerlake.jobs gold     --silver DIR --gold DIR [--from D --to D]
    python -m ledgerlake.jobs compact  --gold DIR
    python -m ledgerlake.jobs quality  --gold DIR
    python -m ledgerlake.jobs reports  --gold DIR --out DIR [--run-date D]

Each job is a handful of DataFrame writes; scheduling and retries belong to
the cluster's scheduler.
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import columns as C
from .operators import quality as Q
from .plans import gold, reports, silver
from .session import build_session
from .sources import messages, seeds
from .streaming import screening_job


def stream_job(spark: SparkSession, base: str, input_dir: str | None = None, servers: str | None = None,
               topic: str = "payments.raw", once: bool = False, deadletter_servers: str | None = None,
               blacklist_csv: str | None = None, card_scope: bool = False):
    """Start the screening stream (Kafka when servers are given, else files)."""
    source = messages.read_stream(spark, path=input_dir, servers=servers, topic=topic)
    query = screening_job.start(
        source,
        screening_job.StreamLayout(base),
        available_now=once,
        deadletter_servers=deadletter_servers,
        blacklist=seeds.blacklist_seed(spark, blacklist_csv) if blacklist_csv else None,
        card_scope=card_scope,
    )
    if once:
        query.awaitTermination()
    return query


def signals_job(spark: SparkSession, base: str, gold_path: str) -> int | None:
    """The fraud signals of the stream's epochs since the last run into Gold; ids that Gold
    holds stay as they are.  None if there is no new epoch."""
    layout = screening_job.StreamLayout(base)
    since = gold.signals_upto(spark, gold_path)
    epochs = screening_job.signal_epochs(spark, layout, since + 1)
    if not epochs:
        return None
    signals = screening_job.read_signals(spark, layout, epochs)
    return gold.load_signals(spark, signals, gold_path, upto=epochs[-1])


def gold_job(
    spark: SparkSession, silver_path: str, gold_path: str, date_from: str | None = None, date_to: str | None = None
) -> list[str]:
    """Daily Silver -> Gold load: all of Silver, or the days of a range (its partitions)."""
    rows = silver.read_silver(spark, silver_path)
    day = F.col("date") if "date" in rows.columns else C.event_date("ts_event")
    if date_from:
        rows = rows.filter(day >= F.lit(date_from).cast("date"))
    if date_to:
        rows = rows.filter(day <= F.lit(date_to).cast("date"))
    return gold.load_gold(spark, gold.stage(rows), gold_path)


def compact_job(spark: SparkSession, gold_path: str) -> None:
    """One load per table again; loads that the newest two manifests do not need are removed."""
    for name in gold.GOLD_KEYS:
        gold.compact(spark, gold_path, name)
        gold.vacuum(spark, gold_path, name)


def gold_tables(spark: SparkSession, gold_path: str) -> dict[str, DataFrame]:
    out = {}
    for name in gold.GOLD_KEYS:
        df = gold.read_gold(spark, gold_path, name)
        if df is not None:
            out[name] = df
    return out


def quality_job(spark: SparkSession, gold_path: str) -> DataFrame:
    """Q7 over the Gold tables: one row per check with its violation count."""
    t = gold_tables(spark, gold_path)
    K = Q.Check
    checks = [
        K("dim_merchant_not_null", "dim_merchant", "merchant_id", "not_null"),
        K("dim_merchant_unique", "dim_merchant", "merchant_id", "unique"),
        K("dim_card_not_null", "dim_card", "card_hash", "not_null"),
        K("dim_card_unique", "dim_card", "card_hash", "unique"),
        K("fact_tx_not_null", "fact_transactions", "transaction_id", "not_null"),
        K("fact_tx_unique", "fact_transactions", "transaction_id", "unique"),
        K("fact_merchant_fk", "fact_transactions", "merchant_id", "relationships", "dim_merchant", "merchant_id"),
        K("fact_card_fk", "fact_transactions", "card_hash", "relationships", "dim_card", "card_hash"),
        K("fact_amount_non_negative", "fact_transactions", "amount", "expression", condition="amount >= 0"),
        K("settlement_merchant_not_null", "fact_settlement_daily", "merchant_id", "not_null"),
        K("settlement_dt_not_null", "fact_settlement_daily", "dt", "not_null"),
    ]
    return Q.suite(t, [c for c in checks if c.table in t and (c.parent is None or c.parent in t)])


def reports_job(spark: SparkSession, gold_path: str, out_dir: str, run_date: str | None = None) -> list[str]:
    """Settlement and fraud reports (fixed names) and dated exports."""
    t = gold_tables(spark, gold_path)
    run_date = run_date or dt.date.today().isoformat()
    out = out_dir.rstrip("/")
    written = []
    if "fact_settlement_daily" in t:
        written.append(reports.write_report(reports.settlement_report(t["fact_settlement_daily"]), f"{out}/settlement_report"))
    if "fact_fraud_signals" in t:
        written.append(reports.write_report(reports.fraud_report(t["fact_fraud_signals"], with_clock=True), f"{out}/fraud_report"))
        written.append(reports.write_report(t["fact_fraud_signals"], f"{out}/fraud", run_date))
    if "fact_transactions" in t:
        written.append(reports.write_report(reports.totals_report(t["fact_transactions"]), f"{out}/settlement", run_date))
    return written


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="ledgerlake.jobs")
    ap.add_argument("job", choices=["stream", "signals", "silver", "gold", "compact", "quality", "reports"])
    ap.add_argument("--input"), ap.add_argument("--base"), ap.add_argument("--servers"), ap.add_argument("--topic", default="payments.raw")
    ap.add_argument("--once", action="store_true"), ap.add_argument("--card-scope", action="store_true")
    ap.add_argument("--deadletter-servers"), ap.add_argument("--blacklist")
    ap.add_argument("--bronze"), ap.add_argument("--silver"), ap.add_argument("--gold"), ap.add_argument("--out")
    ap.add_argument("--from", dest="date_from"), ap.add_argument("--to", dest="date_to"), ap.add_argument("--run-date")
    a = ap.parse_args(argv)
    spark = build_session(app_name=f"ledgerlake-{a.job}")
    if a.job == "stream":
        q = stream_job(spark, a.base, a.input, a.servers, a.topic, a.once, a.deadletter_servers, a.blacklist, a.card_scope)
        if not a.once:
            q.awaitTermination()
    elif a.job == "signals":
        signals_job(spark, a.base, a.gold)
    elif a.job == "silver":
        silver.bronze_silver_job(spark, a.bronze, a.silver, a.date_from, a.date_to)
    elif a.job == "gold":
        gold_job(spark, a.silver, a.gold, a.date_from, a.date_to)
    elif a.job == "compact":
        compact_job(spark, a.gold)
    elif a.job == "quality":
        quality_job(spark, a.gold).orderBy("check_name").show(truncate=False)
    else:
        reports_job(spark, a.gold, a.out, a.run_date)


if __name__ == "__main__":
    main()
