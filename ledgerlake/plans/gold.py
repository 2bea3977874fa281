"""Silver -> Gold star schema.

``gold_increment`` derives the Gold tables' new rows from a Silver DataFrame;
``load_gold`` adds them to the tables.  A table on the shared file system is a folder
of loads (``load=<number>-<name>``, never changed once written) and numbered manifests
that say which of them count:

* the daily facts (``DAYS``) are partitioned by day, and every day lies in one load.  A
  load rewrites the days it touches: those of its rows, and those on which Gold held
  older versions of them.  Reads need no aggregate, and a filter on the day reaches
  the partitions;
* the other tables are lists of loads: a read takes, per key, the row of the newest load
  (upserted tables) or of the oldest one (insert-if-absent tables).

A manifest is published by a rename that fails if its number is taken.  A load that
another one overtook starts again from that one's result, so no committed row is
lost, and a crash before the rename leaves no trace.  ``compact`` writes the current
rows as one load; ``vacuum`` removes what no recent manifest needs.

The daily settlement is kept up from the facts: the days that the facts' manifests
have touched since the last time are computed anew and replaced as a whole.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import quality as Q
from ..operators.dedup import keep_earliest, keep_latest
from ..operators.upsert import collapse_source
from ..schemas import GOLD_COLUMNS, GOLD_DDL, GOLD_KEYS, PAYMENT
from ..session import scratch_path
from . import marts

TX_ORDER = ("ts_event",)


def stage(silver: DataFrame) -> DataFrame:
    """Staged transactions: the listed columns plus the event date."""
    cols = ["transaction_id", "ts_event", "card_hash", "merchant_id", "amount", "currency", "auth_result", "location"]
    types = {f.name: f.dataType for f in PAYMENT.fields}
    present = set(silver.columns)
    out = silver
    for c in cols + ["mcc"]:
        if c not in present:  # absent columns become typed NULLs
            out = out.withColumn(c, F.lit(None).cast(types[c]))
    return out.select(*cols, "mcc", C.event_date("ts_event").alias("date_id"))


def review_backfill(tx: DataFrame) -> DataFrame:
    """F8: rows having a location or a decline, as signals with NULL reason.

    Kept apart from real fraud signals: it marks nearly every row.
    """
    return tx.filter(F.col("location").isNotNull() | (F.col("auth_result") == C.DECLINED)).select(
        "transaction_id",
        "ts_event",
        "card_hash",
        "merchant_id",
        "amount",
        "currency",
        "auth_result",
        "location",
        F.lit(None).cast("string").alias("reason"),
    )


def fact_transactions_rows(staged: DataFrame) -> DataFrame:
    return staged.filter(F.col("transaction_id").isNotNull()).select(*GOLD_COLUMNS["fact_transactions"])


def gold_increment(staged: DataFrame, fee_rate: str = marts.DEFAULT_FEE_RATE, with_clock: bool = True) -> dict[str, DataFrame]:
    """New rows for every Gold table from one staged Silver load."""
    signals = review_backfill(staged)
    signals = signals.withColumn("created_at", F.current_timestamp() if with_clock else F.lit(None).cast("timestamp"))
    return {
        "dim_date": staged.select("date_id").filter(F.col("date_id").isNotNull()).distinct(),
        "dim_card": staged.select("card_hash").filter(F.col("card_hash").isNotNull()).distinct(),
        "dim_merchant": marts.dim_merchant(staged),
        "fact_transactions": fact_transactions_rows(staged),
        "fact_settlement_daily": marts.settlement_daily(staged, fee_rate),
        # F8 is kept apart from the stream's real signals (load_signals)
        "review_signals": signals.select(*GOLD_COLUMNS["review_signals"]),
    }


# How each table absorbs an increment (U1 insert-if-absent / U2-U4 overwrite).
MERGE_MODE = {
    "dim_date": "insert",
    "dim_card": "insert",
    "dim_merchant": "upsert",
    "fact_transactions": "upsert",
    "fact_settlement_daily": "upsert",
    "fact_fraud_signals": "insert",
    "review_signals": "insert",
}


def empty_table(spark: SparkSession, name: str) -> DataFrame:
    """K6: an empty Gold table with its declared schema."""
    return spark.createDataFrame([], GOLD_DDL[name])


LOAD = "load"
#: Counted while a load is staged.
LOAD_CHECKS = [
    Q.Check("transaction_id_not_null", "staged", "transaction_id", "not_null"),
    Q.Check("merchant_id_not_null", "staged", "merchant_id", "not_null"),
    Q.Check("card_hash_not_null", "staged", "card_hash", "not_null"),
    Q.Check("date_id_not_null", "staged", "date_id", "not_null"),
    Q.Check("amount_non_negative", "staged", "amount", "expression", condition="amount >= 0"),
]
#: Tables partitioned by day, and their day.
DAYS = {"fact_transactions": "date_id", "fact_settlement_daily": "dt"}
NO_DAY = "__HIVE_DEFAULT_PARTITION__"


# --- manifests -----------------------------------------------------------------


def _file_system(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _numbers(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the published manifests, in order: one listing of small files."""
    p, fs = _file_system(spark, f"{path}/_manifests")
    if not fs.exists(p):
        return []
    return sorted(int(st.getPath().getName()) for st in fs.listStatus(p) if st.getPath().getName().isdigit())


def _manifest(spark: SparkSession, path: str, number: int) -> dict:
    p, fs = _file_system(spark, f"{path}/_manifests/{number:09d}")
    stream = fs.open(p)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _newest(spark: SparkSession, path: str) -> dict:
    """The manifest readers go by (number 0 if there is none)."""
    numbers = _numbers(spark, path)
    return _manifest(spark, path, numbers[-1]) if numbers else {"number": 0, "days": {}, "loads": []}


def _publish(spark: SparkSession, path: str, manifest: dict) -> bool:
    """Make a manifest the newest; False if another writer took its number."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    draft, fs = _file_system(spark, f"{path}/_manifests/_draft-{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    out.write(json.dumps(manifest).encode())
    out.close()
    final = jvm.org.apache.hadoop.fs.Path(f"{path}/_manifests/{manifest['number']:09d}")
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.NONE
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf).rename(
            fs.makeQualified(draft), fs.makeQualified(final), how
        )
    except Exception as exc:
        fs.delete(draft, False)
        if "FileAlreadyExistsException" in str(exc):
            return False
        raise
    return True


def _path(gold_path: str, name: str) -> str:
    return f"{gold_path.rstrip('/')}/{name}"


def _new_load(number: int) -> str:
    return f"{number:09d}-{uuid.uuid4().hex[:8]}"


def _live_loads(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the loads that readers need."""
    m = _newest(spark, path)
    return sorted({int(x.split("-")[0]) for x in [*m.get("loads", []), *m.get("days", {}).values()]})


# --- reading -------------------------------------------------------------------


def read_gold(spark: SparkSession, gold_path: str, name: str, manifest: dict | None = None) -> DataFrame | None:
    """Current content of a Gold table (None when it was never loaded)."""
    path = _path(gold_path, name)
    m = manifest or _newest(spark, path)
    if not m["number"]:
        return None
    schema = spark.createDataFrame([], GOLD_DDL[name]).schema.add(LOAD, "string")
    reader = spark.read.schema(schema).option("basePath", path)
    if name in DAYS:
        folders = [f"{path}/{LOAD}={load}/{DAYS[name]}={day}" for day, load in m["days"].items()]
        rows = reader.parquet(*folders) if folders else empty_table(spark, name)
    else:
        rows = reader.parquet(*[f"{path}/{LOAD}={load}" for load in m["loads"]])
        if len(m["loads"]) > 1:
            pick = keep_earliest if MERGE_MODE[name] == "insert" else keep_latest
            place = F.array_position(F.array(*[F.lit(x) for x in m["loads"]]), F.col(LOAD))
            rows = pick(rows.withColumn("_lk_place", place).drop(LOAD), GOLD_KEYS[name], ["_lk_place"])
    return rows.select(*GOLD_COLUMNS[name])


def _in_days(day: str, days: list[str]):
    """The rows of the given days (named as their folders): a filter on the partitions."""
    known = [dt.date.fromisoformat(d) for d in days if d != NO_DAY]
    some = F.col(day).isin(known) if known else F.lit(False)
    return some | F.col(day).isNull() if NO_DAY in days else some


def _day_names(days: DataFrame, day: str) -> list[str]:
    """Distinct days as folder names: as many as the calendar has."""
    return sorted(NO_DAY if r[0] is None else str(r[0]) for r in days.select(day).distinct().collect())


# --- loading -------------------------------------------------------------------


def _typed(spark: SparkSession, name: str, rows: DataFrame) -> DataFrame:
    types = {f.name: f.dataType for f in spark.createDataFrame([], GOLD_DDL[name]).schema.fields}
    return rows.select(*[F.col(c).cast(types[c]).alias(c) for c in GOLD_COLUMNS[name]])


def _write_days(spark: SparkSession, path: str, load: str, rows: DataFrame, day: str) -> dict[str, str]:
    """Write rows by day (a large day is split by AQE); the days written, with their load."""
    folder = f"{path}/{LOAD}={load}"
    rows.hint("rebalance", day).write.partitionBy(day).parquet(folder)
    p, fs = _file_system(spark, folder)
    names = [st.getPath().getName() for st in fs.listStatus(p)]
    return {n.split("=", 1)[1]: load for n in names if n.startswith(f"{day}=")}


def _merge_days(spark: SparkSession, gold_path: str, name: str, m: dict, rows: DataFrame) -> dict:
    """The manifest after ``rows`` (one per key): the days they touch are written anew."""
    path, day, keys = _path(gold_path, name), DAYS[name], GOLD_KEYS[name]
    current = read_gold(spark, gold_path, name, m)
    days = rows.select(day)
    if current is not None:
        # older versions may lie on other days; only keys and days of the table are read
        days = days.unionByName(current.select(*keys, day).join(rows.select(*keys), keys, "left_semi").select(day))
    touched = _day_names(days, day)
    out = rows
    if current is not None and touched:
        out = current.filter(_in_days(day, touched)).join(rows.select(*keys), keys, "left_anti").unionByName(rows)
    load = _new_load(m["number"] + 1)
    written = _write_days(spark, path, load, out, day)
    left = {d: x for d, x in m["days"].items() if d not in touched}
    return {"number": m["number"] + 1, "days": left | written, "touched": touched}


def add_rows(
    spark: SparkSession, gold_path: str, name: str, rows: DataFrame, upto: int | None = None, quality: dict | None = None
) -> int:
    """One load of a Gold table: keyed rows only, one per key.

    ``upto``: what the source has been read to, kept for the next load.
    ``quality``: the load's counts, kept in its manifest.
    """
    path = _path(gold_path, name)
    rows = collapse_source(rows.select(*GOLD_COLUMNS[name]), GOLD_KEYS[name], latest=MERGE_MODE[name] != "insert")
    rows = _typed(spark, name, rows)
    load = None
    if name in DAYS:  # read several times, and again if another load comes first
        aside = scratch_path(spark, f"gold-{name}")
        rows.write.parquet(aside)
        rows = spark.read.schema(rows.schema).parquet(aside)
    while True:
        m = _newest(spark, path)
        if name in DAYS:
            new = _merge_days(spark, gold_path, name, m, rows)
        else:
            if load is None:
                load = _new_load(m["number"] + 1)
                rows.write.parquet(f"{path}/{LOAD}={load}")
            new = {"number": m["number"] + 1, "loads": [*m["loads"], load]}
        new["upto"] = m.get("upto") if upto is None else upto
        if quality is not None:
            new["quality"] = quality
        if _publish(spark, path, new):
            return new["number"]


def compact(spark: SparkSession, gold_path: str, name: str) -> int | None:
    """Write the current rows as one load; readers go by it from now on."""
    path = _path(gold_path, name)
    while True:
        m = _newest(spark, path)
        if not m["number"]:
            return None
        load = _new_load(m["number"] + 1)
        rows = read_gold(spark, gold_path, name, m)
        new = {"number": m["number"] + 1, "upto": m.get("upto"), "touched": []}
        if name in DAYS:
            new["days"] = _write_days(spark, path, load, rows, DAYS[name])
        else:
            rows.write.parquet(f"{path}/{LOAD}={load}")
            new["loads"] = [load]
        if _publish(spark, path, new):
            return new["number"]


def vacuum(spark: SparkSession, gold_path: str, name: str, keep: int = 2) -> list[str]:
    """Remove the loads that the newest ``keep`` manifests do not need, and the manifests before.

    For times without a running load or a reader of an older manifest.
    """
    path = _path(gold_path, name)
    numbers = _numbers(spark, path)
    needed: set[str] = set()
    for n in numbers[-keep:]:
        m = _manifest(spark, path, n)
        needed |= {*m.get("loads", []), *m.get("days", {}).values()}
    gone = []
    p, fs = _file_system(spark, path)
    for st in fs.listStatus(p) if numbers else []:
        folder = st.getPath().getName()
        if folder.startswith(f"{LOAD}=") and folder.split("=", 1)[1] not in needed:
            fs.delete(st.getPath(), True)
            gone.append(folder)
    for n in numbers[:-keep]:
        old, fs = _file_system(spark, f"{path}/_manifests/{n:09d}")
        fs.delete(old, False)
    return sorted(gone)


def refresh_settlement(spark: SparkSession, gold_path: str, fee_rate: str = marts.DEFAULT_FEE_RATE) -> list[str]:
    """U4 over A1: the settlement of the days that facts have touched since the last refresh.

    These days are computed from all their facts and replaced whole, so groups that
    became empty go.  Groups with a NULL key cannot enter the keyed table.
    Returns the days.
    """
    name, facts = "fact_settlement_daily", "fact_transactions"
    path, day = _path(gold_path, name), DAYS["fact_settlement_daily"]
    while True:
        m, base = _newest(spark, path), _newest(spark, _path(gold_path, facts))
        since, numbers = m.get("upto") or 0, _numbers(spark, _path(gold_path, facts))
        if base["number"] == since:
            return []
        news = [n for n in numbers if n > since]
        if news[0] == since + 1:
            touched = sorted({d for n in news for d in _manifest(spark, _path(gold_path, facts), n).get("touched", [])})
        else:  # manifests in between have been removed
            touched = sorted({*base["days"], *m["days"]})
        tx = read_gold(spark, gold_path, facts, base).filter(_in_days(DAYS[facts], touched))
        rows = marts.settlement_daily(tx, fee_rate)
        for key in GOLD_KEYS[name]:
            rows = rows.filter(F.col(key).isNotNull())
        number = m["number"] + 1
        written = _write_days(spark, path, _new_load(number), _typed(spark, name, rows), day)
        left = {d: x for d, x in m["days"].items() if d not in touched}
        if _publish(spark, path, {"number": number, "days": left | written, "touched": touched, "upto": base["number"]}):
            return touched


def load_gold(
    spark: SparkSession, staged: DataFrame, gold_path: str, fee_rate: str = marts.DEFAULT_FEE_RATE, with_clock: bool = True
) -> list[str]:
    """Silver -> Gold: every table absorbs one staged Silver load.

    The cost is that of the load, of the days of facts it touches, and of the facts' key
    column, which says on which days older versions lie.
    """
    aside = scratch_path(spark, "gold-staged")
    counted, seen = Q.observed(staged, LOAD_CHECKS, "gold-load")
    counted.write.parquet(aside)  # read once per table
    inc = gold_increment(spark.read.schema(staged.schema).parquet(aside), fee_rate, with_clock)
    for name, rows in inc.items():
        if name != "fact_settlement_daily":
            add_rows(spark, gold_path, name, rows, quality=seen.get if name == "fact_transactions" else None)
    refresh_settlement(spark, gold_path, fee_rate)
    return sorted(inc)


def load_quality(spark: SparkSession, gold_path: str) -> list[dict]:
    """Q1/Q4/Q6 counts of the facts' loads in order, as counted on the way: nothing is read again."""
    path = _path(gold_path, "fact_transactions")
    found = [_manifest(spark, path, n) for n in _numbers(spark, path)]
    return [m["quality"] for m in found if "quality" in m]


def load_signals(spark: SparkSession, signals: DataFrame, gold_path: str, upto: int | None = None) -> int:
    """K3/R2: the stream's fraud signals into ``fact_fraud_signals``; the first signal of an id stays."""
    return add_rows(spark, gold_path, "fact_fraud_signals", signals, upto)


def signals_upto(spark: SparkSession, gold_path: str) -> int:
    """The last epoch of the stream whose signals Gold holds (-1: none)."""
    upto = _newest(spark, _path(gold_path, "fact_fraud_signals")).get("upto")
    return -1 if upto is None else upto


# --- catalog tables --------------------------------------------------------------


def create_tables(spark: SparkSession, gold_path: str, prefix: str = "") -> list[str]:
    """Every Gold table under its name in the catalog, for any session.

    The files of a manifest are an external table with its partitions; the name is a view
    on it with the declared columns.  A call after a load moves the view to the newest
    manifest and then drops the table of the one before (its files stay).
    """
    return [_create_table(spark, gold_path, name, prefix) for name in GOLD_DDL]


def _create_table(spark: SparkSession, gold_path: str, name: str, prefix: str) -> str:
    view, path = prefix + name, _path(gold_path, name)
    m = _newest(spark, path)
    columns = ", ".join(GOLD_COLUMNS[name])
    if not m["number"] or (name in DAYS and not m["days"]):
        fields = spark.createDataFrame([], GOLD_DDL[name]).schema.fields
        nulls = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS {f.name}" for f in fields)
        spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT {nulls} WHERE FALSE")
        return view
    table = f"{view}_files_{m['number']}"
    parts = f"{LOAD}, {DAYS[name]}" if name in DAYS else LOAD
    if not spark.catalog.tableExists(table):
        location = path.replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE {table} ({GOLD_DDL[name]}, {LOAD} STRING) USING parquet PARTITIONED BY ({parts}) LOCATION '{location}'"
        )
        if name in DAYS:
            day = DAYS[name]
            specs = [
                f"PARTITION ({LOAD}='{load}', {day}={'null' if d == NO_DAY else repr(d)})" for d, load in m["days"].items()
            ]
        else:
            specs = [f"PARTITION ({LOAD}='{load}')" for load in m["loads"]]
        for k in range(0, len(specs), 500):
            spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {' '.join(specs[k : k + 500])}")
    if name in DAYS or len(m["loads"]) == 1:
        body = f"SELECT {columns} FROM {table}"
    else:
        keys = ", ".join(GOLD_KEYS[name])
        rest = [c for c in GOLD_COLUMNS[name] if c not in GOLD_KEYS[name]]
        order = ", ".join(f"'{x}'" for x in m["loads"])
        best = "min" if MERGE_MODE[name] == "insert" else "max"
        row = ", ".join([f"array_position(array({order}), {LOAD}) AS place", *rest])
        body = (
            f"SELECT {', '.join(c if c in GOLD_KEYS[name] else f'r.{c} AS {c}' for c in GOLD_COLUMNS[name])} FROM "
            f"(SELECT {keys}, {best}(struct({row})) AS r FROM {table} GROUP BY {keys})"
        )
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS {body}")
    for old in spark.catalog.listTables(pattern=f"{view}_files_*"):
        if old.name != table:
            spark.sql(f"DROP TABLE IF EXISTS {old.name}")
    return view
