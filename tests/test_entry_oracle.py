"""Driver contract: entry() and every query against its DuckDB oracle."""

import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from ledgerlake.catalog import QUERIES
from ledgerlake.sources.tables import DRIVER_TABLES
from tools.check_oracle import digest



def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["merchant_id", "currency", "dt", "txn_count", "gross_amount", "fees", "net_amount"]


def test_every_query_of_the_catalog_has_an_oracle():
    assert set(QUERIES) <= set(E.queries()) and set(QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


def test_entry_works_without_the_optional_subpackage():
    code = (
        "import sys\n"
        "class Gone:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name in ('ledgerlake.llm', 'corpus_pipeline'):\n"
        "            raise ModuleNotFoundError(f'No module named {name}', name=name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as E\n"
        "assert E.queries() and set(E.queries()) == set(E.QUERIES)\n"
    )
    root = os.path.dirname(os.path.abspath(E.__file__))
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, timeout=120)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    res = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(srows) == len(orows)
    assert digest(df.columns, srows)[0] == digest(ocols, orows)[0]


@pytest.mark.parametrize("name", ["ts_normalize", "stream_velocity_window", "validate_route", "dim_date"])
def test_results_do_not_depend_on_session_time_zone(spark, duck, name):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = E.queries()[name](spark, SF_SMALL)
        srows = [tuple(r) for r in df.collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    res = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert digest(df.columns, srows)[0] == digest(ocols, res.fetchall())[0]
