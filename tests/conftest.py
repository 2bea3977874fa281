import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
DATA = os.path.join(os.path.dirname(os.path.abspath(__file__)), "data")
SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from ledgerlake.session import build_session

    s = build_session("local[4]", app_name="ledgerlake-tests", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def seed(spark):
    from ledgerlake.sources.seeds import payments_seed

    return payments_seed(spark, os.path.join(DATA, "payments_seed.csv")).drop("event_date")


@pytest.fixture(scope="session")
def blacklist(spark):
    from ledgerlake.sources.seeds import blacklist_seed

    return blacklist_seed(spark, os.path.join(DATA, "blacklist_seed.csv"))


def rows_of(spark, rows, ddl):
    return spark.createDataFrame(rows, ddl)
