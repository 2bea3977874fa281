import duckdb
import pytest

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.fixture()
def odd_documents(spark):
    """NULLs in every column, empty, white and very long texts, ties, repeats, clashing names."""
    long = "alpha beta gamma delta epsilon " * 4000
    rows = [
        (1, None, None, None, None, "h"),
        (2, "", "en", "src0", 0, None),
        (3, "   \n\t ", "en", "src0", 6, "x"),
        (4, "one two", "en", None, 7, "x"),
        (5, long, "en", "src1", len(long), "x"),
        (6, long, "en", "src1", len(long), "x"),
        (6, long, "en", "src1", len(long), "x"),
        (None, "no id here", "de", "src1", 10, "x"),
        (7, "  double  blanks\n\nand wide été ", "fr", "src2", 5, "x"),
    ]
    ddl = "doc_id long, text string, lang string, source string, n_chars long, kept string"
    return spark.createDataFrame(rows, ddl)
