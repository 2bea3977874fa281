"""Host-level quality rules: odd rows, verdicts, plan without Python."""

import re

from pyspark.sql import functions as F

from ledgerlake.llm import quality_rules as Q
from ledgerlake.llm.queries import ORACLE, QUERIES
from llm_data import SF_SMALL, documents, duck, odd_documents  # noqa: F401
from tools.check_oracle import digest


def brute(text):
    t = text or ""
    ws = re.findall(r"[^\x20\x09-\x0D]+", t)
    grams = {}
    for i in range(len(ws) - 2):
        grams.setdefault(tuple(ws[i : i + 3]), []).append(i)
    rep = {j for v in grams.values() if len(v) > 1 for i in v for j in (i, i + 1, i + 2)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(rep))


def test_counts_equal_brute_force_on_odd_rows(odd_documents):
    got = Q.assess(odd_documents).select("doc_id", *Q.STAT_COLUMNS, "base_failed", "kept").collect()
    want = sorted(((str(r["doc_id"]),) + brute(r["text"])) for r in odd_documents.collect())
    assert sorted((str(r["doc_id"]),) + tuple(r[c] for c in Q.STAT_COLUMNS) for r in got) == want
    assert all(r["base_failed"] and not r["kept"] for r in got)


def test_empty_table(odd_documents):
    assert Q.assess(odd_documents.limit(0)).count() == 0
    assert Q.keep_good(odd_documents.limit(0)).count() == 0


def test_host_verdicts_shrink_and_reject(spark):
    good = " ".join(f"word{i}" for i in range(60))
    noisy = " ".join(f"a### b{i}" for i in range(60))
    rows = [(i, good, "fine") for i in range(200)] + [(1000 + i, noisy, "bad") for i in range(200)]
    rows += [(2000 + i, noisy if i % 4 else good, "mixed") for i in range(200)] + [(3000, noisy, "one")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = {r["doc_id"]: r for r in Q.assess(docs).collect()}
    assert out[0]["host_verdict"] == "pass" and out[0]["kept"]
    assert out[1000]["host_verdict"] == "reject" and not out[1000]["kept"]
    assert out[2000]["host_verdict"] == "suspect" and out[2000]["kept"] and not out[2001]["kept"]
    # one failing document alone does not condemn its host as surely as 200 do
    assert out[3000]["host_rate"] < out[1000]["host_rate"]
    kept = {r["doc_id"] for r in Q.keep_good(docs).collect()}
    assert kept == {i for i, r in out.items() if r["kept"]}


def test_query_matches_sql_and_runs_no_python(spark, duck):
    df = QUERIES["op4_host_quality"](spark, SF_SMALL)
    res = duck.execute(ORACLE["op4_host_quality"])
    cols = [d[0] for d in res.description]
    assert digest(df.columns, [tuple(r) for r in df.collect()])[0] == digest(cols, res.fetchall())[0]
    assert "Python" not in df._jdf.queryExecution().toString()


def test_keep_good_returns_the_columns_unchanged(spark, documents):
    kept = Q.keep_good(documents.withColumn("kept", F.lit("x")))
    assert kept.columns == documents.columns + ["kept"]
    assert kept.count() == QUERIES["op4_host_quality"](spark, SF_SMALL).filter("kept").count()


def test_long_texts_pass_the_filter_in_linear_time(spark, documents):
    import time

    text = " ".join(f"word{i}" for i in range(20_000))
    docs = spark.createDataFrame([(i, text, "en", "host", len(text)) for i in range(4)], documents.schema)
    t0 = time.time()
    assert Q.keep_good(docs).count() == 4
    # also where the filter is pushed down to the counting of words
    assert Q.rule_flags(Q.document_stats(docs, ["doc_id"]), Q.HostRules()).filter("NOT base_failed").count() == 4
    assert time.time() - t0 < 30


def test_the_filter_reads_written_flags(documents):
    plan = Q.keep_good(documents)._jdf.queryExecution().optimizedPlan().toString()
    assert "split(" not in plan and "transform(" not in plan
