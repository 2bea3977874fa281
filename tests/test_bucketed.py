"""U1/K3 against a bucketed table, and the stream's signals without reading those before."""

import uuid

from ledgerlake.operators import bucketed as B
from ledgerlake.session import scratch_path
from ledgerlake.streaming import screening_job as J
from test_stream import _messages

DDL = "id string, day int, reason string"


def table(spark, buckets=8):
    name = "t_" + uuid.uuid4().hex[:8]
    return B.create_bucketed(spark, name, scratch_path(spark, "bucketed"), DDL, "id", buckets)


def branch(plan: str, node: str) -> str:
    """The right child of the first ``node`` of a plan's text."""
    lines = plan.splitlines()
    k = next(i for i, line in enumerate(lines) if node in line)
    place = lines[k + 1].index(":- ")
    right = next(i for i in range(k + 1, len(lines)) if lines[i][place : place + 3] == "+- ")
    return "\n".join(lines[right:])


def test_only_absent_rows_enter(spark):
    name = table(spark)
    rows = [(f"i{k}", 1, "first") for k in range(200)] + [(None, 1, "x"), ("i0", 0, "earlier")]
    B.insert_absent(spark, name, spark.createDataFrame(rows, DDL), "id", ["day"])
    assert spark.table(name).count() == 200
    assert spark.table(name).filter("id = 'i0'").first().reason == "earlier"
    later = [(f"i{k}", 2, "again") for k in range(150, 260)] * 2
    for _ in range(2):  # a load that is repeated adds nothing
        B.insert_absent(spark, name, spark.createDataFrame(later, DDL), "id", ["day"])
    got = {r.id: r.reason for r in spark.table(name).collect()}
    assert len(got) == spark.table(name).count() == 260
    assert got["i150"] == "first" and got["i259"] == "again"


def test_the_stored_side_is_never_shuffled(spark):
    name = table(spark)
    B.insert_absent(spark, name, spark.createDataFrame([(f"i{k}", 1, "r") for k in range(500)], DDL), "id")
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        absent = B.absent_rows(spark, name, spark.createDataFrame([("i3", 2, "s"), ("new", 2, "s")], DDL), "id")
        plan = absent._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    stored = branch(plan, "SortMergeJoin")
    assert "Bucketed: true" in stored and "Exchange" not in stored and "SelectedBucketsCount" in stored
    assert "ReadSchema: struct<id:string>" in stored
    # one exchange of the incoming rows, into the table's eight buckets
    assert plan.count("Exchange hashpartitioning(id") == 1 and ", 8)" in plan
    assert [r.id for r in absent.collect()] == ["new"]


def test_no_epoch_reads_the_signals_before(spark, monkeypatch):
    layout = J.StreamLayout(scratch_path(spark, "t-flat"))
    body, values = J.ScreeningBatch(layout), _messages(spark).select("value")
    read = []
    original = J._read_epochs
    monkeypatch.setattr(J, "_read_epochs", lambda s, path, epochs: (read.append(path), original(s, path, epochs))[1])
    for epoch in range(3):  # the same messages again: the first signals stay
        body(values, epoch)
    assert layout.history in read and layout.signals not in read
    monkeypatch.undo()
    signals = J.read_outputs(spark, layout)["signals"].collect()
    assert len({r.transaction_id for r in signals}) == len(signals) > 0
    first = {r.transaction_id for r in original(spark, layout.signals, [0]).collect()}
    assert first and {r.transaction_id for r in signals if r.epoch == 0} == first
    state = J.card_state(spark, layout)
    assert state.count() == state.select("card_hash").distinct().count() > 0


def test_unreadable_amounts_are_dead_letters(spark):
    layout = J.StreamLayout(scratch_path(spark, "t-amount"))
    value = '{"transaction_id":"Z","ts_event":"2026-03-02T12:20:00Z","card_hash":"c","amount":"much"}'
    J.ScreeningBatch(layout)(spark.createDataFrame([(value,)], "value string"), 0)
    letter = J.dead_letters(spark, layout).first()
    assert (letter.transaction_id, letter.amount, letter.reason, letter.raw_value) == ("Z", None, "missing_tx_or_amount", value)
