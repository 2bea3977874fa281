"""Feeding a file-source stream in event-time order, one epoch per chunk.

Used to replay a table through the streaming job (backfills, tests): the
messages are cut into ``chunks`` consecutive time ranges; each chunk is
written as JSON-lines files and the query is (re)started from its checkpoint
with ``availableNow`` -- so every chunk is a new epoch and every restart
exercises checkpoint recovery (T2).
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rules as R
from ..operators import quality as Q
from ..plans import screening as SCR
from ..sources import messages as M
from . import screening_job as J


#: Input bytes (as stored) that a partition of a stream takes before there are more than two per core.
PARTITION_BYTES = 32 << 20


def stream_partitions(spark: SparkSession, path: str) -> int:
    """Partitions of a stream's shuffles and state over the files below ``path``.

    Every partition opens and commits its state stores (four for a join) in every batch,
    or writes its own files, whether it has rows or not, and a stream's partitions are not
    coalesced.  So there are two per core, more with the input, never more than the session has.
    """
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    size = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(p).getLength()
    most = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return min(most, max(2 * spark.sparkContext.defaultParallelism, -(-size // PARTITION_BYTES)))


@contextmanager
def _partitioned(spark: SparkSession, path: str):
    """Streams started inside have ``stream_partitions`` (a restart keeps those of its checkpoint)."""
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, str(stream_partitions(spark, path)))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def chunk_bounds(messages: DataFrame, ts: str, chunks: int):
    """Cut points splitting [min ts, max ts] into ``chunks`` equal spans
    (one small aggregate; only two timestamps reach the driver)."""
    row = messages.agg(F.unix_micros(F.min(F.col(ts).cast("timestamp"))).alias("lo"),
                       F.unix_micros(F.max(F.col(ts).cast("timestamp"))).alias("hi")).first()
    lo, hi = row["lo"], row["hi"]
    if lo is None:
        return []
    step = (hi - lo) / chunks
    return [int(lo + step * i) for i in range(1, chunks)]


def replay(
    spark: SparkSession,
    messages: DataFrame,
    layout: J.StreamLayout,
    ts: str = "ts_event",
    chunks: int = 3,
    params: R.RuleParams = R.DEFAULT_PARAMS,
    rules: tuple[str, ...] = SCR.STREAM_RULES,
    snapshot_every: int = 32,
) -> None:
    """Write ``messages`` (``value`` + ``ts``) chunk by chunk and run the job."""
    cuts = chunk_bounds(messages, ts, chunks)
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    # messages without a usable time go first
    chunk = sum((F.coalesce(micros >= F.lit(c), F.lit(False)).cast("int") for c in cuts), F.lit(0))
    base = layout.base.rstrip("/")
    # all chunks are written in one pass, whose tasks are all busy however the table is ordered
    staged = messages.select("value", chunk.alias("chunk")).write.mode("overwrite").partitionBy("chunk")
    # static: nothing of a replay that was cut short stays
    staged.option("partitionOverwriteMode", "static").text(f"{base}/staged")
    for i in range(len(cuts) + 1):
        path = _arrive(spark, f"{base}/staged/chunk={i}", f"{base}/inbox/chunk={i:05d}")
        with _partitioned(spark, path):
            query = J.start(
                M.read_stream(spark, path=f"{base}/inbox"), layout, params, rules, available_now=True, snapshot_every=snapshot_every
            )
            query.awaitTermination()


def _arrive(spark: SparkSession, staged: str, path: str) -> str:
    """Move a staged folder into the inbox in place of what an earlier run left there; one without rows arrives empty."""
    source, target = (spark.sparkContext._jvm.org.apache.hadoop.fs.Path(x) for x in (staged, path))
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.delete(target, True)
    fs.mkdirs(target.getParent())
    if not (fs.rename(source, target) if fs.exists(source) else fs.mkdirs(target)):
        raise OSError(f"{staged} cannot be moved to {path}")
    return path


def stage_table(df: DataFrame, path: str, files: int = 8) -> str:
    """Write a derived table as Parquet so a file stream can read it."""
    df.repartition(files).write.mode("overwrite").parquet(path)
    return path


def run_in_order(
    spark: SparkSession, df: DataFrame, transform, base: str, ts: str = "ts_event", arrival: str | None = None,
    chunks: int = 5, close_after: str = "3 days", metrics: dict[str, int] | None = None,
) -> tuple[DataFrame, int]:
    """Feed ``df`` to a streaming ``transform`` in order of arrival (default: event time).

    The rows are written once, cut into ``chunks`` ranges of arrival; each range
    is one restart from the checkpoint.  At last comes a marker row,
    ``close_after`` past the newest event and with no other column, that moves
    the watermark past all open windows; its own window stays open, so it is
    never returned.  Returns the output and the number of rows the watermark
    dropped as late.  ``metrics`` takes the sums of what the stream observes.
    """
    by = arrival or ts
    bounds = chunk_bounds(df, by, chunks)
    micros = F.unix_micros(F.col(by).cast("timestamp"))
    # NULL times go first
    chunk = sum((F.coalesce(micros >= F.lit(b), F.lit(False)).cast("int") for b in bounds), F.lit(0))
    columns = [c for c in df.columns if c != arrival]
    df.withColumn("_lk_chunk", chunk).hint("rebalance", "_lk_chunk").write.partitionBy("_lk_chunk").parquet(f"{base}/staged")
    staged = spark.read.parquet(f"{base}/staged")
    schema = df.select(*columns).schema
    late = 0
    for k in range(len(bounds) + 2):
        if k <= len(bounds):
            rows = staged.filter(F.col("_lk_chunk") == k).select(*columns)
        else:
            newest = staged.agg((F.max(ts) + F.expr(f"INTERVAL {close_after}")).alias(ts)).filter(F.col(ts).isNotNull())
            rows = newest.select(*[F.col(c) if c == ts else F.lit(None).cast(schema[c].dataType).alias(c) for c in columns])
        rows.write.mode("append").parquet(f"{base}/input")
        stream = spark.readStream.schema(schema).parquet(f"{base}/input")
        with _partitioned(spark, f"{base}/staged"):
            late += _run(transform(stream), f"{base}/output", f"{base}/_checkpoint", metrics=metrics)
    out = transform(spark.createDataFrame([], schema)).schema
    return spark.read.schema(out).parquet(f"{base}/output"), late


def _run(
    stream: DataFrame, path: str, checkpoint: str, output_mode: str = "append", metrics: dict[str, int] | None = None
) -> int:
    """Run over everything available; the rows dropped as late."""
    q = (
        stream.writeStream.format("parquet")
        .outputMode(output_mode)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    counts = Q.progress_metrics(q.recentProgress)
    for name, n in counts.items() if metrics is not None else ():
        metrics[name] = metrics.get(name, 0) + n
    return counts["late_rows"]


def run_to_parquet(stream: DataFrame, path: str, checkpoint: str, output_mode: str = "append") -> str:
    """Run a streaming DataFrame over everything available into Parquet."""
    _run(stream, path, checkpoint, output_mode)
    return path
