"""Small helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.session import scratch_path

#: A word is a run of characters other than space and the controls 9 to 13.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
SPACE_PATTERN = r"[\x20\x09-\x0D]+"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back.

    Cuts the lineage with files every executor can read, so a lost executor
    costs no recomputation, and several consumers share one evaluation.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_path = path
    return out


def discard(*frames: DataFrame) -> None:
    """Remove the folders of staged DataFrames that nothing unwritten reads any more."""
    for df in frames:
        sc = df.sparkSession.sparkContext
        p = sc._jvm.org.apache.hadoop.fs.Path(df.staged_path)
        p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def byte_slices(batches, column: str = "text", limit: int = 8 << 20):
    """Cut Arrow batches into slices of about ``limit`` bytes of ``column``.

    Every row lands in exactly one slice; a single longer text is a slice of
    its own, so memory is bounded by the limit and the longest text.
    """
    import numpy as np
    import pyarrow.compute as pc

    for batch in batches:
        if batch.num_rows == 0:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        group = np.cumsum(size, dtype=np.int64) // limit
        cuts = np.flatnonzero(np.diff(group)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
            yield batch.slice(a, b - a)
