"""Deduplication.

``keep_latest`` is written as an aggregation, not as ``row_number()`` over a
window: ``max(struct(order..., rest...))`` is combined map-side (partial
aggregate) before the shuffle, so a key with millions of copies costs one row
per map task in the exchange instead of landing whole in one window partition.
Struct comparison is lexicographic with NULL lowest, which is exactly
``ORDER BY order DESC NULLS LAST`` followed by every other column as a
deterministic tie-break: the same input always yields the same survivor.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_ROW = "_lk_row"


def keep_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per ``keys``: the row greatest by ``order`` (DESC NULLS LAST)."""
    keys, order = list(keys), list(order)
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.struct(*[F.col(c) for c in order + rest])
    return (
        df.groupBy(*keys)
        .agg(F.max(packed).alias(_ROW))
        .select(*[F.col(k) for k in keys], *[F.col(f"{_ROW}.{c}").alias(c) for c in order + rest])
        .select(*df.columns)
    )


def keep_earliest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per ``keys``: the row smallest by ``order`` (ASC NULLS FIRST)."""
    keys, order = list(keys), list(order)
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.struct(*[F.col(c) for c in order + rest])
    return (
        df.groupBy(*keys)
        .agg(F.min(packed).alias(_ROW))
        .select(*[F.col(k) for k in keys], *[F.col(f"{_ROW}.{c}").alias(c) for c in order + rest])
        .select(*df.columns)
    )


def distinct_rows(df: DataFrame, columns: Sequence[str], not_null: Sequence[str] = ()) -> DataFrame:
    """Distinct values of ``columns``, rows with a NULL in ``not_null`` dropped."""
    out = df.select(*columns)
    for c in not_null:
        out = out.filter(F.col(c).isNotNull())
    return out.distinct()
