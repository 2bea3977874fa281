"""Keyed-table maintenance as pure DataFrame functions.

Parquet tables have no MERGE, so each upsert returns the *new* table and
publishing it (write a new version, then switch) is a separate step.  Key
matching is a left-anti join: when the incoming batch is small, AQE turns it
into a broadcast hash join and the target is streamed once without a shuffle.
Several source rows with one key are collapsed first (``keep_latest``, a
map-side-combined aggregate), so no key is written twice.
NULL keys cannot enter a keyed table; they are dropped here and counted by the
quality checks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .dedup import keep_earliest, keep_latest


def _non_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    cond = None
    for k in keys:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    return df.filter(cond)


def collapse_source(source: DataFrame, keys: Sequence[str], order: Sequence[str] = (), latest: bool = True) -> DataFrame:
    """One source row per key: the latest (or earliest) by ``order``, then the
    remaining columns as tie-break."""
    src = _non_null_keys(source, keys)
    pick = keep_latest if latest else keep_earliest
    return pick(src, list(keys), list(order))


def _with_order(source: DataFrame, target: DataFrame, order: Sequence[str]) -> DataFrame:
    """Source in target column order, plus order-only columns (dropped later)."""
    extra = [o for o in order if o not in target.columns]
    return source.select(*target.columns, *extra)


def insert_if_absent(
    target: DataFrame, source: DataFrame, keys: Sequence[str], order: Sequence[str] = (), latest: bool = False
) -> DataFrame:
    """Add source rows whose key is not in target; existing rows never change.

    One anti join of the collapsed source against the target's key columns.
    """
    src = collapse_source(_with_order(source, target, order), keys, order, latest=latest).select(*target.columns)
    return target.unionByName(src.join(target.select(*keys), list(keys), "left_anti"))


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Insert new keys, overwrite existing ones with the source row."""
    src = collapse_source(_with_order(source, target, order), keys, order, latest=True).select(*target.columns)
    return target.join(src.select(*keys), list(keys), "left_anti").unionByName(src)
