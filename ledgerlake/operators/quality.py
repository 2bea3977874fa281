"""Q1-Q7: set-based data-quality checks.

Each check returns the violating rows (a DataFrame, empty when the data is
clean); ``suite`` counts violations of many checks with one aggregation pass
per table (``count_if`` per check) and one row per check.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..schemas import REQUIRED_EVENT_FIELDS


def not_null(df: DataFrame, column: str) -> DataFrame:
    """Q1: rows where ``column`` is NULL."""
    return df.filter(F.col(column).isNull())


def unique(df: DataFrame, column: str | Sequence[str]) -> DataFrame:
    """Q2: key values occurring more than once (NULLs ignored), with counts."""
    cols = [column] if isinstance(column, str) else list(column)
    keyed = df.select(*cols)
    for c in cols:
        keyed = keyed.filter(F.col(c).isNotNull())
    return keyed.groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def relationships(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Child rows whose non-NULL key is absent from the parent."""
    keys = parent.select(F.col(field).alias(column)).filter(F.col(column).isNotNull()).distinct()
    return child.filter(F.col(column).isNotNull()).join(keys, column, "left_anti")


def expression_true(df: DataFrame, condition: str | Column) -> DataFrame:
    """Q4: rows where ``condition`` is false (NULL counts as passing)."""
    cond = F.expr(condition) if isinstance(condition, str) else condition
    return df.filter(~F.coalesce(cond, F.lit(True)))


def non_negative(df: DataFrame, column: str = "amount") -> DataFrame:
    """Q4: rows with a negative value."""
    return expression_true(df, F.col(column) >= 0)


def has_required_fields(fields: Sequence[str] = REQUIRED_EVENT_FIELDS) -> Column:
    """Q6: every required field present (not NULL, not empty text)."""
    conds = [F.coalesce(F.col(f).cast("string") != "", F.lit(False)) for f in fields]
    return reduce(lambda a, b: a & b, conds)


def table_has_rows(df: DataFrame) -> bool:
    """Q5: a table has at least one row (stops after the first one)."""
    return not df.isEmpty()


@dataclass(frozen=True)
class Check:
    name: str
    table: str
    column: str
    kind: str  # not_null | unique | relationships | expression
    parent: str | None = None
    field: str | None = None
    condition: str | None = None


def violated(check: Check) -> Column:
    """Does a row violate a not_null or expression check?"""
    if check.kind == "not_null":
        return F.col(check.column).isNull()
    if check.kind == "expression":
        return ~F.coalesce(F.expr(check.condition), F.lit(True))
    raise ValueError(f"{check.kind} is not decided row by row")


def row_metrics(checks: Sequence[Check]) -> list[Column]:
    """One count per row-wise check, and of all rows, for ``DataFrame.observe``."""
    return [F.count(F.lit(1)).alias("rows"), *[F.count_if(violated(c)).alias(c.name) for c in checks]]


def observed(df: DataFrame, checks: Sequence[Check], name: str = "quality") -> tuple[DataFrame, Observation]:
    """``df`` that counts violations on its way: ``get`` of the observation after the first whole action on it.

    The table is not read again; a task that is run twice counts once.
    """
    seen = Observation(f"{name}-{uuid.uuid4().hex[:8]}")
    return df.observe(seen, *row_metrics(checks)), seen


def observed_stream(df: DataFrame, checks: Sequence[Check], name: str = "quality") -> DataFrame:
    """A stream that counts violations on its way; its progress carries them per micro-batch."""
    return df.observe(name, *row_metrics(checks))


def progress_metrics(progress: Sequence, name: str = "quality") -> dict[str, int]:
    """The sums of a stream's counts over micro-batches, and the rows its watermarks dropped as late."""
    total: dict[str, int] = {"late_rows": 0}
    for p in progress:
        total["late_rows"] += sum(op.numRowsDroppedByWatermark for op in p.stateOperators)
        if name in (p.observedMetrics or {}):
            for metric, count in p.observedMetrics[name].asDict().items():
                total[metric] = total.get(metric, 0) + count
    return total


def suite(tables: dict[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """Q7: one row per check with its violation count.

    not_null / expression checks of one table share one aggregation pass;
    unique and relationships checks each need their own shuffle.
    """
    parts: list[DataFrame] = []
    by_table: dict[str, list[Check]] = {}
    for c in checks:
        if c.kind in ("not_null", "expression"):
            by_table.setdefault(c.table, []).append(c)
    for table, cs in by_table.items():
        aggs = []
        for c in cs:
            aggs.append(F.count_if(violated(c)).alias(c.name))
        counts = tables[table].agg(*aggs)
        stack = ", ".join(f"'{c.name}', '{c.table}', '{c.column}', `{c.name}`" for c in cs)
        parts.append(counts.select(F.expr(f"stack({len(cs)}, {stack}) AS (check_name, table_name, column_name, violations)")))
    for c in checks:
        if c.kind == "unique":
            v = unique(tables[c.table], c.column).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("violations"))
        elif c.kind == "relationships":
            v = relationships(tables[c.table], c.column, tables[c.parent], c.field).agg(F.count(F.lit(1)).alias("violations"))
        else:
            continue
        parts.append(
            v.select(
                F.lit(c.name).alias("check_name"), F.lit(c.table).alias("table_name"), F.lit(c.column).alias("column_name"), "violations"
            )
        )
    out = reduce(lambda a, b: a.unionByName(b), parts)
    return out.select("check_name", "table_name", "column_name", F.col("violations").cast("long").alias("violations"))
