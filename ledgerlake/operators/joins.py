"""Joins with lookup lists.

No size is counted here: AQE measures the lookup side in bytes and broadcasts
it below ``spark.sql.autoBroadcastJoinThreshold``, and splits skewed keys of a
shuffle join beyond.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def lookup_join(df: DataFrame, lookup: DataFrame, on: str | Sequence[str], how: str = "left") -> DataFrame:
    """Join a lookup side; the strategy follows its measured size."""
    return df.join(lookup, on, how)
