"""Broadcast only behind a size check."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

DEFAULT_MAX_ROWS = 100_000


def sized_broadcast(df: DataFrame, max_rows: int = DEFAULT_MAX_ROWS) -> DataFrame:
    """``broadcast(df)`` when it holds at most ``max_rows`` rows, else ``df``
    unchanged so the join falls back to a shuffle (sort-merge) plan.

    The check counts at most ``max_rows + 1`` rows of the side (a small job on
    a small side); it is meant for config and dictionary relations, whose size
    is bounded by the number of tables or codes, not by the data.
    """
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df
