"""Unique visitor per device and day, batch form.

A page record starts a visit when its ``last_page_id`` is null (an empty
string counts as present). The first such record per (device, date) is kept.

Plan: ``min_by(columns, (ts, seq))`` per (mid, date). The partial step reduces
a device holding a third of the rows before the shuffle, and no group is sorted
in one task. Pass ``keep`` to carry only the columns the caller needs through
the aggregate: variable-length ones make Spark aggregate by sorting.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.time import arrival, to_date


def unique_visitor(page_log: DataFrame, zone: str = "UTC", keep: tuple[str, ...] | None = None) -> DataFrame:
    """The first visit start per device and day: its columns (or ``keep``)
    and ``visit_date``."""
    lp = F.try_element_at(F.col("page"), F.lit("last_page_id"))
    starts = (page_log.filter(lp.isNull())
                      .withColumn("visit_date", to_date(F.col("ts"), zone)))
    cols = [c for c in keep or page_log.columns if c != "mid"]
    first = (starts.groupBy("mid", "visit_date")
                   .agg(F.min_by(F.struct(*cols), arrival("ts", "seq")).alias("r")))
    return first.select("mid", "r.*", "visit_date")
