"""As-of joins: what was valid at a row's own position.

A changelog becomes intervals of validity; a fact meets the interval of its key that
holds its position. Both are plain relational steps: a window over the changes of
a key and an equi-join with a range condition, broadcast behind a size check.
Beyond the check the versions are cut at the borders of ``width`` positions and
joined on (key, border slot) as well, so a key with a third of all facts is
spread over its slots instead of meeting its whole history in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.operators.broadcast import sized_broadcast


def validity(changes: DataFrame, keys: list[str], at: str, order: list[str] | None = None) -> DataFrame:
    """``changes`` with ``valid_from`` (their position) and ``valid_to`` (that of
    the key's next change, null for the last). Of changes of a key at one position only
    the last by ``order`` is ever valid: the intervals of the others are empty and
    are left out."""
    w = Window.partitionBy(*keys).orderBy(*(order or [at]))
    out = changes.withColumn("valid_from", F.col(at)).withColumn("valid_to", F.lead(at).over(w)).drop(at)
    return out.filter(F.col("valid_to").isNull() | (F.col("valid_to") > F.col("valid_from")))


def asof_join(facts: DataFrame, versions: DataFrame, on: list[tuple[str, str]], at: str, how: str = "inner",
              max_rows: int = 100_000, width: int | None = None) -> DataFrame:
    """Each fact with the version of its key whose interval holds ``at``. A fact
    without position, or before the first version, has none (``how='left'`` keeps it). ``on``: pairs of
    (fact column, version column). ``width``: positions per slot, for versions beyond ``max_rows``."""
    sized = sized_broadcast(versions, max_rows)
    cond = (F.col("valid_from") <= F.col(at)) & (F.col("valid_to").isNull() | (F.col(at) < F.col("valid_to")))
    for f, v in on:
        cond = cond & (facts[f] == versions[v])
    if sized is versions and width:
        slot = lambda c: F.floor(c / F.lit(width)).cast("bigint")
        ends = facts.agg(F.max(at).alias("hi"), F.min(at).alias("lo")).first()
        if ends["hi"] is not None:
            last = F.least(F.coalesce(F.col("valid_to") - 1, F.lit(ends["hi"])), F.lit(ends["hi"]))
            first = F.greatest(F.col("valid_from"), F.lit(ends["lo"]))
            sized = versions.filter(first <= last).withColumn("_slot_v", F.explode(F.sequence(slot(first), slot(last))))
            facts = facts.withColumn("_slot_f", slot(F.col(at)))
            cond = cond & (F.col("_slot_f") == F.col("_slot_v"))
    j = facts.join(sized, cond, how)
    return j.drop("valid_from", "valid_to", "_slot_f", "_slot_v", *[v for _, v in on if v not in facts.columns])
