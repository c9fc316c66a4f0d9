"""Parse log text and set dirty lines aside."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.record import record_of


def parse_log(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """Add ``rec`` (record map), ``mid``, ``is_new``, ``ts`` and ``dirty``.

    ``dirty`` names why a line cannot be processed, NULL for good lines:
    ``unparsable`` (not one complete JSON object), ``no_mid`` (the key every
    job partitions by is missing) or ``no_ts`` (no event time). The reference
    fails its job on the last two; here no line stops a job.
    """
    # The parse is the costly step. It is produced through a one-row
    # generator, so filters on its fields (good/dirty splits downstream) are
    # evaluated on the parsed value instead of being pushed below and parsing
    # again. Key fields are read from the variant by path; the record map is a
    # projection above, so plans that never read ``rec`` (the flag-repair
    # aggregate) skip building it.
    df = raw.select("*", F.inline(F.array(F.struct(
        F.try_parse_json(F.col(value_col)).alias("_v")))))
    v = F.col("_v")
    is_object = v.isNotNull() & F.col(value_col).rlike(r"^\s*\{")
    rec = F.when(is_object, record_of(v))
    mid = F.try_variant_get(v, "$.common.mid", "string")
    ts = F.try_variant_get(v, "$.ts", "bigint")
    dirty = (F.when(~is_object, F.lit("unparsable"))
             .when(mid.isNull(), F.lit("no_mid"))
             .when(ts.isNull(), F.lit("no_ts")))
    keep = [c for c in df.columns if c != "_v"]
    return df.select(*keep, rec.alias("rec"), mid.alias("mid"),
                     F.try_variant_get(v, "$.common.is_new", "string").alias("is_new"),
                     ts.alias("ts"), dirty.alias("dirty"))


def dirty_split(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, dirty) halves of a parsed log. Both are filters of one plan;
    jobs that need both in one pass use the ``dirty`` column directly (see
    :func:`tidemark.operators.split.fan_out`)."""
    return parsed.filter(F.col("dirty").isNull()), parsed.filter(F.col("dirty").isNotNull())
