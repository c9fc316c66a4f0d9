"""K1/K2: Kafka-shaped outputs.

K1: the routed frame already has a ``topic`` column, so one writer feeds
every topic. Spark's Kafka sink is at-least-once; exactly-once output goes
through :func:`write_topics_files` (each run is committed once) instead.
K2: keyed messages — JSON key and JSON value, a null value meaning delete — and the
changelog of a keyed table: :func:`keyed_changes` between two of its versions,
:func:`compacted` from messages back to a version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.sinks.runs import write_run


def kafka_frame(routed: DataFrame, key_col: str | None = "mid") -> DataFrame:
    """``(topic, key, value)`` as the Kafka sink expects (key = device id, so
    one device's records stay in one partition and keep their order)."""
    key = F.col(key_col).cast("string") if key_col else F.lit(None).cast("string")
    return routed.select("topic", key.alias("key"), F.col("value").cast("string"))


def write_topics(routed: DataFrame, servers: str, options: dict | None = None) -> None:
    """Batch write of all topics in one job."""
    (kafka_frame(routed).write.format("kafka")
        .option("kafka.bootstrap.servers", servers).options(**(options or {})).save())


def write_topics_stream(routed: DataFrame, servers: str, checkpoint: str,
                        options: dict | None = None, trigger: dict | None = None):
    w = (kafka_frame(routed).writeStream.format("kafka")
         .option("kafka.bootstrap.servers", servers)
         .option("checkpointLocation", checkpoint).options(**(options or {})))
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


def write_topics_files(routed: DataFrame, path: str, run: str, once: bool = False) -> None:
    """Topic outputs as a parquet table partitioned by ``topic`` and ``run``.
    A repeated run replaces its own files in every topic, or with ``once`` writes
    nothing (see :mod:`tidemark.sinks.runs`). ``path/topic=<name>`` is one topic's folder,
    usable as a file stream source."""
    write_run(routed, path, run, ("topic",), once=once)


def to_keyed_messages(df: DataFrame, key_cols: list[str],
                      delete_col: str | None = None) -> DataFrame:
    """K2: ``(key, value)`` JSON texts; ``value`` is null when ``delete_col``
    is true (a tombstone)."""
    key = F.to_json(F.struct(*[F.col(c) for c in key_cols]))
    value = F.to_json(F.struct(*[F.col(c) for c in df.columns if c != delete_col]))
    if delete_col:
        value = F.when(~F.col(delete_col), value)
    return df.select(key.alias("key"), value.alias("value"))


def keyed_changes(old: DataFrame, new: DataFrame, key_cols: list[str]) -> DataFrame:
    """What turns the keyed table ``old`` into ``new``: ``(key, value)`` messages, an
    upsert for every key that is new or whose row differs, a tombstone for every
    key that is gone, nothing for equal rows.

    Both versions hold one row per key and have the same columns. Rows are
    compared by a 128-bit digest of their value, so the old side crosses the one
    shuffle as its key and digest only.
    """
    cols = [c for c in old.columns if c not in key_cols]
    key = F.to_json(F.struct(*[F.col(c) for c in key_cols]))
    value = F.to_json(F.struct(*[F.col(c) for c in old.columns]))
    # nulls keep their place, so that no two rows share a text
    digest = F.md5(F.to_json(F.array(*[F.coalesce(F.to_json(F.struct(F.col(c).alias("v"))), F.lit("")) for c in cols]))
                   if cols else F.lit(""))
    null = F.lit(None).cast("string")
    a = old.select(key.alias("key"), digest.alias("was"), null.alias("now"), null.alias("value"))
    b = new.select(*old.columns).select(key.alias("key"), null.alias("was"), digest.alias("now"), value.alias("value"))
    g = a.unionByName(b).groupBy("key").agg(F.max("was").alias("was"), F.max("now").alias("now"),
                                            F.max("value").alias("value"))
    return g.filter(~F.col("was").eqNullSafe(F.col("now"))).select("key", "value")


def compacted(messages: DataFrame, at: str = "seq") -> DataFrame:
    """``(key, value)``: the last message of every key, without those whose last one is
    a tombstone. Partial aggregation keeps a hot key from meeting in one task."""
    last = messages.groupBy("key").agg(F.max_by(F.struct("value"), at).alias("l"))
    return last.filter(F.col("l.value").isNotNull()).select("key", "l.value")


def from_messages(messages: DataFrame, schema) -> DataFrame:
    """The rows that upserts carry."""
    return messages.filter(F.col("value").isNotNull()).select(F.from_json("value", schema).alias("r")).select("r.*")
