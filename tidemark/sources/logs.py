"""Log sources.

A log source yields ``value STRING`` (the JSON text) and ``seq BIGINT`` (its
arrival position: the Kafka offset, or a column of a file source). Kafka also
gives ``src_ts`` (the record's time, ms) and ``part`` (its partition), since
offsets of different partitions have no order. A null
Kafka payload becomes a null ``value`` rather than an error, as in the
reference's deserializer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.schemas import RAW_LOG


#: What one micro-batch takes unless the caller says otherwise.
MAX_RECORDS, MAX_FILES = 20_000_000, 1000


def _from_kafka(df: DataFrame) -> DataFrame:
    return df.select(F.col("value").cast("string").alias("value"),
                     F.col("offset").cast("bigint").alias("seq"),
                     F.unix_millis("timestamp").alias("src_ts"), F.col("partition").cast("int").alias("part"))


def read_log(spark: SparkSession, source: str, path_or_topic: str,
             options: dict | None = None, seq_col: str = "seq") -> DataFrame:
    """Batch read of a log.

    ``source``: ``kafka`` (``path_or_topic`` is the topic, ``options`` carry
    ``kafka.bootstrap.servers`` and offsets), ``parquet``/``json``/``orc``
    (a folder holding ``value`` and ``seq`` columns) or ``text`` (one JSON per
    line; ``seq`` is then unknown and left null).
    """
    options = dict(options or {})
    if source == "kafka":
        r = spark.read.format("kafka").option("subscribe", path_or_topic)
        return _from_kafka(r.options(**options).load())
    if source == "text":
        df = spark.read.options(**options).text(path_or_topic)
        return df.select(F.col("value"), F.lit(None).cast("bigint").alias("seq"))
    df = spark.read.format(source).options(**options)
    if source == "json":
        df = df.schema(RAW_LOG)
    df = df.load(path_or_topic)
    return df.select(F.col("value").cast("string"), F.col(seq_col).cast("bigint").alias("seq"))


def read_log_stream(spark: SparkSession, source: str, path_or_topic: str,
                    options: dict | None = None, seq_col: str = "seq") -> DataFrame:
    """Streaming twin of :func:`read_log` (``startingOffsets`` replaces the
    reference's consumer-group offsets; Spark keeps offsets in the query's
    checkpoint). A micro-batch takes at most ``maxOffsetsPerTrigger`` records (files:
    ``maxFilesPerTrigger``), so a job that starts behind catches up in bounded steps."""
    options = dict(options or {})
    if source == "kafka":
        options.setdefault("maxOffsetsPerTrigger", MAX_RECORDS)
        r = spark.readStream.format("kafka").option("subscribe", path_or_topic)
        return _from_kafka(r.options(**options).load())
    options.setdefault("maxFilesPerTrigger", MAX_FILES)
    r = spark.readStream.format(source).options(**options)
    if source in ("parquet", "json", "orc"):
        r = r.schema(RAW_LOG)
    df = r.load(path_or_topic)
    if source == "text":
        return df.select(F.col("value"), F.lit(None).cast("bigint").alias("seq"))
    return df.select(F.col("value").cast("string"), F.col(seq_col).cast("bigint").alias("seq"))


def from_rows(spark: SparkSession, values: list[str]) -> DataFrame:
    """An in-memory log for tests; ``seq`` is the list position."""
    return spark.createDataFrame([(v, i) for i, v in enumerate(values)], RAW_LOG)
