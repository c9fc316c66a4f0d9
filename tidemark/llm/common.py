"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.session import checkpoint_dir, passing_path

#: White space of all contracts: blank and the five ASCII controls 9 to 13.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
#: Stands for a null doc_id: after every real one.
NO_ID = 2**63 - 1
#: Session setting: whether the shuffle files of a query go when it ends.
FREES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def _freed(spark: SparkSession) -> Iterator[None]:
    """What runs inside leaves no shuffle files behind. Its result is kept elsewhere, so nobody reads
    them again; else they stay until the driver happens to collect its garbage."""
    before = spark.conf.get(FREES, None)
    spark.conf.set(FREES, "true")
    try:
        yield
    finally:
        spark.conf.unset(FREES) if before is None else spark.conf.set(FREES, before)


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared checkpoint folder."""
    checkpoint_dir(df.sparkSession)
    with _freed(df.sparkSession):
        return df.select("*").checkpoint(eager=True)  # a query of its own: the setting counts where one is made


def few(df: DataFrame, most: int = 100_000) -> DataFrame:
    """``df`` (already computed) as the side of a join: broadcast if it has at most
    ``most`` rows, which is counted, else as it is."""
    return F.broadcast(df) if df.count() <= most else df


def or_empty(text: str = "text") -> Column:
    return F.coalesce(F.col(text), F.lit(""))


def keyed(docs: DataFrame, unique: bool | None = None) -> DataFrame:
    """``doc_id`` (null: NO_ID), ``tag`` and ``text`` (null: empty) of every row.

    (doc_id, tag) is a key of the row's content: tag is 0 where doc_id is
    unique and a fingerprint of the text where rows repeat a doc_id, so that
    findings made on one of them never fall on another text. ``unique``
    saves the count that settles this.
    """
    d = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"),
                    or_empty().alias("text"))
    if unique is None:
        n = d.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("doc_id").alias("ids")).first()
        unique = n["n"] == n["ids"]
    return d.select("doc_id", (F.lit(0).cast("long") if unique else F.xxhash64("text")).alias("tag"),
                    "text")


def keep_rows(docs: DataFrame, kept: DataFrame, once: bool = True) -> DataFrame:
    """The rows of ``docs``, all columns, whose key is in ``kept`` (doc_id,
    tag as :func:`keyed` gives them); ``once``: one row of those with the same key."""
    names = docs.columns
    own = docs.select(F.struct(*[docs[c] for c in names]).alias("_row"),
                      F.coalesce(docs["doc_id"].cast("long"), F.lit(NO_ID)).alias("doc_id"),
                      F.coalesce(docs["text"], F.lit("")).alias("text"))
    n = own.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("doc_id").alias("ids")).first()
    if n["n"] == n["ids"]:
        out = own.join(kept.select("doc_id"), "doc_id", "left_semi")
    else:
        out = own.withColumn("tag", F.xxhash64("text")).join(
            kept.select("doc_id", "tag"), ["doc_id", "tag"], "left_semi")
        out = out.dropDuplicates(["doc_id", "tag"]) if once else out
    return out.select("_row.*")


def real_id(col: str = "doc_id") -> Column:
    """The doc_id as it was: null for NO_ID."""
    return F.when(F.col(col) != NO_ID, F.col(col))


def one_spaced(data: bytes) -> bytes:
    """White-space runs replaced by one blank, at both ends too."""
    if not data:
        return data
    out = b" ".join(data.split())
    if not out:
        return b" "
    return b" " * (data[:1].isspace()) + out + b" " * (data[-1:].isspace())




def stored(df: DataFrame) -> DataFrame:
    """``df`` written once as Parquet in the shared checkpoint folder and read
    back: smaller than a checkpoint, and readers prune columns. Deleted with the application."""
    path = passing_path(df.sparkSession, f"table-{uuid.uuid4().hex}")
    with _freed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread_join(rows: DataFrame, info: DataFrame, key: str, by: str, salts: int = 64) -> DataFrame:
    """``rows`` with what ``info`` (one row per key) says of their ``key``. The
    rows of a hot key are spread over ``salts`` keys by a hash of ``by``, and
    ``info`` is copied to those that occur."""
    r = rows.withColumn("_salt", F.pmod(F.xxhash64(by), F.lit(salts)))
    met = r.select(key, "_salt").distinct()
    return r.join(info.join(met, key).hint("merge"), [key, "_salt"]).drop("_salt")
