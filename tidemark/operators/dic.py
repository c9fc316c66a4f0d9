"""Code dictionary (J4) and the lookup join that enriches facts."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators.asof import asof_join, validity
from tidemark.operators.broadcast import sized_broadcast
from tidemark.schemas import BASE_DIC
from tidemark.sources.literal import literal_frame

# Status codes of the warehouse, in code order. Names are ours
# (English); codes and groups are what facts carry.
CODES = (
    ("1001", "unpaid"), ("1002", "paid"), ("1003", "cancelled"), ("1004", "finished"),
    ("1005", "refunding"), ("1006", "refund done"),
    ("1101", "alipay"), ("1102", "wechat"), ("1103", "unionpay"),
    ("1201", "good review"), ("1202", "average review"), ("1203", "bad review"),
    ("1204", "automatic review"),
    ("1301", "quality problem"), ("1302", "not as described"), ("1303", "out of stock"),
    ("1304", "wrong size"), ("1305", "ordered by mistake"), ("1306", "no longer wanted"),
    ("1307", "other reason"),
    ("1401", "coupon unused"), ("1402", "coupon in use"), ("1403", "coupon used"),
    ("1501", "refund money only"), ("1502", "return goods and refund"),
    ("2401", "user query"), ("2402", "product promotion"), ("2403", "smart recommendation"),
    ("2404", "promotion campaign"),
    ("3101", "rule full reduction"), ("3102", "rule quantity discount"), ("3103", "rule discount"),
    ("3201", "coupon full reduction"), ("3202", "coupon quantity discount"), ("3203", "voucher"),
    ("3301", "range category3"), ("3302", "range trademark"), ("3303", "range spu"),
)

# Order status letter of the test tables -> status code.
ORDER_STATUS_CODE = (("F", "1004"), ("O", "1001"), ("P", "1002"))


def code_dictionary(spark: SparkSession) -> DataFrame:
    """J4 as the ``base_dic`` relation: parent code = the first two digits."""
    rows = [(c, n, c[:2], None, None) for c, n in CODES]
    return literal_frame(spark, rows, BASE_DIC)


def read_dictionary(spark: SparkSession, source: str = "literal", **options) -> DataFrame:
    """The lookup table from JDBC (``source='jdbc'`` with url/dbtable/...),
    a parquet folder (``path``), or the literal codes. :func:`lookup_batch_writer`
    calls it again for every micro-batch whose copy is older than the time to live."""
    if source == "jdbc":
        return spark.read.format("jdbc").options(**options).load()
    if source == "parquet":
        return spark.read.schema(BASE_DIC).parquet(options["path"])
    return code_dictionary(spark)


def status_code(status_col: str, mapping=ORDER_STATUS_CODE) -> F.Column:
    expr = None
    for letter, code in mapping:
        expr = (F.when(F.col(status_col) == letter, F.lit(code)) if expr is None
                else expr.when(F.col(status_col) == letter, F.lit(code)))
    return expr


def dic_lookup(fact: DataFrame, dic: DataFrame, code_col: str = "dic_code",
               max_dic_rows: int = 100_000) -> DataFrame:
    """Left join on the code; a missing code gives null names. The
    dictionary is broadcast when its size check passes."""
    d = dic.select(F.col("dic_code").alias("_code"), "dic_name", "parent_code")
    j = fact.join(sized_broadcast(d, max_dic_rows), F.col(code_col) == F.col("_code"), "left")
    return j.drop("_code")


def dictionary_history(changes: DataFrame, at: str = "at") -> DataFrame:
    """Versions of the codes from their changes ``(at, dic_code, dic_name, parent_code)``:
    each holds from its position up to the code's next change. A change without
    name takes the code out."""
    v = validity(changes, ["dic_code"], at, [at, "dic_name"])
    return v.filter(F.col("dic_name").isNotNull()).select(
        F.col("dic_code").alias("_code"), "dic_name", "parent_code", "valid_from", "valid_to")


def dic_lookup_asof(fact: DataFrame, history: DataFrame, at: str, ttl: int = 0, code_col: str = "dic_code",
                    max_dic_rows: int = 100_000) -> DataFrame:
    """J3 with a dictionary that changes: each fact sees the entries of its own position.
    With ``ttl`` it sees those of the last refresh, positions that are multiples of ``ttl``:
    what a cache with that time to live answers. A code unknown then gives null names."""
    seen = F.col(at) - F.pmod(F.col(at), F.lit(ttl)) if ttl else F.col(at)
    f = fact.withColumn("_at", seen.cast("bigint"))
    return asof_join(f, history, [(code_col, "_code")], "_at", how="left", max_rows=max_dic_rows).drop("_at")


def lookup_batch_writer(load, write, code_col: str = "dic_code", ttl_s: float = 3600.0, clock=time.monotonic):
    """``foreachBatch`` body of a lookup on a stream: the dictionary is read by ``load()``
    and read again once it is ``ttl_s`` old (the reference caches for an hour); ``write``
    gets (enriched batch, batch id)."""
    held: dict = {}

    def body(batch: DataFrame, batch_id: int) -> None:
        if not held or clock() - held["at"] >= ttl_s:
            held.update(dic=load(), at=clock())
        write(dic_lookup(batch, held["dic"], code_col), batch_id)
    return body
