"""Exact top-k inner products by tiled matrix products.

Every vector component x becomes floor(1024 * x); scores are integer inner
products. Vectors are packed into blocks of at most ``tile`` rows without a
shuffle, one matrix a row of the block table. Query blocks meet candidate
blocks in an equi-join on the query block's number, each pair is one tile: one
matrix product, and a partial selection of its k best per query. The lists of a
query are then merged as a tree, first those of the same group of shards, then
the groups, so no task sees all lists of all shards.

The work is |queries| x |rows| by definition; what moves is each candidate
block once per query block, and k pairs per query and tile.

Vectors that are null or empty, or that hold null or non-finite components,
take no part; nor do rows with a null vec_id. A query meets only vectors of its
own length. Of rows that repeat a query's vec_id, the smallest vector (as
arrays compare) is the query; none of them is its candidate. Repeated
candidate rows are all listed. An empty table gives no rows.
Products are exact: in doubles while every partial sum stays under 2**53, else
in Python integers, clamped to the range of a long.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

SCALE = 1024
TILE = 2048
#: Lists merged at one node of the tree.
FAN_IN = 32


def _usable(v: Column) -> Column:
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return v.isNotNull() & (F.size(v) > 0) & F.coalesce(fine, F.lit(False))


def _blocks(tile: int):
    """Packs rows (vec_id, v) into blocks of one vector length."""
    def pack(ids: list, rows: list) -> pa.RecordBatch:
        m = np.array(rows, dtype="<f8")
        top = float(np.abs(m).max())
        return pa.RecordBatch.from_pydict({"dim": pa.array([m.shape[1]], pa.int32()),
                                           "ids": pa.array([np.array(ids, "<i8").tobytes()], pa.binary()),
                                           "mat": pa.array([m.tobytes()], pa.binary()),
                                           "top": pa.array([top], pa.float64())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[list, list]] = {}
        for b in batches:
            v = b.column("v")
            flat = np.floor(v.flatten().to_numpy(zero_copy_only=False) * float(SCALE))
            ends = np.cumsum(v.value_lengths().to_numpy(zero_copy_only=False))
            for i, end, n in zip(b.column("vec_id").to_pylist(), ends, np.diff(ends, prepend=0)):
                ids, rows = held.setdefault(int(n), ([], []))
                ids.append(i)
                rows.append(flat[end - n:end])
                if len(ids) == tile:
                    yield pack(*held.pop(int(n)))
        for ids, rows in held.values():
            yield pack(ids, rows)
    return run


BLOCK = "dim int, ids binary, mat binary, top double"


def _best_of(k: int):
    """The k best of each query of a tile, as parallel lists."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                q = np.floor(np.array([x["v"] for x in r["queries"]], "<f8") * SCALE)
                c = np.frombuffer(r["mat"], "<f8").reshape(-1, r["dim"])
                qid = np.array([x["vec_id"] for x in r["queries"]], "<i8")
                cid = np.frombuffer(r["ids"], "<i8")
                if np.abs(q).max() * r["top"] * r["dim"] < 2.0**53:
                    s = (q @ c.T).astype(np.int64)
                else:
                    exact = np.array([[int(x) for x in row] for row in q], object) @ \
                        np.array([[int(x) for x in row] for row in c], object).T
                    s = np.array([[max(-2**63 + 1, min(2**63 - 1, x)) for x in row] for row in exact], np.int64)
                by_id = np.argsort(cid, kind="stable")
                s, cid = s[:, by_id], cid[by_id]
                own = qid[:, None] == cid[None, :]
                out_q, out_c, out_s = [], [], []
                for i in range(len(qid)):
                    row, ok = s[i], ~own[i]
                    if ok.sum() > k:  # the k-th best score, then all at or over it
                        at = ok & (row >= np.partition(row[ok], -k)[-k])
                    else:
                        at = ok
                    at = np.flatnonzero(at)
                    at = at[np.argsort(-row[at], kind="stable")][:k]
                    out_q.append(int(qid[i]))
                    out_c.append(cid[at].tolist())
                    out_s.append(row[at].tolist())
                yield pa.RecordBatch.from_pydict({
                    "query_id": pa.array(out_q, pa.int64()),
                    "shard": pa.array([r["shard"]] * len(out_q), pa.int64()),
                    "ids": pa.array(out_c, pa.list_(pa.int64())),
                    "scores": pa.array(out_s, pa.list_(pa.int64()))})
    return run


def _merged(lists: DataFrame, by: list, k: int) -> DataFrame:
    """The k best of the lists of each group; ties to the smaller vec_id."""
    zipped = F.transform(F.arrays_zip("ids", "scores"),
                         lambda x: F.struct((-x["scores"]).alias("less"), x["ids"].alias("vec_id")))
    best = F.slice(F.array_sort(F.flatten(F.collect_list(zipped))), 1, k)
    return lists.groupBy(*by).agg(best.alias("best"))


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, tile: int = TILE) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for every row of ``vectors``
    (vec_id, embedding) where ``is_query`` holds, the k rows of highest
    integer inner product, or all if there are fewer."""
    v = (vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                        F.col("embedding").cast("array<double>").alias("v"), is_query.alias("is_query"))
         .filter(F.col("vec_id").isNotNull() & _usable(F.col("v"))))
    n = v.agg(F.count(F.lit(1)).alias("rows"), F.count_if("is_query").alias("queries")).first()
    groups = max(1, -(-n["queries"] // tile))
    # A pair of a query group and a share of the blocks is one join key: no key
    # holds more than a few blocks, however few query groups there are.
    shares = max(1, -(-n["rows"] // (4 * tile)))
    q = (v.filter("is_query").groupBy("vec_id").agg(F.min("v").alias("v"))
         .withColumn("g", F.pmod(F.xxhash64("vec_id"), F.lit(groups)))
         .groupBy("g", F.size("v").alias("dim")).agg(F.collect_list(F.struct("vec_id", "v")).alias("queries"))
         .select("g", "dim", "queries", F.explode(F.sequence(F.lit(0), F.lit(shares - 1))).alias("share")))
    c = (v.select("vec_id", "v").mapInArrow(_blocks(tile), BLOCK)
         .withColumn("shard", F.xxhash64("ids"))
         .withColumn("share", F.pmod("shard", F.lit(shares)).cast("int"))
         .select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))).alias("g")))
    lists = q.join(c.hint("merge"), ["g", "share", "dim"]).mapInArrow(
        _best_of(k), "query_id long, shard long, ids array<long>, scores array<long>")
    nodes = max(1, -(-n["rows"] // tile))
    while nodes > FAN_IN:
        nodes = -(-nodes // FAN_IN)
        lists = (_merged(lists, ["query_id", F.pmod("shard", F.lit(nodes)).alias("shard")], k)
                 .select("query_id", "shard", F.col("best.vec_id").alias("ids"),
                         F.transform("best", lambda x: -x["less"]).alias("scores")))
    return (_merged(lists, ["query_id"], k)
            .select("query_id", F.posexplode("best").alias("pos", "b"))
            .select("query_id", (F.col("pos") + 1).alias("rank"), F.col("b.vec_id").alias("vec_id"),
                    (-F.col("b.less")).alias("score")))


SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 1024)) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 100 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s)
SELECT query_id, n::INTEGER AS rank, vec_id, score FROM r WHERE n <= 10
"""
