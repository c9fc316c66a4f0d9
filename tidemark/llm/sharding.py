"""Sharding by a hierarchical weighted hash tree.

A row's key descends from the root through region, rack and shard. At every
node each child draws -ln(u) / weight, u a uniform hash of the key and the
child's name, and the least draw wins, so a child gets rows in proportion to its
weight and its draw doesn't depend on its siblings. When weights change, a row
moves only towards a subtree whose weight grew or out of one whose weight fell; all other
subtrees keep their rows.

The law is ``key``: doc_id and the tree alone decide. :func:`tree` lays the
first ``BASE`` shards out in regions of two racks of four; every further shard is a
region of its own, so one shard more changes the weight of one subtree, which
holds nothing else: rows move into the new shard only.

Slots number a shard's rows without gaps, in the order of md5(doc_id), doc_id
(null first), size and checksum. They come from running counts in two levels, so no
task sorts a shard: rows equal in all output columns are counted before
anything moves and share a range of slots, ranges are summed in narrow buckets of
the order, bucket totals in a small table, and long ranges are written out in
pieces. A doc_id that a third of all rows repeat thus stays one row until the end.

Everything is DataFrame expressions. Rows with the same doc_id are in the same
shard; null doc_ids count as one key. Null texts have no bytes. An empty table
gives no rows. Extra columns are kept by :func:`write_shards` and can't clash, :func:`place`
doesn't read them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import or_empty, stored

SHARDS, OVERHEAD = 24, 8
RACK, REGION = 4, 2
#: Shards laid out in full regions; later ones are regions of their own.
BASE = 24
#: Ranges of a bucket, the most buckets of a shard, and rows of a piece.
BUCKET_ROWS, MOST_BUCKETS, PIECE = 20_000, 1 << 12, 4096

#: {region: {rack: {shard: weight}}}
Tree = dict[int, dict[int, dict[int, float]]]


def tree(shards: int, base: int = BASE) -> Tree:
    """The tree of ``shards`` shards of weight 1."""
    out: Tree = {}
    for s in range(min(shards, base)):
        rack = s // RACK
        out.setdefault(rack // REGION, {}).setdefault(rack, {})[s] = 1.0
    for s in range(base, shards):
        # names beyond those of any full region and rack
        out[base + s] = {base + s: {s: 1.0}}
    return out


def _weight(node) -> float:
    return sum(map(_weight, node.values())) if isinstance(node, dict) else float(node)


def _draw(key: Column, level: str, child: int, weight: float) -> Column:
    """-ln(u) / weight; u from 52 bits of md5, never 0."""
    digits = F.substring(F.md5(F.concat(key, F.lit(f":{level}{child}")).cast("binary")), 1, 13)
    u = (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))
    return -F.ln(u) / F.lit(weight)


def _winner(key: Column, level: str, node: dict) -> Column:
    """The child of the least draw; equal draws go to the smaller name."""
    alive = [(c, w) for c, w in ((c, _weight(x)) for c, x in sorted(node.items())) if w > 0]
    if len(alive) == 1:
        return F.lit(alive[0][0])
    return F.array_min(F.array(*[F.struct(_draw(key, level, c, w).alias("draw"), F.lit(c).alias("child"))
                                 for c, w in alive]))["child"]


def key_text(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.col(doc_id).cast("string"), F.lit("null"))


def with_shard(rows: DataFrame, t: Tree, out: str, doc_id: str = "doc_id") -> DataFrame:
    """``rows`` with the shard of each one's doc_id. Every level is one column, so that
    a row draws in the subtrees it enters only."""
    key = key_text(doc_id)
    region, rack = f"{out}_region", f"{out}_rack"
    rows = rows.withColumn(region, _winner(key, "r", t))

    def pick(at: str, choices: dict[int, Column]) -> Column:
        c = None
        for name, col in choices.items():
            c = F.when(F.col(at) == name, col) if c is None else c.when(F.col(at) == name, col)
        return c

    rows = rows.withColumn(rack, pick(region, {g: _winner(key, "k", racks) for g, racks in t.items() if _weight(racks)}))
    racks = {k: shards for g in t.values() for k, shards in g.items() if _weight(shards)}
    return (rows.withColumn(out, pick(rack, {k: _winner(key, "s", shards) for k, shards in racks.items()}))
            .drop(region, rack))


def place(docs: DataFrame, shards: int = SHARDS, bucket_rows: int = BUCKET_ROWS, piece: int = PIECE) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row."""
    text = or_empty().cast("binary")
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                    (F.octet_length(text) + OVERHEAD).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    same = ["doc_id", "size", "text_crc32"]
    d = d.groupBy(*same).agg(F.count(F.lit(1)).alias("copies"))
    d = with_shard(with_shard(d, tree(shards), "shard"), tree(shards + 1), "grown_shard")
    d = stored(d.withColumn("place", F.md5(key_text().cast("binary"))))
    groups = d.count()
    buckets = max(1, min(MOST_BUCKETS, groups // (bucket_rows * max(1, shards)) + 1))
    first = F.conv(F.substring("place", 1, 8), 16, 10).cast("long")  # of 2**32
    d = d.withColumn("bucket", F.shiftright(first * F.lit(buckets), 32))
    # one row per shard and bucket
    per = d.groupBy("shard", "bucket").agg(F.sum("copies").alias("_sum"))
    upto = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select("shard", "bucket", F.coalesce(F.sum("_sum").over(upto), F.lit(0)).alias("_before"))
    inside = (Window.partitionBy("shard", "bucket").orderBy("place", *same)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    d = d.join(per, ["shard", "bucket"])
    d = d.withColumn("_from", F.col("_before") + F.sum("copies").over(inside) - F.col("copies"))
    # a long range leaves in pieces, so no list of slots is longer than one
    d = d.withColumn("_at", F.explode(F.sequence(F.col("_from"), F.col("_from") + F.col("copies") - 1,
                                                  F.lit(piece).cast("long"))))
    end = F.least(F.col("_at") + piece, F.col("_from") + F.col("copies")) - 1
    return (d.withColumn("slot", F.explode(F.sequence("_at", end)))
            .select(*same, F.lit("key").alias("law"), "shard", "slot", "grown_shard"))


def write_shards(docs: DataFrame, path: str, t: Tree | None = None, files: int = 1) -> None:
    """Whole rows of ``docs`` under ``path/shard=N``, as ``files`` or more files
    each (a shard's rows are dealt out by a hash of doc_id and text, so a repeated doc_id
    is spread as well)."""
    names = docs.columns
    own = docs.select(F.struct(*[docs[c] for c in names]).alias("_row"), docs["doc_id"].cast("long").alias("doc_id"),
                      F.pmod(F.xxhash64(docs["doc_id"], docs["text"]), F.lit(files)).alias("_file"))
    out = with_shard(own, t or tree(SHARDS), "shard")
    if "shard" in names:
        raise ValueError("documents have a column shard already, which names the folders")
    out = out.repartition("shard", "_file").select("_row.*", "shard")
    out.write.partitionBy("shard").parquet(path)


def _sql(shards: int) -> str:
    """DuckDB SQL of the same rows, with a checksum computed byte by byte (DuckDB has none)."""
    def case(t: Tree) -> str:
        def winner(level: str, node: dict) -> str:
            names = sorted(node)
            if len(names) == 1:
                return str(names[0])
            return "list_min([" + ", ".join(
                f"{{'d': -ln((('0x' || substr(md5(key || ':{level}{c}'), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0)"
                f" / {_weight(node[c])}, 'c': {c}}}" for c in names) + "]).c"
        regions = "".join(f" WHEN {g} THEN CASE {winner('k', racks)}" + "".join(
            f" WHEN {k} THEN {winner('s', s)}" for k, s in racks.items()) + " END" for g, racks in t.items())
        return f"CASE {winner('r', t)}{regions} END"
    def advanced(x: str, bits: int, zeros: int) -> str:
        """x with its low ``bits`` bits put through ``zeros`` steps of the checksum's
        register: linear, so one constant per bit."""
        out = "0"
        for i in range(bits):
            c = 1 << i
            for _ in range(zeros):
                c = c >> 1 ^ (0xEDB88320 if c & 1 else 0)
            out = f"xor({out}, ({x} >> {i} & 1) * {c})"
        return out

    # blocks of 64 bytes, counted from the end, each on its own; then block after block
    return rf"""
WITH raw AS (SELECT row_number() OVER () AS row, doc_id, coalesce(doc_id::VARCHAR, 'null') AS key, regexp_extract_all(hex(encode(coalesce(text, ''))), '..') AS h FROM documents),
one AS (SELECT row, len(h) AS n, unnest(h) AS b, unnest(range(len(h))) AS i FROM raw),
block AS (SELECT row, n, (n - 1 - i) // 64 AS block, list(('0x' || b)::BIGINT ORDER BY i) AS bytes FROM one GROUP BY ALL),
part AS (SELECT row, block, list_reduce(list_prepend(CASE WHEN block = (n - 1) // 64 THEN 4294967295::BIGINT ELSE 0 END, bytes),
           lambda a, b: xor(a >> 8, {advanced("xor(a, b)", 8, 8)})) AS c FROM block),
crc AS (SELECT row, list_reduce(list(c ORDER BY block DESC), lambda a, b: xor(b, {advanced("a", 32, 512)})) AS c FROM part GROUP BY row),
d AS (SELECT doc_id, key, (len(h) + {OVERHEAD})::BIGINT AS size, xor(coalesce(c, 4294967295), 4294967295)::BIGINT AS text_crc32
      FROM raw LEFT JOIN crc USING (row)),
s AS (SELECT *, {case(tree(shards))} AS shard, {case(tree(shards + 1))} AS grown_shard FROM d)
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY md5(key), doc_id NULLS FIRST, size, text_crc32) - 1 AS slot, grown_shard
FROM s
"""


SQL = _sql(SHARDS)
