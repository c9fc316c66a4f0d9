"""Mixing sources to target weights by weighted fair queueing.

Every source gets a target: its weight's share of the total, at most
``epochs`` times its own size, the excess going to the others by weight
(water-filling). Every copy of a shuffled document then gets a virtual time, the
tokens of its source up to the middle of this copy divided by the source's
target. All copies of all sources are sorted by it and the mix is cut where the
total budget is used up; the copy at the cut is in if at least half of it fits. By the
middle rather than the end, a source stops within half a document of its target on either
side. Documents longer than their source's whole target queue behind the others
of the source, so they never stand in the way.

Rows equal in doc_id, source, size and text are one group of copies until the end:
they are counted before anything is sorted, queue in runs of at most 1/``RUNS`` of the
target, and the mix may take some of them only.

Both running sums (tokens within a source, tokens of the mix) are two-level:
rows fall into narrow buckets of the shuffle order (then of the virtual time),
bucket totals are summed over a table of buckets, and each bucket is summed on
its own, so no task holds a hot source. The text is read once; afterwards only the narrow
table of ids and sizes moves.

Null texts have size 0, and a document of size 0 is never taken; nor is anything of an
empty table. A text of any length is one document. Null sources form one source, ordered
last. The shuffle order is md5(doc_id:md5(text):epoch), so rows that share a doc_id (or have
none) are spread like others, and a rerun takes the same copies however the
rows were dealt out. Other columns are not read by :func:`mix`; :func:`mixed` carries them along
whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import WORD, cut, few, or_empty, stored

EPOCHS = 3
#: Runs of equal rows a target is cut into, and rows of a piece when they are written out.
RUNS, PIECE = 256, 4096
#: Rows of a bucket, and the most buckets (their table is summed in order by
#: one task; beyond it, buckets grow).
BUCKET_ROWS, MOST_BUCKETS = 2_000, 1 << 17


def source_targets(sizes: DataFrame, epochs: int = EPOCHS) -> DataFrame:
    """source, sid, weight, source_size, target from rows (source, size).

    The weights are 1, 2, 3, repeating, over the sources by code point, null
    last. Sources are a catalogue: their table is small beside the documents,
    and its two window functions may run in one task.
    """
    s = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    s = s.withColumn("sid", F.row_number().over(by_name))
    s = s.withColumn("weight", ((F.col("sid") - 1) % 3 + 1).cast("long"))
    # A source is capped if its cap per weight lies under the common level.
    # With sources by cap / weight, the level after k capped ones is
    # (total - their caps) / (weights of the rest).
    cap = F.col("source_size") * epochs
    by_ratio = Window.orderBy(cap / F.col("weight"), F.col("source").isNull(), "source")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = (s.withColumn("_left", F.sum("source_size").over(everything)
                      - F.coalesce(F.sum(cap).over(before), F.lit(0)))
          .withColumn("_w", F.sum("weight").over(rest)))
    level = F.col("_left").cast("double") / F.col("_w")
    s = s.withColumn("_nth", F.row_number().over(by_ratio)).withColumn("_own", level)
    free = F.when(cap.cast("double") >= F.col("weight") * F.col("_own"), F.col("_nth"))
    s = s.withColumn("_level", F.min_by("_own", free).over(everything))
    return s.select("source", "sid", "weight", "source_size",
                    F.least(cap.cast("double"), F.col("weight") * F.coalesce("_level", F.lit(0.0)))
                    .alias("target"))


def _running(df: DataFrame, group: list[str], bucket: str, order: list, size: str,
             out: str) -> DataFrame:
    """Adds ``out``: the sum of ``size`` over the rows of the same ``group`` up
    to and with this one, by ``bucket`` and within it by ``order``; rows that tie
    in ``order`` share the sum."""
    keys = [*group, bucket]
    per = df.groupBy(*keys).agg(F.sum(size).alias("_sum"))
    upto = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    per = per.select(*keys, F.coalesce(F.sum("_sum").over(upto), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*keys).orderBy(*order)
    return (df.join(per, keys).withColumn(out, F.col("_before") + F.sum(size).over(inside))
              .drop("_before"))


GROUP = ["doc_id", "sid", "size", "h"]


def _sized() -> list[Column]:
    return [F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
            F.regexp_count(or_empty(), F.lit(WORD)).cast("long").alias("size"),
            F.md5(or_empty().cast("binary")).alias("h")]


def _taken(docs: DataFrame, epochs: int, bucket_rows: int) -> DataFrame:
    """doc_id, source, sid, size, h, rows, source_size, target of every group of equal
    rows, and took: how many of them the mix takes in each epoch."""
    d = cut(docs.select(*_sized()).groupBy("doc_id", "source", "size", "h").agg(F.count(F.lit(1)).alias("rows")))
    t = few(cut(source_targets(d.select("source", (F.col("size") * F.col("rows")).alias("size")), epochs).withColumnRenamed(
        "source", "_source")))
    # from here on a source is its number, which is never null
    d = cut(d.join(t, d["source"].eqNullSafe(t["_source"])).drop("_source", "weight")
            .withColumn("late", F.col("size") > F.col("target")))
    total = d.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("size") * F.col("rows")).alias("size")).first()
    budget = F.lit(total["size"] or 0).cast("long")
    buckets = max(1, min(MOST_BUCKETS, total["n"] * epochs // bucket_rows))
    # a class: the documents of a source that are not (or are) longer than its target
    classes = d.groupBy("sid", "late").agg(F.sum(F.col("size") * F.col("rows")).alias("class_size"))
    ahead = classes.filter("not late").select("sid", (F.col("class_size") * epochs).alias("ahead"))
    classes = few(cut(classes.join(ahead, "sid", "left").withColumn(
        "ahead", F.when(F.col("late"), F.coalesce("ahead", F.lit(0))).otherwise(0))))
    one = (d.filter("size > 0").join(classes, ["sid", "late"])
           .withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1)))))
    per = F.greatest(F.lit(1).cast("long"), F.floor(F.col("target") / RUNS / F.col("size")).cast("long"))
    one = one.withColumn("per", per).withColumn("run", F.explode(F.sequence(
        F.lit(0).cast("long"), F.floor((F.col("rows") - 1) / F.col("per")).cast("long"))))
    one = one.withColumn("copies", F.least(F.col("per"), F.col("rows") - F.col("run") * F.col("per")))
    one = one.withColumn("words", F.col("copies") * F.col("size"))
    one = one.withColumn("place", F.md5(F.concat_ws(
        ":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), "h", "epoch").cast("binary")))
    first = F.conv(F.substring("place", 1, 8), 16, 10).cast("long")  # of 2**32
    one = one.withColumn("bucket", F.shiftright(first * F.lit(buckets), 32))
    order = ["place", "doc_id", "size", "run"]
    one = _running(one, ["sid", "late", "epoch"], "bucket", order, "words", "within")
    # Epochs follow one another, each as long as the class.
    upto = F.col("ahead") + F.col("epoch") * F.col("class_size") + F.col("within")
    one = one.withColumn("time", (upto * 2 - F.col("words")).cast("double") / (F.col("target") * 2))
    one = one.select(*GROUP, "epoch", "run", "copies", "words", "place", "time")
    one = cut(one)
    # The budget is used up about time 1. What lies beyond time 2 is left out of the sort
    # if the rest holds the budget, as it does unless most documents are longer than their targets.
    if (one.filter("time < 2").agg(F.sum("words")).first()[0] or 0) >= (total["size"] or 0):
        one = one.filter("time < 2")
    one = one.withColumn("slot", F.floor(F.least(F.col("time"), F.lit(4.0)) * buckets).cast("long"))
    one = _running(one, [], "slot", ["time", "sid", "epoch", *order], "words", "mixed")
    left = budget - (F.col("mixed") - F.col("words"))
    fits = F.floor((left * 2 + F.col("size")) / (F.col("size") * 2)).cast("long")
    one = one.withColumn("k", F.greatest(F.lit(0).cast("long"), F.least(F.col("copies"), fits))).filter("k > 0")
    took = one.groupBy(*[F.col(c).alias(f"_{c}") for c in GROUP], "epoch").agg(F.sum("k").alias("k"))
    took = took.groupBy(*[f"_{c}" for c in GROUP]).agg(F.collect_list("k").alias("took"))
    on = d["doc_id"].eqNullSafe(took["_doc_id"])
    for c in GROUP[1:]:
        on = on & (d[c] == took[f"_{c}"])
    return d.join(took, on, "left").select(
        "doc_id", "source", "sid", "size", "h", "rows", "source_size", "target",
        F.coalesce("took", F.array().cast("array<long>")).alias("took"))


def _times(took: Column, nth: Column) -> Column:
    """In how many epochs the nth (from 0) of equal rows is taken."""
    return F.size(F.filter(took, lambda k: k > nth))


def mix(docs: DataFrame, epochs: int = EPOCHS, bucket_rows: int = BUCKET_ROWS, piece: int = PIECE) -> DataFrame:
    """doc_id, size, source_size, target, taken of every document."""
    g = _taken(docs, epochs, bucket_rows)
    # the rows of a group again, a long one in pieces
    g = g.withColumn("_at", F.explode(F.sequence(F.lit(0).cast("long"), F.col("rows") - 1, F.lit(piece).cast("long"))))
    g = g.withColumn("_nth", F.explode(F.sequence("_at", F.least(F.col("_at") + piece, F.col("rows")) - 1)))
    return g.select("doc_id", "source", "size", "source_size", "target",
                    (F.col("size") * _times(F.col("took"), F.col("_nth"))).alias("taken"))


def _numbered(rows: DataFrame, group: list[str]) -> DataFrame:
    """``rows`` with ``_nth``, their number (from 0) in their group, in two levels: within
    the parts they were written in, and the parts of a group one after the other."""
    r = stored(rows.withColumn("_part", F.spark_partition_id()).withColumn("_id", F.monotonically_increasing_id()))
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = r.groupBy(*group, "_part").agg(F.count(F.lit(1)).alias("_n"))
    parts = parts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    inside = Window.partitionBy(*group, "_part").orderBy("_id")
    on = None
    for c in [*group, "_part"]:
        same = r[c].eqNullSafe(parts[c])
        on = same if on is None else on & same
    r = r.withColumn("_own", F.row_number().over(inside) - 1)
    return r.join(parts.select(*[F.col(c) for c in [*group, "_part"]], "_before"), on).select(
        *[r[c] for c in rows.columns], (F.col("_own") + F.col("_before")).alias("_nth"))


def mixed(docs: DataFrame, epochs: int = EPOCHS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """The mix itself: the taken documents with all their columns, each as
    often as it was taken."""
    names = docs.columns
    own = ["doc_id", "source", "size", "h"]
    whole = docs.select(F.struct(*[docs[c] for c in names]).alias("_row"), docs["doc_id"], docs["source"], docs["text"])
    keyed = whole.select("_row", *_sized())
    g = _taken(docs, epochs, bucket_rows).filter(F.size("took") > 0).select(
        *[F.col(c).alias(f"_{c}") for c in own], "rows", "took")
    on = None
    for c in own:
        same = keyed[c].eqNullSafe(g[f"_{c}"])
        on = same if on is None else on & same
    m = keyed.join(g, on)
    # a group that is taken whole or not at all in each epoch needs no numbers
    even = F.forall("took", lambda k: k == F.col("rows"))
    all_of = m.filter(even).select("_row", F.size("took").alias("_times"))
    some = _numbered(m.filter(~even).select("_row", *own, "took"), own).select(
        "_row", _times(F.col("took"), F.col("_nth")).alias("_times"))
    return (all_of.unionByName(some).select("_row", F.explode(F.array_repeat(F.lit(1), F.col("_times"))))
            .select("_row.*"))


#: DuckDB SQL for the columns of :func:`mix` without source.
SQL = """
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
             md5(coalesce(text, '')) AS h FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, ((row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3 + 1)::BIGINT AS weight FROM s),
l AS (SELECT *, ((sum(source_size) OVER ())::BIGINT - coalesce(sum(source_size * 3) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT)::DOUBLE
        / (sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS level, row_number() OVER o AS nth
      FROM w WINDOW o AS (ORDER BY (source_size * 3)::DOUBLE / weight, source IS NULL, encode(source))),
t AS (SELECT source, source_size, row_number() OVER (ORDER BY source IS NULL, encode(source)) AS sid, least((source_size * 3)::DOUBLE,
        weight * coalesce((SELECT arg_min(level, nth) FROM l WHERE (source_size * 3)::DOUBLE >= weight * level), 0.0)) AS target FROM l),
g AS (SELECT d.doc_id, d.source, d.size, h, t.sid, t.source_size, t.target, d.size > t.target AS late, count(*) AS n
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source GROUP BY ALL),
k AS (SELECT sid, late, sum(size * n)::BIGINT AS class_size FROM g GROUP BY ALL),
c AS (SELECT g.*, epoch, greatest(1, floor(target / 256 / size)::BIGINT) AS per, class_size,
        CASE WHEN g.late THEN coalesce((SELECT class_size * 3 FROM k x WHERE x.sid = g.sid AND NOT x.late), 0) ELSE 0 END AS ahead
      FROM g JOIN k ON g.sid = k.sid AND g.late = k.late, range(3) e(epoch) WHERE size > 0),
r AS (SELECT *, unnest(range((n - 1) // per + 1)) AS run, md5(coalesce(doc_id::VARCHAR, 'null') || ':' || h || ':' || epoch) AS place FROM c),
v AS (SELECT *, least(per, n - run * per) AS copies, copies * size AS words FROM r),
f AS (SELECT *, (2 * (ahead + epoch * class_size + sum(words) OVER (PARTITION BY sid, late, epoch ORDER BY place, doc_id NULLS FIRST, size, run))::BIGINT
        - words)::DOUBLE / (target * 2) AS time FROM v),
m AS (SELECT *, (SELECT sum(size) FROM d)::BIGINT - (sum(words) OVER (ORDER BY time, sid, epoch, place, doc_id NULLS FIRST, size, run))::BIGINT + words AS rest FROM f),
o AS (SELECT doc_id, sid, size, h, epoch, sum(greatest(0, least(copies, floor((2 * rest + size) / (2 * size))::BIGINT))) AS k FROM m GROUP BY ALL),
p AS (SELECT doc_id, sid, size, h, list(k) AS took FROM o GROUP BY ALL),
x AS (SELECT g.*, unnest(range(n)) AS nth FROM g)
SELECT x.doc_id, x.size, x.source_size, x.target, x.size * len(list_filter(coalesce(took, []), lambda k: k > nth)) AS taken
FROM x LEFT JOIN p ON x.doc_id IS NOT DISTINCT FROM p.doc_id AND x.sid = p.sid AND x.size = p.size AND x.h = p.h
"""
