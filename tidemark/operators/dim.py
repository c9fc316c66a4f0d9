"""Dimension routing by a changing config table (S3, T4, J1, P3-P5, K3, K4,
F8, F10, Q1-Q3, Q8).

* :func:`parse_changes` — change text -> ``(seq, table, type, data)``
* :func:`filter_bootstrap` (P3) — drop bootstrap markers
* :func:`config_state` (T4) — changelog -> current config, one row per
  source table (latest op per key wins, deletes drop it)
* :func:`route` (J1 + P4 + P5) — join on table name with the config
  (broadcast behind a size check), keep only configured columns, tag the
  sink table
* :func:`config_history`, :func:`route_asof` — the same by the config that held
  when each change arrived (intervals of validity, as-of join)
* :func:`latest_per_key` (K3, Q1) — the row each sink key ends up with
* :func:`table_schema` / :func:`table_ddl` (K4) — create-if-missing schema

Every step is a relational operator; the only driver-side loop (in
``tidemark.sinks.dim``) runs over sink tables — a handful — never over rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.record import REC_TYPE, field, parse_record
from tidemark.functions.text import split_list
from tidemark.operators.asof import asof_join, validity
from tidemark.operators.broadcast import sized_broadcast
from tidemark.schemas import CONFIG_CHANGE

# Bootstrap marker types that never reach a dimension table.
BOOTSTRAP_MARKERS = ("bootstrap-start", "bootstrap-complete")
DEFAULT_PK = "id"


def _place(df: DataFrame) -> list:
    """``seq``, and source time and partition where the source has them."""
    return ["seq",
            F.col("src_ts").cast("bigint").alias("src_ts") if "src_ts" in df.columns
            else F.lit(None).cast("bigint").alias("src_ts"),
            F.col("part").cast("int").alias("part") if "part" in df.columns else F.lit(0).alias("part")]


def parse_changes(raw: DataFrame) -> DataFrame:
    """``(seq, table, type, data, dirty)``; ``data`` is a record map. A line
    that is not a JSON object, or a matched change without ``data`` (Q2),
    is marked ``dirty`` instead of failing the job."""
    rec = parse_record(F.col("value"))
    # one-row generator: later filters read the parsed record, never re-parse
    df = raw.select("*", F.inline(F.array(F.struct(rec.alias("_rec")))))
    data = F.try_variant_get(F.col("_rec")["data"], "$", REC_TYPE)
    return df.select(
        *_place(raw),
        field("_rec", "table").alias("table"),
        field("_rec", "type").alias("type"),
        data.alias("data"),
        F.when(F.col("_rec").isNull(), F.lit("unparsable")).alias("dirty"))


def filter_bootstrap(changes: DataFrame) -> DataFrame:
    """Drop bootstrap markers; a missing type passes (null-safe)."""
    t = F.col("type")
    return changes.filter(F.col("dirty").isNull() & (t.isNull() | ~t.isin(*BOOTSTRAP_MARKERS)))


def parse_config_changes(raw: DataFrame) -> DataFrame:
    """S3 envelopes -> ``(seq, op, before, after)`` and the source's other columns."""
    p = raw.select("*", F.from_json("value", CONFIG_CHANGE).alias("c")).drop("value")
    return p.select(*[x for x in p.columns if x != "c"], "c.op", "c.before", "c.after")


def config_state(cfg_changes: DataFrame, retire_renamed: bool = False) -> DataFrame:
    """T4: current config, one row per ``source_table``.

    ``d`` removes ``before.source_table``; any other op puts ``after`` under
    ``after.source_table``. Last write per key wins (max by ``seq``), so this
    equals replaying the changelog in order. With ``retire_renamed`` an
    update that renames ``source_table`` also removes the old key.
    Adds ``pk`` (``sink_pk``, default ``id``), ``ext`` (``sink_extend``,
    default empty) and ``valid`` (Q8: the key is one of the columns).
    """
    t = _touches(cfg_changes, retire_renamed)
    last = (t.groupBy(F.col("t.key").alias("key"))
             .agg(F.max_by(F.col("t"), F.col("seq")).alias("t")))
    return _usable(last.filter(~F.col("t.is_del")).select("t.after.*"))


def _touches(cfg_changes: DataFrame, retire_renamed: bool) -> DataFrame:
    """``(seq, ..., t)``: each change of a key, ``t`` = (key, is_del, after)."""
    is_del = F.col("op") == "d"
    touches = [F.struct(F.when(is_del, F.col("before.source_table"))
                        .otherwise(F.col("after.source_table")).alias("key"),
                        is_del.alias("is_del"), F.col("after").alias("after"))]
    if retire_renamed:
        renamed = ((F.col("op") == "u")
                   & (F.col("before.source_table") != F.col("after.source_table")))
        touches.append(F.when(renamed, F.struct(
            F.col("before.source_table").alias("key"), F.lit(True).alias("is_del"),
            F.lit(None).cast(cfg_changes.schema["after"].dataType).alias("after"))))
    keep = [c for c in cfg_changes.columns if c not in ("op", "before", "after")]
    return (cfg_changes.select(*keep, F.explode(F.array(*touches)).alias("t"))
                       .filter(F.col("t").isNotNull() & F.col("t.key").isNotNull()))


def _usable(config: DataFrame) -> DataFrame:
    pk = F.coalesce(F.col("sink_pk"), F.lit(DEFAULT_PK))
    return config.select(
        "*", pk.alias("pk"), F.coalesce(F.col("sink_extend"), F.lit("")).alias("ext"),
        F.array_contains(split_list(F.col("sink_columns")), pk).alias("valid"))


def config_history(cfg_changes: DataFrame, at: str = "seq", retire_renamed: bool = False) -> DataFrame:
    """Every config row a source table ever had, with the positions it was valid
    at: from its own change up to, not including, the next change of its
    key (``valid_to`` null: still valid). ``at`` names the position, in the order of
    the business changes: ``seq``, or a time both logs carry."""
    t = validity(_touches(cfg_changes, retire_renamed).select(
        F.col(at).cast("bigint").alias("_at"), "seq", F.col("t.key").alias("_key"), "t"), ["_key"], "_at", ["_at", "seq"])
    return _usable(t.filter(~F.col("t.is_del")).select("valid_from", "valid_to", "t.after.*"))


def config_rejects(state: DataFrame) -> DataFrame:
    """Q8: config rows whose key is not among their columns (reported; the
    reference would create a table without a key)."""
    return state.filter(~F.col("valid"))


def route(changes: DataFrame, state: DataFrame, max_config_rows: int = 100_000) -> DataFrame:
    """J1 + P4 + P5: changes of configured tables, pruned to the configured
    columns (exact names, no trimming), tagged with ``sink_table`` and
    ``sink_pk``. Unconfigured tables are dropped (inner join)."""
    cfg = _routes(state)
    j = filter_bootstrap(changes).join(sized_broadcast(cfg, max_config_rows),
                                       F.col("table") == F.col("source_table"), "inner")
    return _pruned(j)


def _routes(state: DataFrame, *more: str) -> DataFrame:
    return state.filter(F.col("valid")).select(
        F.col("source_table"), F.col("sink_table"), F.col("pk").alias("sink_pk"),
        split_list(F.col("sink_columns")).alias("_cols"), *more)


def _pruned(joined: DataFrame) -> DataFrame:
    pruned = F.map_filter("data", lambda k, v: F.array_contains(F.col("_cols"), k))
    return joined.filter(F.col("data").isNotNull()).select(
        "seq", "src_ts", "part", "table", "type", "sink_table", "sink_pk", pruned.alias("data"))


def route_asof(changes: DataFrame, history: DataFrame, at: str = "seq", max_config_rows: int = 100_000) -> DataFrame:
    """J1 as the changes arrive: each change is routed and pruned by the config
    that was valid at its own position. One that arrives before its table's config,
    or while the config is deleted, is lost; one before an update of the config is pruned
    to the old columns and goes to the old sink table."""
    cfg = _routes(history, "valid_from", "valid_to").withColumnRenamed("source_table", "_src")
    return _pruned(asof_join(filter_bootstrap(changes), cfg, [("table", "_src")], at, max_rows=max_config_rows))


def route_rejects(changes: DataFrame, state: DataFrame, max_config_rows: int = 100_000) -> DataFrame:
    """Q2: changes of a configured table that carry no ``data`` object (the
    reference would dereference null), and unparsable change lines — for a
    dirty output instead of a failed job."""
    cfg = state.filter(F.col("valid")).select(F.col("source_table").alias("_src"))
    t = F.col("type")
    matched = (changes.filter(F.col("dirty").isNull() & (t.isNull() | ~t.isin(*BOOTSTRAP_MARKERS)))
                      .join(sized_broadcast(cfg, max_config_rows), F.col("table") == F.col("_src"),
                            "left_semi")
                      .filter(F.col("data").isNull())
                      .select("seq", "table", "type", F.lit("no_data").alias("reason")))
    broken = changes.filter(F.col("dirty").isNotNull()).select(
        "seq", "table", "type", F.col("dirty").alias("reason"))
    return matched.unionByName(broken)


def key_value(data_col: str = "data", pk_col: str = "sink_pk") -> F.Column:
    """The row's key value as text."""
    v = F.col(data_col)[F.col(pk_col)]
    return F.coalesce(F.try_variant_get(v, "$", "string"), F.to_json(v))


def change_at(run_no: int = 0) -> F.Column:
    """A change's position: source time (0 where there is none), run, partition, offset."""
    return F.struct(F.coalesce("src_ts", F.lit(0).cast("bigint")).alias("src_ts"),
                    F.lit(run_no).cast("bigint").alias("run_no"), F.coalesce("part", F.lit(0)).alias("part"),
                    F.col("seq").alias("seq"))


def latest_per_key(routed: DataFrame, apply_deletes: bool = False, run_no: int = 0) -> DataFrame:
    """K3: the change each (sink table, key) ends with, and its position
    ``at``: source time (0 where there is none), run, partition, offset.

    ``max_by`` has a map-side partial step, so a hot key is reduced before the
    shuffle. By default (Q1) a ``delete`` is kept like an upsert (dimension rows
    never disappear); ``apply_deletes`` drops keys whose last change is a delete.
    """
    r = routed.withColumn("row_key", key_value()).withColumn("at", change_at(run_no))
    last = (r.groupBy("sink_table", "row_key")
             .agg(F.max_by(F.struct("seq", "type", "sink_pk", "data", "at"), F.col("at")).alias("l")))
    out = last.select("sink_table", "row_key", "l.seq", "l.type", "l.sink_pk", "l.data", "l.at")
    if apply_deletes:
        out = out.filter(F.col("type").isNull() | (F.col("type") != "delete"))
    return out


def table_schema(state: DataFrame) -> DataFrame:
    """K4: ``(sink_table, position, column_name, is_pk, data_type)`` — every
    column is text, the key defaults to ``id``."""
    cols = F.posexplode(split_list(F.col("sink_columns")))
    return (state.select("sink_table", "pk", cols.alias("position", "column_name"))
                 .filter(F.col("column_name") != "")
                 .select("sink_table", "position", "column_name",
                         (F.col("column_name") == F.col("pk")).alias("is_pk"),
                         F.lit("string").alias("data_type")))


# Clauses of CREATE TABLE that Spark takes after USING.
EXTEND = r"(?i)^\s*(COMMENT\s+'[^']*'|(TBLPROPERTIES|OPTIONS)\s*\([^()]*\))\s*$"


def known_extend() -> F.Column:
    return (F.col("ext") != "") & F.col("ext").rlike(EXTEND)


def extend_rejects(state: DataFrame) -> DataFrame:
    """Config rows whose ``sink_extend`` is no clause that Spark knows."""
    return state.filter((F.col("ext") != "") & ~known_extend())


def table_ddl(state: DataFrame, namespace: str = "dim") -> DataFrame:
    """K4: ``CREATE TABLE IF NOT EXISTS`` text per sink table (Spark SQL; the
    key column is ``NOT NULL``). Of ``sink_extend`` only a comment, table properties or
    options are taken; clauses of other stores are left out and reported by
    :func:`extend_rejects`."""
    cols = F.transform(
        F.filter(split_list(F.col("sink_columns")), lambda c: c != ""),
        lambda c: F.concat(F.lit("`"), c, F.lit("` STRING"),
                           F.when(c == F.col("pk"), F.lit(" NOT NULL")).otherwise(F.lit(""))))
    ddl = F.concat(F.lit(f"CREATE TABLE IF NOT EXISTS {namespace}."), F.col("sink_table"),
                   F.lit(" ("), F.array_join(cols, ", "), F.lit(") USING parquet"),
                   F.when(known_extend(), F.concat(F.lit(" "), F.col("ext"))).otherwise(F.lit("")))
    return state.select("sink_table", ddl.alias("ddl"))
