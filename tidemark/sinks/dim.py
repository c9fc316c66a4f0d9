"""K3/K4: dimension tables with their configured columns.

``<root>/<sink table>`` is a :class:`tidemark.sinks.versioned.VersionedTable`: a text
column for every column that any config row of the sink table names,
``row_key``, the type and position of the last change, and the position each
column was set at. A batch folds its changes into the buckets it touches and commits a
new version; a crash leaves the old one.

Values are upserted column by column: a change sets the columns it carries and
leaves the others, so several source tables can feed one sink table, and columns
added later are null until they are set. Of two changes of a key and column the
later one wins by source time, then (where the source has no times) by run order,
then by partition and offset, whatever batch they come in; so a replayed batch
changes nothing.

K3 keeps deletes as rows of type ``delete`` (Q1); readers may apply them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tidemark.operators.dim import (change_at, config_rejects, extend_rejects, key_value, route, route_asof,
                                    route_rejects)
from tidemark.sinks.runs import write_run
from tidemark.sinks.versioned import BUCKET_ROWS, VersionedTable

POSITION = "src_ts bigint, run_no bigint, part int, seq bigint"
OWN = ("row_key", "change_type", "at", "set_at", "table_bucket")


def dim_path(root: str, sink_table: str) -> str:
    return f"{root.rstrip('/')}/{sink_table}"


def dim_table(spark: SparkSession, root: str, sink_table: str, bucket_rows: int = BUCKET_ROWS) -> VersionedTable:
    return VersionedTable(spark, dim_path(root, sink_table), "row_key", bucket_rows)


def _columns(table: VersionedTable) -> list[str]:
    m = table.manifest()
    return [f["name"] for f in m["schema"]["fields"] if f["name"] not in OWN] if m else []


def sink_tables(state: DataFrame) -> dict[str, list[str]]:
    """Sink table -> the columns of all its usable config rows, in the order of
    source tables. Config rows are few: one per source table (and version)."""
    out: dict[str, list[str]] = {}
    order = [c for c in ("sink_table", "source_table", "valid_from") if c in state.columns]
    for row in state.filter("valid").orderBy(*order).toLocalIterator():
        seen = out.setdefault(row["sink_table"], [])
        seen += [c for c in dict.fromkeys(row["sink_columns"].split(",")) if c and c not in seen]
    clash = sorted(c for cols in out.values() for c in cols if c in OWN)
    if clash:
        raise ValueError(f"columns that the tables use themselves: {clash}")
    return out


def _merge(columns: list[str]):
    """Column by column the latest value, with partial aggregation."""
    def merge(both: DataFrame) -> DataFrame:
        when = {c: F.col("set_at")[c] for c in columns}
        g = both.groupBy("row_key").agg(
            *[F.max_by(F.col(c), when[c]).alias(f"v_{i}") for i, c in enumerate(columns)],
            *[F.max(when[c]).alias(f"w_{i}") for i, c in enumerate(columns)],
            F.max_by("change_type", "at").alias("change_type"), F.max("at").alias("at"))
        set_at = F.map_from_arrays(F.array(*[F.lit(c) for c in columns]),
                                   F.array(*[F.col(f"w_{i}") for i in range(len(columns))]))
        return g.select("row_key", *[F.col(f"v_{i}").alias(c) for i, c in enumerate(columns)], "change_type", "at",
                        F.map_filter(set_at, lambda k, v: v.isNotNull()).alias("set_at"))
    return merge


def upsert_dim_tables(routed: DataFrame, state: DataFrame, root: str, run_no: int = 0,
                      bucket_rows: int = BUCKET_ROWS) -> list[str]:
    """Folds one batch of routed changes into the tables; creates those that
    are missing. The driver loops over sink tables, never over data. A key
    that changes many times in the batch is combined before the shuffle."""
    spark = routed.sparkSession
    changes = routed.select("sink_table", key_value().alias("row_key"), "type", "data",
                            change_at(run_no).alias("at")).persist()  # one pass over the batch serves every table
    # a JSON null is a null value, which a column can be set to
    text = lambda c: F.when(~F.is_variant_null(F.col("data")[c]), F.coalesce(
        F.try_variant_get(F.col("data")[c], "$", "string"), F.to_json(F.col("data")[c])))
    at = T.StructType.fromDDL(POSITION)
    done = []
    for name, configured in sink_tables(state).items():
        table = dim_table(spark, root, name, bucket_rows)
        columns = list(dict.fromkeys(_columns(table) + configured))
        schema = T.StructType([T.StructField("row_key", T.StringType()), *[T.StructField(c, T.StringType()) for c in columns],
                               T.StructField("change_type", T.StringType()), T.StructField("at", at),
                               T.StructField("set_at", T.MapType(T.StringType(), at))])
        carried = F.array(*[F.when(F.map_contains_key("data", c), F.lit(c)) for c in columns])
        set_at = F.transform(F.array_compact(carried), lambda c: F.struct(c.alias("key"), F.col("at").alias("value")))
        new = changes.filter((F.col("sink_table") == name) & F.col("row_key").isNotNull()).select(
            "row_key", *[text(c).alias(c) for c in columns], F.col("type").alias("change_type"), "at",
            F.map_from_entries(set_at).alias("set_at"))
        new = new.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema])
        table.fold(new.to(schema), _merge(columns))
        done.append(name)
    changes.unpersist()
    return done


def dim_batch(changes: DataFrame, state: DataFrame, root: str, run: str, run_no: int = 0,
              config_at: str | None = None) -> list[str]:
    """One batch of parsed changes: the tables, and the rejects of ``run``. With
    ``config_at`` the state is a history (:func:`tidemark.operators.dim.config_history`), applied
    by the position column of that name."""
    rejects = f"{root.rstrip('/')}_rejects"
    routed = route_asof(changes, state, config_at) if config_at else route(changes, state)
    done = upsert_dim_tables(routed, state, root, run_no)
    write_run(route_rejects(changes, state), f"{rejects}/changes", run)
    bad = config_rejects(state).withColumn("reason", F.lit("key not among the columns")).unionByName(
        extend_rejects(state).withColumn("reason", F.lit("clause left out")))
    write_run(bad, f"{rejects}/config", run)
    return done


def read_dim_table(spark: SparkSession, root: str, sink_table: str, columns: list[str] | None = None,
                   apply_deletes: bool = False, version: int | None = None) -> DataFrame:
    """The columns of a dimension table (all, or some), one row per key; of an
    older version if asked."""
    table = dim_table(spark, root, sink_table)
    df = table.read(version=version) if table.versions() else spark.createDataFrame(
        [], T.StructType().add("row_key", "string").add("change_type", "string"))
    if apply_deletes:
        df = df.filter(F.col("change_type").isNull() | (F.col("change_type") != "delete"))
    columns = [c for c in df.columns if c not in OWN] if columns is None else columns
    return df.select("row_key", *[F.col(f"`{c}`") if c in df.columns else F.lit(None).cast("string").alias(c)
                                  for c in columns])


def ensure_dim_tables(spark: SparkSession, ddl: DataFrame) -> list[str]:
    """K4: run the create-if-missing DDL of each configured sink table (for a
    catalog). The driver loops over config rows, never over data."""
    done = []
    for row in ddl.toLocalIterator():
        spark.sql(row["ddl"])
        done.append(row["sink_table"])
    return done
