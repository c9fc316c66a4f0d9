"""K5/K6/K7: append sink, column choice, console."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.sinks.runs import write_run


def sink_columns(df: DataFrame, declared: list[str], transient: tuple[str, ...] = ()) -> DataFrame:
    """K6: the declared columns, in declaration order, without the transient
    ones (the writer binds by position, so order matters)."""
    return df.select(*[c for c in declared if c not in transient])


def write_append(df: DataFrame, target: str, fmt: str = "parquet",
                 options: dict | None = None, run: str | None = None, once: bool = False) -> None:
    """K5: append rows to a table (``fmt='jdbc'`` with url/dbtable/batchsize
    options for a database table, else a file table at ``target``).

    With ``run`` a file table gets the rows under that partition, replaced
    when the same run is repeated (with ``once``: left as they are), so each run lands once. A JDBC append cannot
    be undone this way; give the table a key and let the database deduplicate.
    """
    if fmt == "jdbc":
        jdbc_writer(df, options or {}).save()
    elif run is None:
        df.write.mode("append").options(**(options or {})).format(fmt).save(target)
    else:
        write_run(df, target, run, fmt=fmt, options=options, once=once)


def jdbc_writer(df: DataFrame, options: dict):
    """The append writer of a database table; ``url`` and ``dbtable`` are needed."""
    for name in ("url", "dbtable"):
        if name not in options:
            raise ValueError(f"a jdbc output needs the option {name}")
    return df.write.mode("append").format("jdbc").options(**options)


def console(df: DataFrame, n: int = 20) -> None:
    """K7: debugging print."""
    df.show(n, truncate=False)


def console_stream(df: DataFrame, mode: str = "append", trigger: dict | None = None):
    """K7 for streams (debugging only)."""
    w = df.writeStream.format("console").outputMode(mode).option("truncate", "false")
    return (w.trigger(**trigger) if trigger else w).start()
