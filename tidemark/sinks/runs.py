"""Output of one run: committed once, replaced when the run is repeated.

Every file output carries a ``run`` partition. A batch run names itself; a
stream names its run, and each micro-batch is ``<run>-<batch id>`` (its
checkpoint belongs to the run's name, so a new checkpoint is a new run). Runs never
touch each other's partitions.

An attempt writes into a folder of its own, ``<root>/_attempts/<id>`` (two runs never
share a temporary folder, and Spark's readers skip it). Then it is committed by one
record, ``<root>/_commits/<run>/<n>``, created without overwriting, and published:
the partitions of the run's earlier attempt go, the new ones are renamed into place.
Both steps after the record can be repeated, and :func:`recover` does so for jobs
that died between them. So a job that dies before its record leaves the earlier
output as it was, and one that dies later is finished by the next writer or reader. A
replayed micro-batch passes ``once`` and finds its record: nothing is written twice.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.sinks import files


def run_name(run: str, batch_id: int | None = None) -> str:
    if not re.fullmatch(r"[A-Za-z0-9_.-]+", run or ""):
        raise ValueError(f"a run needs a name of letters, digits, _ . -; got {run!r}")
    return run if batch_id is None else f"{run}-{batch_id:012d}"


def _commits(root: str, run: str) -> str:
    return f"{root}/_commits/{run}"


def _records(spark: SparkSession, root: str, run: str) -> list[int]:
    return sorted({int(n.split(".")[0]) for n in files.names(spark, _commits(root, run)) if n[0].isdigit()})


def committed(spark: SparkSession, root: str, run: str) -> bool:
    return bool(_records(spark, root.rstrip("/"), run))


def _publish(spark: SparkSession, root: str, run: str, n: int) -> None:
    """Brings the partitions of a committed attempt into place."""
    record = f"{_commits(root, run)}/{n}"
    if files.exists(spark, f"{record}.done"):
        return
    attempt, above = files.read_text(spark, record).split("\n")[:2]
    if not files.exists(spark, f"{record}.cleared"):
        # nothing of this attempt is in place yet: what is there is older
        for old in files.found(spark, "/".join(p for p in (root, above, f"run={run}") if p)):
            files.delete(spark, old)
        files.put_new(spark, f"{record}.cleared", "")
    folder = f"{root}/_attempts/{attempt}"
    here = "/".join(p for p in (folder, above, f"run={run}") if p)
    for part in files.found(spark, here):
        files.move(spark, part, root + part[part.index(f"/_attempts/{attempt}") + len(f"/_attempts/{attempt}"):])
    files.delete(spark, folder)
    files.put_new(spark, f"{record}.done", "")


def recover(spark: SparkSession, root: str, run: str | None = None) -> list[str]:
    """Finishes the runs (or one) that are committed but not fully in place."""
    root, out = root.rstrip("/"), []
    for r in [run] if run else files.names(spark, f"{root}/_commits"):
        have = _records(spark, root, r)
        if have and not files.exists(spark, f"{_commits(root, r)}/{have[-1]}.done"):
            _publish(spark, root, r, have[-1])
            out.append(r)
    return out


def write_run(df: DataFrame, root: str, run: str, partitions: tuple[str, ...] = (), fmt: str = "parquet",
              options: dict | None = None, once: bool = False) -> None:
    """Writes ``df`` as the output of ``run`` under ``root``; with ``once`` only if
    the run is not committed yet."""
    spark, root = df.sparkSession, root.rstrip("/")
    recover(spark, root, run)
    have = _records(spark, root, run)
    if have and once:
        return
    attempt, above = uuid.uuid4().hex, "/".join(f"{p}=*" for p in partitions)
    (df.withColumn("run", F.lit(run)).write.options(**(options or {}))
       .partitionBy(*partitions, "run").format(fmt).save(f"{root}/_attempts/{attempt}"))
    n = have[-1] + 1 if have else 0
    if not files.put_new(spark, f"{_commits(root, run)}/{n}", f"{attempt}\n{above}"):
        raise RuntimeError(f"run {run} has been committed by another writer")
    _publish(spark, root, run, n)


def read_runs(spark: SparkSession, root: str, schema=None) -> DataFrame:
    """All committed runs under ``root``, those included whose writer died before
    they were in place."""
    recover(spark, root)
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(root)
