"""Keyed tables in versions.

``<path>/manifests/<version>.json`` names the files of one version: per bucket
a folder under ``<path>/data``. Folders are never changed. A batch reads the
buckets that hold its keys, merges, writes new folders and commits a manifest
that names them beside the untouched ones. The commit is one rename that never
overwrites, so readers see whole versions; a job that dies before it leaves the old
version, and of two writers one gets :class:`Conflict`.

The number of buckets is a power of two and doubles when buckets pass
``bucket_rows`` rows on average, which rewrites the table once per doubling.
Columns are the union of all versions' columns: older folders read as null.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tidemark.sinks import files

BUCKET_ROWS = 500_000


class Conflict(RuntimeError):
    """Another writer has committed the version."""


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str, key: str, bucket_rows: int = BUCKET_ROWS):
        self.spark, self.path, self.key, self.bucket_rows = spark, path.rstrip("/"), key, bucket_rows

    # --- reading ---------------------------------------------------------------

    def versions(self) -> list[int]:
        return sorted(int(n[:-5]) for n in files.names(self.spark, f"{self.path}/manifests") if n.endswith(".json")
                      and not n.startswith("."))

    def manifest(self, version: int | None = None) -> dict | None:
        """The newest version's manifest, or that of ``version``."""
        have = self.versions()
        if not have:
            return None
        return json.loads(files.read_text(self.spark, self._manifest_path(have[-1] if version is None else version)))

    def _manifest_path(self, version: int) -> str:
        return f"{self.path}/manifests/{version:012d}.json"

    def read(self, schema: T.StructType | None = None, version: int | None = None, buckets=None) -> DataFrame:
        """The rows of a version; of some buckets only, if given. Columns it does
        not have are null."""
        m = self.manifest(version)
        schema = schema or T.StructType.fromJson(m["schema"])
        folders = [f["path"] for b, f in sorted((m or {"folders": {}})["folders"].items(), key=lambda x: int(x[0]))
                   if buckets is None or int(b) in buckets]
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/data/{f}" for f in folders])

    # --- writing ---------------------------------------------------------------

    def _bucket(self, n: int):
        return F.pmod(F.xxhash64(self.key), F.lit(n)).cast("int")

    def fold(self, new: DataFrame, merge: Callable[[DataFrame], DataFrame]) -> int:
        """Merges ``new`` into the table: ``merge`` gets the old and new rows of all
        touched buckets and returns one row per key, with the columns of ``new``. ``new``
        holds every column of the table. Returns the version. A batch without rows
        still makes the table."""
        m = self.manifest()
        size = (new.withColumn("_b", self._bucket(m["buckets"] if m else 1)).groupBy("_b")
                .agg(F.count(F.lit(1)).alias("n")).collect())  # one row per touched bucket
        added = sum(r["n"] for r in size)
        before = sum(f["rows"] for f in m["folders"].values()) if m else 0
        buckets = m["buckets"] if m else 1
        while before + added > buckets * self.bucket_rows:
            buckets *= 2
        same = bool(m) and buckets == m["buckets"]
        touched = {r["_b"] for r in size} if same else None
        old = self.read(new.schema, buckets=touched) if m else None
        both = new if old is None else old.unionByName(new)
        folders = {b: f for b, f in m["folders"].items() if int(b) not in touched} if same else {}
        if added or not same and before:
            folder = uuid.uuid4().hex
            out = merge(both).select(*new.columns).withColumn("table_bucket", self._bucket(buckets))
            out.write.partitionBy("table_bucket").parquet(f"{self.path}/data/{folder}")
            written = (self.spark.read.schema(T.StructType(list(new.schema.fields)).add("table_bucket", T.IntegerType()))
                       .parquet(f"{self.path}/data/{folder}").groupBy("table_bucket").count().collect())
            for r in written:
                folders[str(r["table_bucket"])] = {"path": f"{folder}/table_bucket={r["table_bucket"]}", "rows": r["count"]}
        version = (m["version"] if m else -1) + 1
        self.commit({"version": version, "buckets": buckets, "schema": json.loads(new.schema.json()),
                     "folders": folders})
        return version

    def commit(self, manifest: dict) -> None:
        if not files.put_new(self.spark, self._manifest_path(manifest["version"]), json.dumps(manifest)):
            raise Conflict(f"{self.path}: version {manifest['version']} is there already")

    def vacuum(self, keep: int = 2) -> list[str]:
        """Drops all but the newest ``keep`` versions, and the folders that only older
        ones or dead jobs have written. Not while a writer is at work."""
        have = self.versions()
        kept = [self.manifest(v) for v in have[-keep:]]
        used = {f["path"].split("/")[0] for m in kept for f in m["folders"].values()}
        for v in have[:-keep]:
            files.delete(self.spark, self._manifest_path(v))
        gone = [d for d in files.names(self.spark, f"{self.path}/data") if d not in used]
        for d in gone:
            files.delete(self.spark, f"{self.path}/data/{d}")
        return gone
