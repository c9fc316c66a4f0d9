"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job wants: AQE re-plans joins and coalesces partitions at
# run time, splits skewed join partitions, and the session zone is explicit.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # checkpoints go with the frames they belong to
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
}


_ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _worker_path() -> None:
    """Python workers of a local session inherit the driver's environment;
    put this package on their path (streaming state processors run there)."""
    parts = [p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    if _ROOT not in parts:
        os.environ["PYTHONPATH"] = os.pathsep.join([_ROOT] + parts)


def get_session(app: str = "tidemark", master: str | None = None,
                shuffle_partitions: int | None = None,
                conf: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the defaults above.

    ``master`` is only set when given, so a cluster submit keeps its own.
    """
    _worker_path()
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in {**DEFAULT_CONF, **(conf or {})}.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return b.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the operator sets it (a static setting) to a shared file
    system; it is read from the session and never replaced. Only when it is
    unset on a local master (tests) a scratch folder is made and registered
    with ``setCheckpointDir``; on a cluster an unset value is an error.
    """
    sc = spark.sparkContext
    d = sc.getConf().get("spark.checkpoint.dir", None)
    if d:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(d)
        return d
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/...); "
                           "a machine-local folder does not survive executor or driver loss")
    global _LOCAL_CKPT
    if _LOCAL_CKPT is None:
        _LOCAL_CKPT = tempfile.mkdtemp(prefix="tidemark-ckpt-")
        sc.setCheckpointDir(_LOCAL_CKPT)
    return _LOCAL_CKPT


_LOCAL_CKPT: str | None = None


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder (for written tables and
    streaming checkpoints)."""
    return os.path.join(checkpoint_dir(spark), name)


def passing_path(spark: SparkSession, name: str) -> str:
    """A path of the same kind for what only this application reads: its folder
    is deleted when the application ends (a killed driver leaves it behind)."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(scratch_path(spark, name))
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(p)  # only folders that exist can be marked
    fs.deleteOnExit(p)
    return os.path.join(scratch_path(spark, name), "t")
