"""What the steps leave on the executors' disks."""

from __future__ import annotations

import os
import time

from pyspark.sql import functions as F

from tidemark.llm.common import cut, stored


def _shuffle_files(spark):
    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f for d in dirs for _, _, names in os.walk(str(d)) for f in names
            if f.startswith("shuffle_") and f.endswith(".data")}


def test_computed_steps_leave_no_shuffle_files(spark):
    for keep in (stored, cut):
        df = spark.range(5000).groupBy((F.col("id") % 100).alias("k")).count()
        before = _shuffle_files(spark)
        out = keep(df)
        for _ in range(40):  # they are deleted in the background
            left = _shuffle_files(spark) - before
            if not left:
                break
            time.sleep(0.25)
        assert not left, keep.__name__
        assert sorted(map(tuple, out.collect())) == [(k, 50) for k in range(100)]
        # the frame itself can still be used
        assert df.count() == 100 and df.filter("count = 50").count() == 100
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) is None
