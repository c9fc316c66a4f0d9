"""Streaming throughput of the jobs: the sf log (and its page topic) as
parquet files into the ``noop`` sink. Per job two numbers: one
``availableNow`` micro-batch (query start included), and a steady state of
one file per micro-batch (rows over the summed trigger times of all
batches, so query start is left out). Prints one line per job.

    python tools/stream_bench.py folder [sf_dir]

``folder`` takes the intermediate files (shared, on a cluster).
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from tidemark.operators.split import TOPIC_PAGE  # noqa: E402
from tidemark.plans import flows as pl  # noqa: E402
from tidemark.schemas import RAW_LOG  # noqa: E402
from tidemark.session import get_session  # noqa: E402
from tidemark.sources.fixtures import raw_log  # noqa: E402
from tidemark.streaming import jobs as J  # noqa: E402


def main() -> None:
    d = os.path.join(sys.argv[1], f"stream-bench-{int(time.time())}")
    sf = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.1"
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_session("tidemark-stream-bench", master=f"local[{cpus}]", shuffle_partitions=cpus,
                        conf={"spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    raw_log(spark, sf).repartition(cpus).write.parquet(os.path.join(d, "raw"))
    (pl.routed_log(spark, sf).filter(F.col("topic") == TOPIC_PAGE).select("value", "seq")
       .repartition(cpus).write.parquet(os.path.join(d, "page")))
    n_raw = spark.read.parquet(os.path.join(d, "raw")).count()
    n_page = spark.read.parquet(os.path.join(d, "page")).count()

    def src(p, per_batch=None):
        r = spark.readStream.schema(RAW_LOG)
        if per_batch:
            r = r.option("maxFilesPerTrigger", per_batch)
        return r.parquet(os.path.join(d, p))

    def run(name, make, n):
        t = time.time()
        q = (make(None).writeStream.format("noop")
               .option("checkpointLocation", os.path.join(d, "ck1_" + name))
               .trigger(availableNow=True).start())
        q.awaitTermination()
        one = n / (time.time() - t)
        q = (make(1).writeStream.format("noop")
               .option("checkpointLocation", os.path.join(d, "ck2_" + name))
               .trigger(availableNow=True).start())
        q.awaitTermination()
        busy = sum(p["durationMs"].get("triggerExecution", 0) for p in q.recentProgress) / 1000
        rows = sum(p["numInputRows"] for p in q.recentProgress)
        print(f"{name}: one batch {one:,.0f} rows/s; steady {rows / busy:,.0f} rows/s "
              f"over {len(q.recentProgress)} batches", flush=True)

    run("log_split", lambda k: J.log_split_stream(src("raw", k)), n_raw)
    run("keyword_window", lambda k: J.keyword_window_stream(J.page_log_from_topic(src("page", k))), n_page)
    run("unique_visitor", lambda k: J.unique_visitor_stream(J.page_log_from_topic(src("page", k))), n_page)
    run("user_jump", lambda k: J.user_jump_stream(J.page_log_from_topic(src("page", k))), n_page)


if __name__ == "__main__":
    main()
