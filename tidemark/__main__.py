"""Command line: run one of the jobs, batch or streaming.

    python -m tidemark log-split      --source kafka --input topic_log --out /shared/topics --run 2024-01-01 [--stream]
    python -m tidemark page-consumers --source parquet --input /shared/topics/page --out /shared/dws --stream
    python -m tidemark keyword-window --source parquet --input /logs --out /shared/kw
    python -m tidemark unique-visitor --source parquet --input /logs --out /shared/uv
    python -m tidemark user-jump      --source parquet --input /logs --out /shared/uj
    python -m tidemark dim --source kafka --input topic_db --config /shared/config --out /shared/dim [--stream]

``--source`` is ``kafka`` (``--input`` is the topic; ``--option
kafka.bootstrap.servers=...``), ``parquet``, ``json`` or ``text``. Batch runs
read what is there and stop; ``--stream`` keeps running with checkpoints
under the session's ``spark.checkpoint.dir``. ``--run`` names the run: a run
with the same name replaces its own output, others are never touched.
``--kafka-servers`` sends topics to Kafka instead of folders (``--kafka-option``
for the producer); ``--jdbc url=... --jdbc dbtable=...`` appends keyword counts
to a database table. Lines and changes that cannot be used go to
``<out>_rejects`` (page consumers: ``<out>/rejects``).
"""

from __future__ import annotations

import argparse

from tidemark.plans import jobs
from tidemark.sources.logs import read_log, read_log_stream
from tidemark.session import get_session


def _opts(pairs):
    out = {}
    for p in pairs or []:
        k, _, v = p.partition("=")
        out[k] = v
    return out


def main(argv=None, spark=None) -> list:
    ap = argparse.ArgumentParser(prog="tidemark")
    ap.add_argument("job", choices=["log-split", "page-consumers", "keyword-window",
                                    "unique-visitor", "user-jump", "dim"])
    ap.add_argument("--source", default="parquet")
    ap.add_argument("--input", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--config", help="config changelog (parquet of value, seq) for dim")
    ap.add_argument("--option", action="append", help="source option key=value")
    ap.add_argument("--run", required=True, help="name of this run")
    ap.add_argument("--run-no", type=int,
                    help="dim, batch: order of this run, needed where the source has no times")
    ap.add_argument("--config-at", help="dim, batch: position column (seq, src_ts) by which each change "
                                        "follows the config of its own time")
    ap.add_argument("--early-visits", action="store_true",
                    help="page consumers: emit a visit when it arrives, not when its day is complete")
    ap.add_argument("--kafka-servers", help="send topics to this Kafka cluster")
    ap.add_argument("--kafka-option", action="append", help="producer option key=value")
    ap.add_argument("--jdbc", action="append", help="database option key=value for keyword counts")
    ap.add_argument("--zone", default="UTC")
    ap.add_argument("--window", default="10 seconds")
    ap.add_argument("--within-ms", type=int, default=10_000)
    ap.add_argument("--stream", action="store_true")
    ap.add_argument("--available-now", action="store_true",
                    help="streaming: process what is there, then stop")
    a = ap.parse_args(argv)
    spark = spark or get_session(f"tidemark-{a.job}")
    opts = _opts(a.option)
    trigger = {"availableNow": True} if a.available_now else None

    kafka = {"servers": a.kafka_servers, **_opts(a.kafka_option)} if a.kafka_servers else None
    jdbc = _opts(a.jdbc) or None

    if not a.stream:
        src = read_log(spark, a.source, a.input, opts)
        if a.job == "log-split":
            jobs.log_split(src, a.out, a.run, a.zone, kafka)
        elif a.job == "keyword-window":
            jobs.keyword_window(src, a.out, a.run, a.window, a.zone, jdbc)
        elif a.job == "unique-visitor":
            jobs.unique_visitors(src, a.out, a.run, a.zone, kafka)
        elif a.job == "user-jump":
            jobs.user_jumps(src, a.out, a.run, a.within_ms, a.zone, kafka)
        elif a.job == "dim":
            jobs.dim(src, read_log(spark, "parquet", a.config), a.out, a.run, a.run_no, a.config_at)
        else:
            ap.error("page-consumers runs as a stream (--stream)")
        return []

    src = read_log_stream(spark, a.source, a.input, opts)
    if a.job == "log-split":
        queries = [jobs.start_log_split(spark, src, a.out, a.run, a.zone, trigger, kafka)]
    elif a.job == "page-consumers":
        queries = jobs.start_page_consumers(spark, src, a.out, a.run, a.zone, trigger, kafka, jdbc, a.early_visits)
    elif a.job == "dim":
        queries = [jobs.start_dim(spark, src, lambda: read_log(spark, "parquet", a.config),
                                  a.out, a.run, trigger, a.config_at)]
    else:
        ap.error(f"{a.job} as a stream runs inside page-consumers")
    if a.available_now:
        for q in queries:
            q.awaitTermination()
    return queries


if __name__ == "__main__":
    qs = main()
    for q in qs:
        q.awaitTermination()
