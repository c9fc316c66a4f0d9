"""The command line wires sources to the jobs."""

import os

from conftest import SF_SMALL
from tidemark.__main__ import main
from tidemark.plans import flows as pl
from tidemark.sources.fixtures import change_log, config_changelog, raw_log


def test_cli_batch_and_stream(spark, scratch):
    raw = os.path.join(scratch, "raw")
    raw_log(spark, SF_SMALL).write.parquet(raw)
    main(["log-split", "--input", raw, "--out", os.path.join(scratch, "t1"), "--run", "a"], spark=spark)
    assert spark.read.parquet(os.path.join(scratch, "t1")).count() == pl.routed_log(spark, SF_SMALL).count()
    main(["keyword-window", "--input", raw, "--out", os.path.join(scratch, "kw"), "--run", "a"], spark=spark)
    assert spark.read.parquet(os.path.join(scratch, "kw")).count() > 0

    ch, cfg = os.path.join(scratch, "ch"), os.path.join(scratch, "cfg")
    change_log(spark, SF_SMALL).write.parquet(ch)
    config_changelog(spark).write.parquet(cfg)
    main(["dim", "--input", ch, "--config", cfg, "--out", os.path.join(scratch, "dim"),
          "--run", "s", "--stream", "--available-now"], spark=spark)
    from tidemark.operators.dim import latest_per_key
    from tidemark.sinks.dim import read_dim_table
    got = sum(read_dim_table(spark, os.path.join(scratch, "dim"), t, []).count()
              for t in ("dim_customer", "dim_part", "dim_customer_last_order"))
    assert got == latest_per_key(pl.dim_routed(spark, SF_SMALL)).count()
