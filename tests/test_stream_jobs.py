"""The runnable streaming jobs wired together: log split -> topic folders ->
page consumers, each with its checkpoint under spark.checkpoint.dir."""

import os


from conftest import SF_SMALL
from tidemark.plans import jobs
from tidemark.plans import flows as pl
from tidemark.sources.fixtures import raw_log
from tidemark.sources.logs import read_log_stream


def test_log_split_then_page_consumers(spark, scratch):
    src = os.path.join(scratch, "raw")
    raw_log(spark, SF_SMALL).repartition(3).write.parquet(src)
    topics = os.path.join(scratch, "topics")
    q = jobs.start_log_split(spark, read_log_stream(spark, "parquet", src), topics, "r",
                             trigger={"availableNow": True})
    q.awaitTermination()
    routed = spark.read.parquet(topics)
    assert routed.count() == pl.routed_log(spark, SF_SMALL).count()

    page_src = read_log_stream(spark, "parquet", jobs.page_topic(topics),
                               {"recursiveFileLookup": "true"})
    out = os.path.join(scratch, "out")
    for q in jobs.start_page_consumers(spark, page_src, out, "r", trigger={"availableNow": True}):
        q.awaitTermination()
    uv = spark.read.parquet(os.path.join(out, jobs.TOPIC_UNIQUE_VISITOR)).count()
    assert 0 < uv <= pl.unique_visitors(spark, SF_SMALL).count()
    assert spark.read.parquet(os.path.join(out, jobs.TOPIC_USER_JUMP)).count() > 0
    kw = spark.read.parquet(os.path.join(out, jobs.TABLE_KEYWORD_WINDOW))
    assert kw.count() > 0
    from tidemark.session import checkpoint_dir
    assert os.path.isdir(os.path.join(checkpoint_dir(spark), "ckpt", "log_split"))
