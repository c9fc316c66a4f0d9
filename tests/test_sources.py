"""S1/S2 file forms of the log source (Kafka needs a connector jar and a
broker, neither of which exists here)."""

import os

from pyspark.sql import functions as F

from tidemark.operators.parse import parse_log
from tidemark.sources.fixtures import raw_log
from tidemark.sources.logs import read_log, read_log_stream

from conftest import SF_SMALL


def test_json_text_and_parquet_sources_agree(spark, scratch):
    raw = raw_log(spark, SF_SMALL)
    raw.write.parquet(os.path.join(scratch, "pq"))
    raw.write.json(os.path.join(scratch, "js"))
    raw.select("value").write.text(os.path.join(scratch, "tx"))
    pq = read_log(spark, "parquet", os.path.join(scratch, "pq"))
    js = read_log(spark, "json", os.path.join(scratch, "js"))
    tx = read_log(spark, "text", os.path.join(scratch, "tx"))
    assert pq.exceptAll(js).count() == 0 and js.count() == 1420
    assert tx.filter(F.col("seq").isNotNull()).count() == 0
    assert sorted(r.value for r in tx.collect()) == sorted(r.value for r in pq.collect())
    good = parse_log(tx).filter(F.col("dirty").isNull()).count()
    assert good == 1400


def test_stream_source_schema(spark, scratch):
    raw_log(spark, SF_SMALL).write.parquet(os.path.join(scratch, "pq"))
    s = read_log_stream(spark, "parquet", os.path.join(scratch, "pq"))
    assert s.isStreaming and s.columns == ["value", "seq"]


def test_every_document_is_searched_whole(spark):
    from tidemark.operators.keyword import keyword_filter
    from tidemark.plans import flows
    from tidemark.sources.fixtures import table
    docs = table(spark, SF_SMALL, "documents")
    found = keyword_filter(flows.page_log(spark, SF_SMALL, repaired=False)).select("fullword").distinct()
    assert docs.select("text").distinct().exceptAll(found).count() == 0


def test_all_order_codes_are_known(spark):
    from tidemark.plans.queries import queries
    assert queries()["dic_lookup"](spark, SF_SMALL).filter("dic_code IS NULL OR dic_name IS NULL").count() == 0
