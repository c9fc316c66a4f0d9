"""The corpus pipeline against what its operators say, stage by stage, and
against brute force where there is one."""

import collections
import re

import corpus_pipeline as P
from conftest import SF_SMALL
from pyspark.sql import functions as F
from test_llm_brute import _classes
from tidemark.llm import mixing, quality


def test_stages(spark, scratch):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in P.STAGES:
        before = docs
        stage(spark, docs, SF_SMALL).write.parquet(f"{scratch}/{name}")
        docs = spark.read.parquet(f"{scratch}/{name}")
        seen[name] = (before, docs)
        if name != P.STAGES[-1][0]:
            assert docs.columns == columns
    ids = lambda df: collections.Counter(r[0] for r in df.select("doc_id").collect())

    before, after = seen["quality"]
    scores = quality.quality_scores(before, spark.read.parquet(f"{SF_SMALL}/labels.parquet"))
    assert ids(after) == ids(scores.filter("predicted = 1"))

    before, after = seen["exact_dedup"]
    first = {}
    for i, t in sorted((r.doc_id, r.text) for r in before.collect()):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t), i)
    assert ids(after) == collections.Counter(first.values())

    before, after = seen["near_dedup"]
    classes = _classes([(r.doc_id, r.text) for r in before.collect()])
    assert ids(after) == collections.Counter(set(classes.values()))

    before, after = seen["mixing"]
    m = mixing.mix(before).filter("taken > 0").collect()
    assert ids(after) == collections.Counter({r.doc_id: r.taken // r.size for r in m})

    before, after = seen["sentencepiece"]
    sha = before.select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("s"))
    assert (collections.Counter(map(tuple, after.select("doc_id", "decoded_sha256").collect()))
            == collections.Counter(map(tuple, sha.collect())))


def test_run_is_the_stages(spark):
    got = P.run(spark, SF_SMALL)
    assert got.columns == ["doc_id", "n_pieces", "ids", "decoded_sha256"] and got.count() > 0
    assert [n for n, _ in P.STAGES] == ["quality", "exact_dedup", "near_dedup", "mixing", "sentencepiece"]
