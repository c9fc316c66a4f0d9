"""The keyword job on a stream holds a few state rows for each window, not one for each word."""

from __future__ import annotations

import collections
import json
import os
import random
import re

from pyspark.sql import functions as F

from tidemark.operators.keyword import PARTS
from tidemark.sources.fixtures import DOC_TS
from tidemark.streaming import jobs as J


def _page(text, ts, last="search"):
    return json.dumps({"common": {"mid": "m"}, "page": {"page_id": "p", "last_page_id": last, "item_type": "keyword",
                                                        "item": text}, "ts": DOC_TS + ts})


def test_words_of_a_window_in_few_state_rows(spark, scratch):
    r, root, want = random.Random(9), os.path.join(scratch, "in"), collections.Counter()
    batches = []
    for _ in range(2):
        lines = []
        for _ in range(60):
            ts = r.randrange(0, 40_000)
            text = r.choice(["", "...", "Ä 漢 9"]) + " " + " ".join(r.choice(["w", "W-"]) + str(r.randrange(400)) for _ in range(50))
            lines.append(_page(text, ts))
            want.update((ts // 10_000, w) for w in re.findall(r"[^\W_]+", text.lower()))
        batches.append(lines + [_page("...", 5)])
    batches += [[_page("end", 10**8, "home")], [_page("end", 2 * 10**8, "home")]]
    for k, lines in enumerate(batches):
        spark.createDataFrame([(v, i) for i, v in enumerate(lines)], "value string, seq bigint").coalesce(1).write.mode(
            "append").parquet(f"{root}/{k}")
    stream = (spark.readStream.schema("value string, seq bigint").option("recursiveFileLookup", "true")
              .option("maxFilesPerTrigger", 1).parquet(root))
    out, most = f"{scratch}/out", 0
    q = (J.keyword_window_stream(J.page_log_from_topic(stream), delay="1 day", with_ts=False)
         .writeStream.format("parquet").option("checkpointLocation", f"{scratch}/ck").trigger(availableNow=True).start(out))
    q.awaitTermination()
    assert q.exception() is None
    for p in q.recentProgress:
        most = max([most, *(s["numRowsTotal"] for s in p["stateOperators"])])
    got = spark.read.parquet(out).select(((F.unix_timestamp("stt") * 1000 - DOC_TS) / 10_000).cast("int").alias("k"),
                                         "keyword", "keyword_count")
    rows = [tuple(x) for x in got.collect()]
    assert len(rows) == len(want) and {(k, w): n for k, w, n in rows} == dict(want)
    assert 0 < most <= 4 * PARTS < len(want)
