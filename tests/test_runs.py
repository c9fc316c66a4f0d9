"""Run outputs: committed once, whole, whatever moment a writer dies at (K1)."""

import pytest

from tidemark.sinks import files, runs
from tidemark.sinks.kafka import write_topics_files

ROUTED = "topic string, seq bigint, mid string, value string"


def _rows(spark, *pairs):
    return spark.createDataFrame([(t, i, "m", "v") for t, i in pairs], ROUTED)


def _read(spark, root):
    return sorted((r.run, r.topic, r.seq) for r in runs.read_runs(spark, root, ROUTED + ", run string").collect())




@pytest.mark.parametrize("nth", range(12))
def test_a_writer_that_dies_leaves_the_old_output_or_the_new(spark, scratch, monkeypatch, nth):
    root = f"{scratch}/out"
    write_topics_files(_rows(spark, ("a", 1), ("b", 2)), root, "r1")
    write_topics_files(_rows(spark, ("a", 9)), root, "r2")
    old, new = [("r1", "a", 1), ("r1", "b", 2)], [("r1", "a", 5), ("r1", "c", 6)]
    calls = {"n": 0}

    def counted(real):
        def call(*args):
            calls["n"] += 1
            if calls["n"] == nth + 1:
                raise KeyboardInterrupt
            return real(*args)
        return call

    with monkeypatch.context() as m:
        for name in ("put_new", "delete", "move"):
            m.setattr(files, name, counted(getattr(files, name)))
        try:
            write_topics_files(_rows(spark, ("a", 5), ("c", 6)), root, "r1")
        except KeyboardInterrupt:
            pass
    got = _read(spark, root)
    assert got[-1] == ("r2", "a", 9)
    assert got[:-1] in (old, new)
    # the repeated run ends right, once
    write_topics_files(_rows(spark, ("a", 5), ("c", 6)), root, "r1")
    assert _read(spark, root)[:-1] == new
    assert sorted((r.run, r.topic, r.seq) for r in spark.read.parquet(root).collect())[:-1] == new


def test_a_replayed_batch_writes_nothing_twice(spark, scratch):
    root = f"{scratch}/out"
    write_topics_files(_rows(spark, ("a", 1)), root, "s-000", once=True)
    write_topics_files(_rows(spark, ("a", 1), ("a", 1)), root, "s-000", once=True)
    assert _read(spark, root) == [("s-000", "a", 1)] and runs.committed(spark, root, "s-000")
    assert not runs.committed(spark, root, "s-001")


def test_runs_share_no_temporary_folder(spark, scratch):
    root = f"{scratch}/out"
    for r in ("r1", "r2"):
        write_topics_files(_rows(spark, ("a", 1)), root, r)
    assert files.names(spark, f"{root}/_attempts") == [] and not files.exists(spark, f"{root}/_temporary")


def test_an_empty_run(spark, scratch):
    root = f"{scratch}/out"
    write_topics_files(_rows(spark, ("a", 1)), root, "r")
    write_topics_files(spark.createDataFrame([], ROUTED), root, "r")
    assert _read(spark, root) == []
