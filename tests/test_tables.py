"""Versioned keyed tables and the dimension tables on them (K3, K4)."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.dim import config_state, parse_changes, parse_config_changes, route
from tidemark.sinks import files
from tidemark.sinks.dim import dim_table, read_dim_table, upsert_dim_tables
from tidemark.sinks.versioned import Conflict, VersionedTable

ROWS = "k string, v bigint, at bigint"


def _last(both):
    g = both.groupBy("k").agg(F.max_by(F.struct("v", "at"), "at").alias("l"))
    return g.select("k", "l.v", "l.at")


def _rows(df):
    return {r["k"]: r["v"] for r in df.collect()}


def test_versions_keep_what_they_were(spark, scratch):
    t = VersionedTable(spark, f"{scratch}/t", "k", bucket_rows=20)
    assert t.manifest() is None
    rng = random.Random(1)
    want, history = {}, []
    for batch in range(6):
        rows = [(f"k{rng.randrange(40 * (batch + 1))}", rng.randrange(1000), batch * 1000 + i) for i in range(30)]
        t.fold(spark.createDataFrame(rows, ROWS), _last)
        for k, v, _ in rows:
            want[k] = v
        history.append(dict(want))
    m = t.manifest()
    assert m["buckets"] >= 8 and sum(f["rows"] for f in m["folders"].values()) == len(want)  # grown by splitting
    for v, rows in enumerate(history):
        assert _rows(t.read(version=v)) == rows
    gone = t.vacuum(keep=1)
    assert gone and t.versions() == [5] and _rows(t.read()) == history[-1]


def test_untouched_buckets_are_not_rewritten(spark, scratch):
    t = VersionedTable(spark, f"{scratch}/t", "k", bucket_rows=10)
    t.fold(spark.createDataFrame([(f"k{i}", i, 0) for i in range(70)], ROWS), _last)
    before = t.manifest()["folders"]
    t.fold(spark.createDataFrame([("k3", -1, 1)], ROWS), _last)
    after = t.manifest()["folders"]
    assert sum(before[b] != after[b] for b in before) == 1 and _rows(t.read())["k3"] == -1


def test_a_crash_before_the_commit_leaves_the_old_version(spark, scratch, monkeypatch):
    t = VersionedTable(spark, f"{scratch}/t", "k")
    t.fold(spark.createDataFrame([("a", 1, 0)], ROWS), _last)

    def dies(manifest):
        raise KeyboardInterrupt
    monkeypatch.setattr(t, "commit", dies)
    with pytest.raises(KeyboardInterrupt):
        t.fold(spark.createDataFrame([("a", 2, 1), ("b", 2, 1)], ROWS), _last)
    fresh = VersionedTable(spark, f"{scratch}/t", "k")
    assert _rows(fresh.read()) == {"a": 1}
    assert len(fresh.vacuum()) == 1  # what the dead job wrote
    fresh.fold(spark.createDataFrame([("b", 3, 2)], ROWS), _last)
    assert _rows(fresh.read()) == {"a": 1, "b": 3}


def test_of_two_writers_one_wins(spark, scratch):
    a, b = (VersionedTable(spark, f"{scratch}/t", "k") for _ in range(2))
    a.fold(spark.createDataFrame([("a", 1, 0)], ROWS), _last)
    stale = b.manifest()
    a.fold(spark.createDataFrame([("a", 2, 1)], ROWS), _last)
    with pytest.raises(Conflict):
        b.commit({**stale, "version": stale["version"] + 1})
    assert _rows(b.read()) == {"a": 2}
    assert not files.put_new(spark, f"{scratch}/t/manifests/{1:012d}.json", "x")


def test_an_empty_batch_makes_the_table(spark, scratch):
    t = VersionedTable(spark, f"{scratch}/t", "k")
    t.fold(spark.createDataFrame([], ROWS), _last)
    assert t.versions() == [0] and t.read().count() == 0 and t.read().columns == ["k", "v", "at"]


# --- dimension tables -------------------------------------------------------------

CHANGE = "value string, seq bigint, src_ts bigint, part int"


def _change(table, seq, typ="update", **data):
    return (json.dumps({"table": table, "type": typ, "data": data}), seq, seq, 0)


def _state(spark, *tables):
    rows = [(json.dumps({"op": "r", "before": None, "after": {
        "source_table": s, "sink_table": t, "sink_columns": c, "sink_pk": pk, "sink_extend": None}}), i)
        for i, (s, t, c, pk) in enumerate(tables)]
    return config_state(parse_config_changes(spark.createDataFrame(rows, "value string, seq bigint")))


def _fold(spark, root, state, rows, run_no=0):
    return upsert_dim_tables(route(parse_changes(spark.createDataFrame(rows, CHANGE)), state), state, root, run_no)


def _dim(spark, root, name="dim_x"):
    df = read_dim_table(spark, root, name)
    return {r["row_key"]: {c: r[c] for c in df.columns if c not in ("row_key",)} for r in df.collect()}


def test_two_sources_feed_one_table_column_by_column(spark, scratch):
    s = _state(spark, ("a", "dim_x", "id,name", "id"), ("b", "dim_x", "id,city", "id"))
    assert _fold(spark, scratch, s, [_change("a", 1, id=1, name="n1"), _change("b", 2, id=1, city="c1"),
                                     _change("b", 3, id=2, city="c2")]) == ["dim_x"]
    assert _dim(spark, scratch) == {"1": {"id": "1", "name": "n1", "city": "c1"}, "2": {"id": "2", "name": None, "city": "c2"}}
    _fold(spark, scratch, s, [_change("a", 4, id=2, name="it's")])
    assert _dim(spark, scratch)["2"] == {"id": "2", "name": "it's", "city": "c2"}


def test_columns_are_added_and_kept(spark, scratch):
    _fold(spark, scratch, _state(spark, ("a", "dim_x", "id,name", "id")), [_change("a", 10, id=1, name="x"), _change("a", 11, id=2, name="y")])
    s = _state(spark, ("a", "dim_x", "id,city", "id"))  # name is gone from the config, not from the table
    _fold(spark, scratch, s, [_change("a", 5, id=1, name="old", city="early"), _change("a", 12, id=3, city="z")], 1)
    assert _dim(spark, scratch) == {"1": {"id": "1", "name": "x", "city": "early"}, "2": {"id": "2", "name": "y", "city": None},
                                    "3": {"id": "3", "name": None, "city": "z"}}


def test_values_of_all_kinds_and_any_order_of_batches(spark, scratch):
    s = _state(spark, ("a", "dim_x", "id,v", "id"))
    rows = [_change("a", i, id=i % 4, v=v) for i, v in enumerate(["it's", None, "", 1.5, {"n": 1}, "snow é 雪", None, True])]
    rows += [_change("a", 20, typ="delete", id=1, v="gone"), ("{}", 21, 21, 0), _change("a", 22, v="no key")]
    rng = random.Random(4)
    for at, order in enumerate((rows, rows[::-1], rng.sample(rows, len(rows)))):
        root = f"{scratch}/{at}"
        for i in range(0, len(order), 3):
            _fold(spark, root, s, order[i:i + 3], i)
        _fold(spark, root, s, order[:3], 99)  # replayed
        assert {k: v["v"] for k, v in _dim(spark, root).items()} == {"0": '{"n":1}', "1": "gone", "2": None, "3": "true"}
    assert "1" not in {r["row_key"] for r in read_dim_table(spark, f"{scratch}/0", "dim_x", apply_deletes=True).collect()}


def test_a_key_with_most_changes_is_combined_before_the_shuffle(spark, scratch):
    s = _state(spark, ("a", "dim_x", "id,v", "id"))
    rows = [_change("a", i, id=7 if i % 3 else i, v=str(i)) for i in range(600)]
    _fold(spark, scratch, s, rows)
    assert _dim(spark, scratch)["7"]["v"] == "599"
    assert dim_table(spark, scratch, "dim_x").manifest()["version"] == 0


def test_clashing_column_names_are_refused(spark, scratch):
    with pytest.raises(ValueError):
        _fold(spark, scratch, _state(spark, ("a", "dim_x", "id,at", "id")), [_change("a", 1, id=1)])
