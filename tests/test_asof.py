"""As-of joins: config and dictionary by each row's own position."""

import json
import random

import pytest

from tidemark.operators.asof import asof_join, validity
from tidemark.operators.dic import dic_lookup_asof, dictionary_history, lookup_batch_writer
from tidemark.operators.dim import config_history, parse_changes, parse_config_changes, route_asof
from tidemark.plans import jobs
from tidemark.sinks.dim import read_dim_table


def _tp(src, sink, cols, pk="id"):
    return {"source_table": src, "sink_table": sink, "sink_columns": cols, "sink_pk": pk, "sink_extend": None}


def _config(spark, changes):
    rows = [(json.dumps({"op": op, "before": b, "after": a}), at) for at, op, b, a in changes]
    return spark.createDataFrame(rows, "value string, seq bigint")


def _changes(spark, rows):
    return spark.createDataFrame([(json.dumps({"table": t, "type": "update", "data": d}), at) for at, t, d in rows],
                                 "value string, seq bigint")


def _replay(config, rows):
    """The reference's way: one log of config and business changes, in order."""
    held, out = {}, []
    events = [(at, 0, i, c) for i, (at, *c) in enumerate(config)] + [(at, 1, i, r) for i, (at, *r) in enumerate(rows)]
    for at, kind, _, e in sorted(events, key=lambda x: x[:3]):
        if kind == 0:
            op, before, after = e
            if op == "d":
                held.pop(before["source_table"], None)
            else:
                held[after["source_table"]] = after
        elif e[0] in held:
            c = held[e[0]]
            out.append((at, c["sink_table"], tuple(sorted((k, str(v)) for k, v in e[1].items() if k in c["sink_columns"].split(",")))))
    return sorted(out)


def _routed(spark, config, rows):
    h = config_history(parse_config_changes(_config(spark, config)))
    r = route_asof(parse_changes(_changes(spark, rows)), h)
    return sorted((x.seq, x.sink_table, tuple(sorted((k, v) for k, v in x.d.items()))) for x in
                  r.selectExpr("seq", "sink_table", "transform_values(data, (k, v) -> to_json(v)) AS d").collect())


def _texts(want):
    return [(at, t, tuple((k, v) for k, v in d)) for at, t, d in want]


def test_config_as_of_each_change(spark):
    a1, a2, a3 = _tp("t", "x", "id,a"), _tp("t", "x", "id,a,b"), _tp("t", "y", "id,b")
    config = [(10, "r", None, a1), (20, "u", a1, a2), (30, "d", a2, None), (40, "c", None, a3)]
    rows = [(at, "t", {"id": at, "a": 1, "b": 2}) for at in (5, 10, 15, 20, 29, 30, 35, 40, 99)] + [(50, "other", {"id": 1})]
    got = _routed(spark, config, rows)
    assert got == _texts(_replay(config, rows))
    assert [at for at, _, _ in got] == [10, 15, 20, 29, 40, 99]  # lost before, and while deleted


@pytest.mark.parametrize("seed", range(6))
def test_random_histories_equal_a_replay(spark, seed):
    rng = random.Random(seed)
    config, live = [], {}
    for at in sorted(rng.sample(range(100), 14)):
        src = rng.choice("tuv")
        new = _tp(src, rng.choice("xyz"), rng.choice(["id,a", "id,a,b", "id,b", "id"]))
        if src in live and rng.random() < 0.3:
            config.append((at, "d", live.pop(src), None))
        elif src in live and rng.random() < 0.2:  # renamed: the old key stays behind
            other = rng.choice("tuv")
            config.append((at, "u", live[src], {**new, "source_table": other}))
            live[other] = config[-1][3]
        else:
            config.append((at, "u" if src in live else "c", live.get(src), new))
            live[src] = new
    rows = [(rng.randrange(110), rng.choice("tuvw"), {"id": i, "a": i, "b": i}) for i in range(60)]
    assert _routed(spark, config, rows) == _texts(_replay(config, rows))


def test_two_changes_at_one_position(spark):
    a1, a2 = _tp("t", "x", "id,a"), _tp("t", "x", "id,b")
    h = config_history(parse_config_changes(_config(spark, [(10, "c", None, a1), (10, "u", a1, a2)])))
    assert h.count() == 1  # only one of them is ever valid


def test_job_follows_the_config_of_its_time(spark, scratch):
    a1, a2 = _tp("t", "x", "id,a"), _tp("t", "x", "id,a,b")
    config = _config(spark, [(10, "r", None, a1), (20, "u", a1, a2)])
    rows = _changes(spark, [(5, "t", {"id": 1, "a": 1, "b": 1}), (15, "t", {"id": 2, "a": 2, "b": 2}), (25, "t", {"id": 3, "a": 3, "b": 3})])
    jobs.dim(rows, config, f"{scratch}/d", "r", 0, config_at="seq")
    got = {r["row_key"]: (r["a"], r["b"]) for r in read_dim_table(spark, f"{scratch}/d", "x").collect()}
    assert got == {"2": ("2", None), "3": ("3", "3")}
    with pytest.raises(ValueError):
        jobs.dim(rows, config, f"{scratch}/e", "r")  # no source time and no run number


def test_beyond_the_broadcast_size_versions_are_dealt_by_slots(spark):
    rng = random.Random(9)
    changes = [(rng.choice("ab"), at, f"v{at}") for at in range(0, 400, 3)]
    facts = [(rng.choice("abc"), rng.randrange(-10, 500)) for _ in range(300)]
    v = validity(spark.createDataFrame(changes, "k string, p bigint, name string"), ["k"], "p").withColumnRenamed("k", "_k")
    f = spark.createDataFrame(facts, "k string, at bigint")
    one = asof_join(f, v, [("k", "_k")], "at", how="left")
    many = asof_join(f, v, [("k", "_k")], "at", how="left", max_rows=1, width=25)
    assert sorted(map(str, one.collect())) == sorted(map(str, many.collect())) and many.columns == ["k", "at", "name"]
    assert "_slot_v" in many._jdf.queryExecution().optimizedPlan().toString()


def test_dictionary_as_of(spark):
    h = dictionary_history(spark.createDataFrame(
        [(0, "1", "old", "0"), (100, "1", "new", "0"), (150, "1", None, None), (200, "1", "back", "0")],
        "at bigint, dic_code string, dic_name string, parent_code string"))
    f = spark.createDataFrame([("1", p) for p in (-1, 0, 99, 100, 119, 160, 199, 200, 205)] + [("9", 1), (None, 1), ("1", None)],
                              "dic_code string, at bigint")
    got = {(r.dic_code, r.at): r.dic_name for r in dic_lookup_asof(f, h, "at").collect()}
    assert [got["1", p] for p in (-1, 0, 99, 100, 119, 160, 199, 200, 205)] == \
        [None, "old", "old", "new", "new", None, None, "back", "back"]
    assert got["9", 1] is None and got[None, 1] is None and got["1", None] is None and len(got) == 12
    # through a copy refreshed every 60: positions 99 and 119 still see the entries of 60
    cached = {(r.dic_code, r.at): r.dic_name for r in dic_lookup_asof(f, h, "at", ttl=60).collect()}
    assert [cached["1", p] for p in (99, 100, 119, 160, 199, 205)] == ["old", "old", "old", "new", None, None]


def test_stream_sees_a_dictionary_that_changes_between_batches(spark, scratch):
    schema = "dic_code string, dic_name string, parent_code string"
    now, seen, loads = {"t": 0.0, "name": "a"}, [], []

    def load():
        loads.append(now["t"])
        return spark.createDataFrame([("1", now["name"], "0")], schema)

    body = lookup_batch_writer(load, lambda df, i: seen.append((i, [r.dic_name for r in df.collect()])), ttl_s=10,
                               clock=lambda: now["t"])
    src = f"{scratch}/src"
    for i, (t, name) in enumerate([(0, "a"), (5, "b"), (11, "c")]):
        now.update(t=float(t), name=name)
        spark.createDataFrame([("1",)], "dic_code string").write.parquet(f"{src}/{i}")
        s = spark.readStream.schema("dic_code string").option("recursiveFileLookup", "true").parquet(src)
        s.writeStream.foreachBatch(body).option("checkpointLocation", f"{scratch}/ck").trigger(availableNow=True).start().awaitTermination()
    assert seen == [(0, ["a"]), (1, ["a"]), (2, ["c"])] and loads == [0.0, 11.0]
