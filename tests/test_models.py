"""Batch forms of T1-T4 against sequential models on random inputs with
ties, disorder and hot devices."""

import json
import random

import pytest

import models
from helpers import D1, DAY, by_seq, log_line, pages, parsed, seqs
from tidemark.operators.bounce import user_jump
from tidemark.operators.dim import config_state, parse_config_changes
from tidemark.operators.unique import unique_visitor
from tidemark.operators.visitor import visitor_flag_repair


def _random_rows(seed, n=300):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        mid = "hot" if rnd.random() < 0.35 else f"m{rnd.randrange(8)}"
        ts = D1 + rnd.randrange(4) * DAY + rnd.choice([0, 1, 5000, 9999, 10000, 10001, 60000]) * rnd.randrange(40)
        rows.append({"seq": i, "mid": mid, "ts": ts,
                     "is_new": rnd.choice(["1", "0", None]),
                     "lp": rnd.choice([None, None, "", "home", "search"])})
    rnd.shuffle(rows)  # arrival order is (ts, seq), whatever the list order
    rows.sort(key=lambda r: r["seq"])
    return rows


def _lines(rows):
    return [log_line(r["mid"], r["ts"], r["is_new"], r["lp"]) for r in rows]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_t1_visitor_flag(spark, seed):
    rows = _random_rows(seed)
    got = by_seq(visitor_flag_repair(parsed(spark, _lines(rows))), "is_new")
    assert got == models.visitor_flag(rows)


@pytest.mark.parametrize("seed", [4, 5, 6])
def test_t2_unique_visitor(spark, seed):
    rows = _random_rows(seed)
    assert seqs(unique_visitor(pages(spark, _lines(rows)))) == models.unique_visitor(rows)


@pytest.mark.parametrize("seed,within,factor", [(7, 10_000, 4), (8, 10_000, 1), (9, 60_000, 3),
                                                (10, DAY, 2)])
def test_t3_bounce(spark, seed, within, factor):
    rows = _random_rows(seed)
    got = seqs(user_jump(pages(spark, _lines(rows)), within, bucket_factor=factor))
    assert got == models.bounce(rows, within)


def _tp(src, sink):
    return {"source_table": src, "sink_table": sink, "sink_columns": "id", "sink_pk": "id",
            "sink_extend": None}


@pytest.mark.parametrize("seed", range(5))
def test_t4_config_fold(spark, seed):
    rnd = random.Random(seed)
    names, cur, changes = "abcde", {}, []
    for _ in range(40):
        op = rnd.choice("rcud")
        src = rnd.choice(names)
        if op == "d":
            changes.append(("d", _tp(src, cur.get(src, "x")), None))
        elif op == "u":
            new_src = rnd.choice(names)  # may rename
            changes.append(("u", _tp(src, cur.get(src, "x")), _tp(new_src, f"s{rnd.randrange(9)}")))
        else:
            changes.append((op, None, _tp(src, f"s{rnd.randrange(9)}")))
    rows = [(json.dumps({"op": op, "before": b, "after": a}), i) for i, (op, b, a) in enumerate(changes)]
    df = parse_config_changes(spark.createDataFrame(rows, "value string, seq bigint"))
    got = {r["source_table"]: r["sink_table"] for r in config_state(df).collect()}
    assert got == models.config_fold(changes)
