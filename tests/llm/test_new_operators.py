"""Phrases, whitening and sharding against brute force, with all edges."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from edge_rows import SCHEMA, frame, rows
from tidemark.llm import phrases, sharding, whitening

# --- phrases ---------------------------------------------------------------------


def brute_phrases(docs, least=30, top=2000):
    """docs: (lang, text)."""
    f, n = collections.Counter(), collections.Counter()
    lower = {c: c + 32 for c in range(65, 91)}
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for m in range(1, 5):
                for i in range(len(w) - m + 1):
                    f[lang, tuple(w[i:i + m])] += 1
    often = {k: a for k, a in f.items() if a >= least}
    cand = {k: a for k, a in often.items() if len(k[1]) > 1}
    gone = set()
    for (lang, w), a in cand.items():
        for m in range(2, len(w)):
            for i in range(len(w) - m + 1):
                if 100 * a >= 80 * f[lang, w[i:i + m]]:
                    gone.add((lang, w[i:i + m]))
    out = collections.defaultdict(list)
    for (lang, w), a in cand.items():
        if (lang, w) in gone:
            continue
        score, _, left, right = min((2000000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]])
                                    for k in range(1, len(w)))
        out[lang].append((-score, -a, " ".join(w).encode(), left, right))
    return sorted((lang, i + 1, p.decode(), -a, left, right, n[lang], -s)
                  for lang, c in out.items() for i, (s, a, p, left, right) in enumerate(sorted(c)[:top]))


COLS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def _texts():
    rng = random.Random(3)
    words = ["the", "Of", "new", "york", "city", "é", "雪", "x\x1cy", "a'b", "\xa0", "zz"]
    weights = [30, 20, 9, 9, 8, 3, 3, 2, 2, 1, 1]
    out = []
    for i in range(120):
        w = rng.choices(words, weights, k=rng.randrange(0, 90))
        text = "".join(x + rng.choice([" "] * 12 + ["\t", "  ", ". ", ",", "\n", "\r\n", "\v", "; ", "!"]) for x in w)
        out.append((rng.choice(["en", "en", "de", None]), text))
    out += [("en", None), ("en", ""), ("de", " \t\n"), (None, "..."), ("de", "new york city " * 40), ("de", "new york city " * 40)]
    # one piece without an end, longer than many blocks
    out.append(("en", " ".join(rng.choices(words, weights, k=4000))))
    return out


def _frame(spark, docs):
    r = [(i, t, lang, *x[3:]) for i, ((lang, t), x) in enumerate(zip(docs, rows([(1, "")] * len(docs))))]
    return spark.createDataFrame(r, SCHEMA).repartition(3)


@pytest.mark.parametrize("sizes", [{}, {"block": 300, "bucket": 4000}, {"block": 1, "bucket": 900}])
def test_phrases(spark, sizes):
    docs = _texts()
    got = phrases.phrases(_frame(spark, docs), **sizes)
    assert got.columns == COLS
    assert sorted(tuple(r) for r in got.collect()) == brute_phrases(docs)


def test_phrases_top_and_filter(spark, monkeypatch):
    docs = _texts()
    monkeypatch.setattr(phrases, "FILTER_BITS", 1 << 6)  # nearly every look-up hits by chance
    got = phrases.phrases(_frame(spark, docs), top=3, salts=5)
    assert sorted(tuple(r) for r in got.collect()) == brute_phrases(docs, top=3)


def test_phrases_without_words(spark):
    assert phrases.phrases(_frame(spark, [("en", None), (None, " . ")])).count() == 0
    assert phrases.phrases(frame(spark, []).limit(0)).columns == COLS
    assert phrases.phrases(_frame(spark, [("en", "x")]).filter("doc_id < 0")).count() == 0


def test_blocks_count_every_window_once():
    rng = random.Random(1)
    for _ in range(200):
        data = b"".join(rng.choice([b"a", b"bb", b"ccc"]) + rng.choice([b" ", b" ", b"  ", phrases.END])
                        for _ in range(rng.randrange(60))) + phrases.END
        want = collections.Counter()
        for piece in data.split(phrases.END):
            w = piece.split()
            for m in range(1, 5):
                want.update(tuple(w[i:i + m]) for i in range(len(w) - m + 1))
        got = collections.Counter()
        for part, seen in phrases._blocks(data, rng.choice([1, 5, 20])):
            t = part.replace(phrases.END, b" " + phrases.END + b" ").split()
            for m in range(1, 5):
                got.update(tuple(t[i:i + m]) for i in range(max(0, seen - m + 1), len(t) - m + 1)
                           if phrases.END not in t[i:i + m])
        assert got == want


# --- whitening -------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, label int, n string, whitened string, component string, at int, v int"


def _vectors(spark, vs):
    return spark.createDataFrame([(i, v, 1, "x", "x", "x", 1, 1) for i, v in vs], VECTORS).repartition(3)


def _check_whitening(got, vs, most=32):
    ok = [(i, v) for i, v in vs if v and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(64 * float(np.float32(c))) + 1000000 for c in v] for _, v in ok])
    n = len(x)
    total = x.sum(axis=0)
    y = (n * x - total) / n
    cov = y.T @ y / n
    e, u = np.linalg.eigh(cov)
    e, u = e[::-1], u[:, ::-1]
    k = min(most, (e > 1e-14 * e.sum()).sum())
    dev = {}
    for (i, _), d in zip(ok, ((n * x - total).astype(object) ** 2).sum(axis=1)):
        dev.setdefault(i, []).append(int(d))
    assert len(got) == n * k
    rows_of = collections.defaultdict(list)
    for r in got:
        assert r.n == n and r.deviation in dev[r.vec_id]
        assert abs(r.explained - e[r.component - 1] / e.sum()) <= 1e-9
        assert r.identity_error <= 1e-9
        rows_of[r.component].append((r.vec_id, r.whitened))
    for c, pairs in rows_of.items():
        gap = min([abs(e[c - 1] - e[j]) for j in range(len(e)) if j != c - 1], default=1)
        if gap < 1e-6 * e[0]:
            continue  # any basis of a cluster is right
        want = sorted(zip([i if i is not None else -1 for i, _ in ok], y @ u[:, c - 1] / np.sqrt(e[c - 1])))
        have = sorted((i if i is not None else -1, w) for i, w in pairs)
        a, b = np.array([w for _, w in want]), np.array([w for _, w in have])
        if len({i for i, _ in want}) == n:
            assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-7


def test_whitening(spark):
    rng = np.random.default_rng(5)
    base = rng.standard_normal((300, 48)) @ rng.standard_normal((48, 48))
    vs = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(base)]
    bad = [(900, None), (901, []), (902, [None] * 48), (903, [float("nan")] * 48), (904, [float("inf")] + [0.0] * 47)]
    df = whitening.whiten(_vectors(spark, vs + bad))
    assert df.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    _check_whitening(df.collect(), vs)
    repeated = vs[:60] + vs[:5] + [(None, vs[70][1])]
    _check_whitening(whitening.whiten(_vectors(spark, repeated + bad)).collect(), repeated)


def test_whitening_of_little(spark):
    for vs in ([], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        assert whitening.whiten(_vectors(spark, vs)).count() == 0
    _check_whitening(whitening.whiten(_vectors(spark, [(1, [3.0]), (2, [5.0])])).collect(), [(1, [3.0]), (2, [5.0])])
    line = [(i, [float(i), 2.0 * i, 1.0]) for i in range(9)]  # one direction only
    _check_whitening(whitening.whiten(_vectors(spark, line)).collect(), line)
    huge = [(1, [3e38, 0.0]), (2, [-3e38, 1.0]), (3, [0.0, 2.0])]
    got = whitening.whiten(_vectors(spark, huge)).collect()
    assert {r.vec_id for r in got} == {1, 2, 3} and all(math.isfinite(r.whitened) for r in got)
    with pytest.raises(ValueError):
        whitening.whiten(_vectors(spark, [(1, [1.0]), (2, [1.0, 2.0])]))


@pytest.mark.parametrize("values", [
    np.arange(1, 41.0), np.r_[[5.0] * 6, [1.0] * 14], np.r_[[3 + 1e-13 * i for i in range(8)], np.zeros(12)],
    np.r_[1e12, 1e6, 1.0, 1e-6], np.zeros(5), np.ones(1), np.r_[2.0, 1.0]])
def test_eigensolver(values):
    rng = np.random.default_rng(len(values))
    q = np.linalg.qr(rng.standard_normal((len(values),) * 2))[0]
    a = (q * values) @ q.T
    a = (a + a.T) / 2
    k = min(8, len(values))
    found, vectors = whitening.leading(a, k)
    want = np.linalg.eigvalsh(a)[::-1][:k]
    scale = max(np.abs(values).max(), 1e-300)
    assert np.abs(found - want).max() <= 1e-13 * scale * len(values)
    assert np.abs(vectors.T @ vectors - np.eye(k)).max() < 1e-11
    assert np.abs(a @ vectors - vectors * found).max() <= 1e-12 * scale * len(values)
    d, e, _ = whitening.tridiagonal(a)
    t = np.linalg.eigvalsh(np.diag(d) + np.diag(e, 1) + np.diag(e, -1))
    for at in (t[0] - scale, (t[0] + t[-1]) / 2 + 0.1234 * scale, t[-1] + scale):
        assert whitening.below(d, e, np.array([at]))[0] == (t < at).sum()


# --- sharding --------------------------------------------------------------------


def test_sharding(spark):
    rng = random.Random(2)
    docs = [(i, "x" * rng.randrange(50)) for i in range(400)]
    docs += [(7, "same")] * 100 + [(None, "n")] * 30 + [(None, None), (401, None), (402, ""), (403, "é" * 200_000)]
    got = sharding.place(frame(spark, docs), bucket_rows=3, piece=8)
    assert got.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    r = got.collect()
    want = collections.Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in docs)
    assert collections.Counter((x.doc_id, x.size, x.text_crc32) for x in r) == want
    assert {x.law for x in r} == {"key"} and {x.shard for x in r} <= set(range(24)) and {x.grown_shard for x in r} <= set(range(25))
    slots = collections.defaultdict(list)
    for x in r:
        slots[x.shard].append(x.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    by_key = collections.defaultdict(set)
    for x in r:
        by_key[x.doc_id].add((x.shard, x.grown_shard))
        assert x.grown_shard in (x.shard, 24)
    assert all(len(s) == 1 for s in by_key.values())
    assert any(x.grown_shard == 24 for x in r)
    # the same whatever the partitions, buckets and pieces
    again = sharding.place(frame(spark, docs, 7), bucket_rows=1000).collect()
    assert collections.Counter(map(str, again)) == collections.Counter(map(str, r))
    assert sharding.place(frame(spark, docs).limit(0)).count() == 0


def brute_shard(doc_id, t):
    def pick(level, node):
        alive = [(c, sharding._weight(x)) for c, x in sorted(node.items()) if sharding._weight(x)]
        if len(alive) == 1:
            return alive[0][0]
        return min((-math.log((int(hashlib.md5(f"{doc_id}:{level}{c}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52) / w, c)
                   for c, w in alive)[1]
    g = pick("r", t)
    k = pick("k", t[g])
    return pick("s", t[g][k])


@pytest.mark.parametrize("n", [1, 3, 8, 9, 23, 24, 25, 30])
def test_shards_grow_one_by_one(spark, n):
    """From BASE shards on rows move into the new shard only; below it the tree's
    law holds: subtrees that keep their weight keep their rows."""
    ids = spark.range(600).withColumnRenamed("id", "doc_id")
    a, b = sharding.tree(n), sharding.tree(n + 1)
    d = sharding.with_shard(sharding.with_shard(ids, a, "a"), b, "b").collect()
    assert all(r.a == brute_shard(r.doc_id, a) and r.b == brute_shard(r.doc_id, b) for r in d[::13])
    assert {r.a for r in d} == set(range(n)) or n > 20
    if n >= sharding.BASE:
        assert all(r.b in (r.a, n) for r in d)


def test_weights_move_rows_only_by_the_changed_subtree(spark):
    a = sharding.tree(24)
    b = sharding.tree(24)
    b[1][2][9] = 3.0  # heavier
    b[2][4][17] = 0.0  # drained
    rack = {s: (g, k) for g, racks in a.items() for k, shards in racks.items() for s in shards}
    ids = spark.range(6000).withColumnRenamed("id", "doc_id")
    d = sharding.with_shard(sharding.with_shard(ids, a, "a"), b, "b").collect()
    moved = [(r.a, r.b) for r in d if r.a != r.b]
    assert moved and all(x != 9 or rack[y][0] == 1 for x, y in moved)
    assert not any(r.b == 17 for r in d)
    for x, y in moved:
        gx, gy = rack[x][0], rack[y][0]
        assert gx == 2 or gy == 1  # out of the region that lost weight, or into the one that gained
        assert gx != gy or gx in (1, 2)
    count = collections.Counter(r.b for r in d)
    assert 2.2 < count[9] / (count[8] + count[10] + count[11]) * 3 < 3.9


def test_whole_rows_reach_their_shards(spark, scratch):
    docs = frame(spark, [(i, f"t{i}") for i in range(50)] + [(1, "again"), (None, None)])
    sharding.write_shards(docs, f"{scratch}/s", files=2)
    back = spark.read.parquet(f"{scratch}/s")
    assert back.count() == 52 and set(back.columns) == set(docs.columns) | {"shard"}
    want = {r.doc_id: r.shard for r in sharding.place(docs).collect()}
    assert all(want[r.doc_id] == r.shard for r in back.collect())
    with pytest.raises(ValueError):
        sharding.write_shards(docs.withColumn("shard", F.lit(1)), f"{scratch}/x")
