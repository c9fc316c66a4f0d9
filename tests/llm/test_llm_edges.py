"""Nulls, empty and long texts, ties, repeated rows, empty tables and extra
columns, for the operators on documents."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from edge_rows import SCHEMA, frame
from tidemark.llm import (exact_dedup, line_dedup, mixing, near_dedup, pieces, quality, secrets,
                          substring_dedup, suffix_dedup, topk)

WORDS = [f"w{i}" for i in range(300)]


def _text(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def _corpus():
    rng = random.Random(5)
    base = _text(rng, 200)
    long_text = _text(rng, 30_000)
    return [(1, None), (2, ""), (3, " \t\n "), (4, base), (5, base.replace(" ", "\n\t")), (6, base + " tail"), (7, "é ü 雪 ▁"),
            (8, long_text), (9, "x " + long_text[:3000]), (None, base), (None, None), (10, "one two three"),
            (11, "dup row"), (11, "dup row"), (12, _text(rng, 40)), (12, base), (13, "w " * 500), (14, "w " * 300)]


CORPUS = _corpus()
BIG = 2**63 - 1


def _norm(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


def test_exact(spark):
    got = exact_dedup.exact_groups(frame(spark, CORPUS)).collect()
    assert len(got) == len(CORPUS)
    by = {}
    for i, t in CORPUS:
        by.setdefault(_norm(t), []).append(BIG if i is None else i)
    want = sorted((i if i is not None else -1, min(by[_norm(t)]), len(by[_norm(t)]), hashlib.sha256(_norm(t).encode()).hexdigest())
                  for i, t in CORPUS)
    assert sorted((r.doc_id if r.doc_id is not None else -1, BIG if r.keep_id is None else r.keep_id, r.group_size, r.text_sha256)
                  for r in got) == want
    # colliding chunk hashes are told apart
    few = exact_dedup.exact_groups(frame(spark, CORPUS), bits=3).collect()
    assert sorted(map(str, few)) == sorted(map(str, got))
    kept = exact_dedup.drop_copies(frame(spark, CORPUS))
    assert kept.columns == [c.split()[0] for c in SCHEMA.split(", ")]
    assert sorted(_norm(r.text) for r in kept.collect()) == sorted(by)


def _windows_removed(units, k):
    """Brute force: which units go, given [(id, [unit, ...])]."""
    first = {}
    for i, u in units:
        for a in range(len(u) - k + 1):
            key = tuple(u[a:a + k])
            first[key] = min(first.get(key, i), i)
    out = []
    for i, u in units:
        gone = [False] * len(u)
        for a in range(len(u) - k + 1):
            if first[tuple(u[a:a + k])] < i:
                gone[a:a + k] = [True] * k
        out.append(gone)
    return out


@pytest.mark.parametrize("bucket", [1 << 23, 1 << 12])
def test_substrings(spark, bucket):
    docs = [(BIG if i is None else i, (t or "").encode()) for i, t in CORPUS]
    words = [(i, t.split()) for i, t in docs]
    want = sorted((i, len(w), sum(g), b" ".join(x for x, y in zip(w, g) if not y).decode())
                  for (i, w), g in zip(words, _windows_removed(words, 13)))
    got = substring_dedup.dedup_substrings(frame(spark, CORPUS), bucket_bytes=bucket, chunk_bytes=bucket).collect()
    assert sorted((BIG if r.doc_id is None else r.doc_id, r.n_words, r.n_removed, r.kept) for r in got) == want


@pytest.mark.parametrize("bucket", [1 << 23, 1 << 12])
def test_suffixes(spark, bucket):
    small = [(i, t[:4000] if t else t) for i, t in CORPUS]
    docs = [(BIG if i is None else i, (t or "").encode()) for i, t in small]
    want = []
    for (i, t), g in zip(docs, _windows_removed(docs, 50)):
        spans = sum(1 for a, b in zip([False, *g], g) if b and not a)
        want.append((i, len(t), sum(g), spans, bytes(x for x, y in zip(t, g) if not y)))
    got = suffix_dedup.dedup_suffixes(frame(spark, small), bucket_bytes=bucket, chunk_bytes=bucket).collect()
    assert sorted((BIG if r.doc_id is None else r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got) == sorted(want)


def test_suffix_order_by_cover():
    """The suffix sort on strings with few letters, against plain comparison."""
    import numpy as np
    rng = random.Random(1)
    strings = [bytes(rng.choice(b"ab") for _ in range(rng.randint(50, 130))) for _ in range(60)]
    strings += [strings[0][:70], strings[1][5:], b"a" * 90, b"a" * 77]
    doc = np.array([rng.randint(0, 9) for _ in strings])
    who, where = suffix_dedup.equal_prefixes(strings, np.zeros(len(strings), np.int64), doc)
    first = {}
    for s, d in zip(strings, doc):
        for a in range(len(s) - 49):
            first[s[a:a + 50]] = min(first.get(s[a:a + 50], d), d)
    want = {(i, a) for i, (s, d) in enumerate(zip(strings, doc)) for a in range(len(s) - 49) if first[s[a:a + 50]] < d}
    assert set(zip(who.tolist(), where.tolist())) == want


def test_near(spark):
    got = near_dedup.near_groups(frame(spark, CORPUS)).collect()
    assert len(got) == len(CORPUS)
    same = {r.doc_id for r in got if r.class_id == 4}
    assert {4, 5, 6} <= same and None in same
    alone = [r for r in got if r.doc_id in (1, 2, 3)]
    assert all(r.class_size == 1 and r.kept for r in alone)
    assert len(near_dedup.drop_near(frame(spark, CORPUS)).columns) == len(SCHEMA.split(", "))


def test_lines(spark):
    got = line_dedup.dedup_lines(frame(spark, [*CORPUS, (20, "a line of some length\n\nanother line here"), (21, "a line of sam length\n\n\n")]))
    r = {x.doc_id: x for x in got.collect() if x.doc_id in (1, 2, 20, 21)}
    assert got.count() == len(CORPUS) + 2
    assert (r[1].n_lines, r[1].kept) == (0, "") and (r[20].n_lines, r[20].n_removed) == (2, 0)
    assert (r[21].n_lines, r[21].n_removed, r[21].kept) == (1, 1, "\n\n")


def test_mixing(spark):
    rows = [(i, t, s) for (i, t), s in zip(CORPUS, ["a", "b", None] * 10)]
    a = mixing.mix(frame(spark, rows)).collect()
    b = mixing.mix(frame(spark, rows, 7), bucket_rows=1).collect()
    assert sorted(map(str, a)) == sorted(map(str, b)) and len(a) == len(CORPUS)
    assert all(r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0) for r in a)
    total = sum(r.size for r in a)
    assert abs(sum({r.source: r.target for r in a}.values()) - total) < 1e-6 * total
    out = mixing.mixed(frame(spark, rows))
    assert out.columns == [c.split()[0] for c in SCHEMA.split(", ")]
    assert out.count() == sum(r.taken // r.size for r in a if r.size)


def _sources(rows):
    by = {}
    for r in rows:
        s = by.setdefault(r.source, [r.target, 0, 0])
        s[1] += r.taken
        s[2] = max(s[2], r.size)
    return by


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_mixing_comes_near_every_target(spark, sf):
    docs = spark.read.parquet(f"/root/testdata/sf{sf}/documents.parquet")
    rows = mixing.mix(docs).collect()
    total = sum(r.size for r in rows)
    by = _sources(rows)
    assert abs(sum(t for _, t, _ in by.values()) - total) <= max(m for _, _, m in by.values()) / 2
    for target, taken, longest in by.values():
        assert abs(taken - target) <= 0.01 * target + longest / 2


def test_one_giant_document_does_not_stand_in_the_way(spark):
    docs = [(i, _text(random.Random(i), 20), f"s{i % 4}") for i in range(400)] + [(1000, _text(random.Random(9), 40_000), "s0")]
    rows = mixing.mix(frame(spark, docs)).collect()
    by = _sources(rows)
    giant = next(r for r in rows if r.doc_id == 1000)
    # s0's target is its share of 48,000 words: the rest of s0 first, then the giant if that is nearer
    target, taken, _ = by["s0"]
    rest = 3 * 2000
    near = min((rest + k * 40_000 for k in range(4)), key=lambda t: abs(t - target))
    assert abs(taken - near) <= 800 and giant.taken in (0, 40_000)
    # the giant's middle lies at 0.87 of the virtual time, where the budget is then used up
    for s in ("s1", "s2", "s3"):
        assert by[s][1] >= by[s][0] * 0.86 - 20


def test_equal_rows_are_taken_in_part(spark):
    """A third of all rows are one document: it counts as so many copies, and no task holds them."""
    docs = [(7, "same words here again", "a")] * 300 + [(i + 1000, _text(random.Random(i), 4), "abc"[i % 3]) for i in range(600)]
    docs += [(None, "none " * 4, "b")] * 50
    got = [mixing.mix(frame(spark, docs, p), bucket_rows=b, piece=c).collect() for p, b, c in ((3, 2000, 4096), (7, 1, 7))]
    assert sorted(map(str, got[0])) == sorted(map(str, got[1])) and len(got[0]) == len(docs)
    for target, taken, longest in _sources(got[0]).values():
        assert abs(taken - target) <= 0.01 * target + longest
    assert len({r.taken for r in got[0] if r.doc_id == 7}) <= 2
    out = mixing.mixed(frame(spark, docs))
    want = {}
    for r in got[0]:
        want[r.doc_id] = want.get(r.doc_id, 0) + r.taken // max(r.size, 1)
    have = {}
    for r in out.collect():
        have[r.doc_id] = have.get(r.doc_id, 0) + 1
    assert have == {i: n for i, n in want.items() if n}


def _gone(units, k):
    """Brute force on hashes of windows, for long texts: how many units go in each."""
    first = {}
    for i, u in sorted(units):
        for a in range(len(u) - k + 1):
            first.setdefault(hash(u[a:a + k] if isinstance(u, bytes) else tuple(u[a:a + k])), i)
    out = {}
    for i, u in units:
        gone, reach = 0, 0
        for a in range(len(u) - k + 1):
            if first[hash(u[a:a + k] if isinstance(u, bytes) else tuple(u[a:a + k]))] < i:
                gone += a + k - max(a, reach)
                reach = a + k
        out[i] = gone
    return out


def test_texts_over_a_megabyte(spark):
    """Across the blocks of all operators: repeated stretches within and beside their borders."""
    rng = random.Random(12)
    word = lambda n: " ".join("%x" % rng.randrange(1 << 24) for _ in range(n))
    a, shared = word(170_000), word(40_000)
    docs = [(1, a), (2, word(60_000) + " " + shared + " " + word(50_000)), (3, shared + " " + a[300_000:900_000]), (4, a)]
    assert all(len(t) > 700_000 for _, t in docs) and len(a) > 1 << 20
    df = frame(spark, docs)
    want = _gone([(i, t.split()) for i, t in docs], 13)
    assert {r.doc_id: r.n_removed for r in substring_dedup.dedup_substrings(df).collect()} == want
    want = _gone([(i, t.encode()) for i, t in docs], 50)
    assert {r.doc_id: r.n_removed for r in suffix_dedup.dedup_suffixes(df).collect()} == want
    assert {r.doc_id: r.keep_id for r in exact_dedup.exact_groups(df).collect()} == {1: 1, 2: 2, 3: 3, 4: 1}
    assert {r.doc_id: r.class_id for r in near_dedup.near_groups(df).collect()} == {1: 1, 2: 2, 3: 3, 4: 1}
    back = pieces.decode_all(pieces.encode(df)).collect()
    assert {r.doc_id: r.text for r in back} == dict(docs)
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (3, 0, 0)], "doc_id long, quality int, toxic int")
    scores = {r.doc_id: r.score for r in quality.quality_scores(df, labels).collect()}
    assert len(scores) == 4 and scores[1] == scores[4]


def test_pieces(spark):
    rows = [*CORPUS, (30, "a▁b ▁"), (31, "\n\n x  y\t\u0000 \U0001F600"), (32, "z" * 5000)]
    e = pieces.encode(frame(spark, rows))
    back = sorted((BIG if r.doc_id is None else r.doc_id, r.text) for r in pieces.decode_all(e).collect())
    assert [(i - 0, t) for i, t in back] == sorted((BIG if i is None else i, t or "") for i, t in rows)
    again = pieces.encode(frame(spark, rows, 9))
    assert sorted(map(str, e.collect())) == sorted(map(str, again.collect()))
    other = pieces.encode(frame(spark, rows), seed=2)
    assert sorted(map(str, e.collect())) != sorted(map(str, other.collect()))


def test_secrets(spark):
    rows = [*CORPUS, (40, "Token: abcdef12 AKIA" + "Q" * 16 + "\n" + "0f" * 12), (40, "plain"),
            (41, "é password = 'x' secret=\"longer_1\" API-KEY api_key:abcdefg"), (42, "token: token: abcdef")]
    got = {(r.doc_id, r.spans) for r in secrets.report(secrets.scan(frame(spark, rows))).collect()}
    assert (40, "assign:0:15,access:16:36,hex:37:61") in got and (40, "") in got
    assert (41, "assign:17:33,assign:43:58") in got
    assert (42, "") in got  # the short match uses up the second word
    assert secrets.scan(frame(spark, rows)).count() == len(rows)


def test_trigram_queries():
    assert secrets.trigram_query(r"[0-9a-f]{24,}") == []
    assert secrets.trigram_query(r"AKIA[A-Z0-9]+") == [["aki", "kia"]]
    assert secrets.trigram_query(r"(abc|xyz)?def") == [["def"]]
    assert secrets.trigram_query(r"(abc|xy)d+") == []
    assert secrets.trigram_query(r"ab(c|d)ef") == [["abc", "bce", "cef"], ["abd", "bde", "def"]]


def test_quality(spark):
    labels = spark.createDataFrame([(4, 1, 0), (13, 0, 0), (14, 0, 0), (8, 1, 0), (4, 1, 0), (None, 1, 0), (9, None, 0)],
                                   "doc_id long, quality int, toxic int")
    for lab in (labels, labels.limit(0), labels.filter("quality = 1")):
        got = quality.quality_scores(frame(spark, CORPUS), lab).collect()
        assert len(got) == len(CORPUS)
        assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    assert len(quality.keep_good(frame(spark, CORPUS), labels).columns) == len(SCHEMA.split(", "))


def test_top_k(spark):
    rows = [(100, [1.0, 2.0]), (200, [0.5, -1.0]), (1, [1.0, 1.0]), (2, [1.0, 1.0]), (3, None), (4, [float("nan"), 1.0]),
            (5, [1.0, None]), (6, [1.0]), (None, [1.0, 1.0]), (7, []), (100, [1.0, 3.0]), (8, [float("inf"), 0.0]), (2, [1.0, 1.0])]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, shard string, g int")
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in topk.top_k(df, F.col("vec_id") % 100 == 0, k=3).collect())
    m = 1024 * 1024
    assert got == [(100, 1, 1, 3 * m), (100, 2, 2, 3 * m), (100, 3, 2, 3 * m),
                   (200, 1, 1, -m // 2), (200, 2, 2, -m // 2), (200, 3, 2, -m // 2)]
    big = spark.createDataFrame([(0, [1e300, 1.0]), (1, [1e300, 2.0]), (2, [-1e300, 2.0])], "vec_id long, embedding array<double>")
    got = topk.top_k(big, F.col("vec_id") == 0).orderBy("rank").collect()
    assert [(r.vec_id, r.score > 0) for r in got] == [(1, True), (2, False)]


def test_many_tiles_and_a_deep_tree(spark):
    import numpy as np
    rng = np.random.default_rng(3)
    v = rng.normal(size=(700, 8))
    df = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(v)], "vec_id long, embedding array<double>")
    got = topk.top_k(df, F.col("vec_id") % 50 == 0, k=5, tile=8)
    x = np.floor(v * 1024).astype(np.int64)
    for q in range(0, 700, 50):
        s = x @ x[q]
        want = sorted(((-s[i], i) for i in range(700) if i != q))[:5]
        assert [(-r.score, r.vec_id) for r in got.filter(F.col("query_id") == q).orderBy("rank").collect()] == want


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    for df in (exact_dedup.exact_groups(none), substring_dedup.dedup_substrings(none), suffix_dedup.dedup_suffixes(none),
               near_dedup.near_groups(none), line_dedup.dedup_lines(none), mixing.mix(none), mixing.mixed(none),
               pieces.decode_all(pieces.encode(none)), secrets.report(secrets.scan(none)),
               quality.quality_scores(none, labels), quality.keep_good(none, labels), exact_dedup.drop_copies(none),
               near_dedup.drop_near(none), topk.top_k(vectors, F.col("vec_id") % 100 == 0)):
        assert df.count() == 0


def test_secrets_in_a_text_with_very_many_matches(spark):
    """The time of a text is in proportion to its matches; all places are right."""
    import time
    def text(n):
        return " ".join(f"token={i:06d}xy é" for i in range(n))
    took = []
    for n in (2000, 32_000):
        t = time.time()
        (r,) = secrets.report(secrets.scan(frame(spark, [(1, text(n))]))).collect()
        took.append(time.time() - t)
        want = ",".join(f"assign:{m.start()}:{m.end()}" for m in re.finditer(r"token=[0-9a-z]+", text(n)))
        assert r.n_assign == n and r.spans == want
    assert took[1] < 16 * took[0] + 20
