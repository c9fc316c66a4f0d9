"""What SQL cannot express: brute force, exact distributions, held-out accuracy."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tidemark.llm import line_dedup, near_dedup, pieces, queries as Q
from tidemark.llm.windows import mix


def test_pieces_are_drawn_by_their_probability():
    model = pieces.read_model()
    lattice, n = pieces.Lattice(model, 0.7), 60_000
    ids, count = lattice.draw([b"hello"] * n, mix(np.arange(n).astype(np.uint64)))
    ends = np.cumsum(count)
    seen = Counter(tuple(ids[a:z].tolist()) for a, z in zip([0, *ends[:-1]], ends))

    def segmentations(b):
        if not b:
            yield (), 0.0
        for j in range(1, len(b) + 1):
            if b[:j] in model["pieces"]:
                i, w = model["pieces"][b[:j]]
                for rest, x in segmentations(b[j:]):
                    yield (i, *rest), w + x

    weight = {s: math.exp(0.7 * x) for s, x in segmentations(b" hello")}
    total = sum(weight.values())
    assert len(weight) > 10 and set(seen) <= set(weight)
    for s, w in weight.items():
        p = w / total
        assert abs(seen[s] / n - p) < 5 * math.sqrt(p * (1 - p) / n) + 1e-4


def test_pieces_of_whole_table_decode_to_it(spark):
    got = Q.op3_sentencepiece(spark, SF_SMALL)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("sha"))
    assert got.count() == docs.count()
    assert got.join(docs, "doc_id").filter("sha <> decoded_sha256").count() == 0


def test_signatures_are_unbiased():
    rng = np.random.default_rng(0)
    diff = []
    for n in range(40):
        a = [int(x) for x in rng.integers(0, 30 if n % 2 else 5000, 300)]
        b = list(a)
        for j in rng.integers(0, 300, int(rng.integers(1, 25))):
            b[j] = int(rng.integers(0, 5000))
        ta, tb = (b" ".join(b"w%d" % x for x in v) for v in (a, b))
        s = near_dedup.signatures([ta, tb], m=1024)
        least, most = near_dedup.overlap(Counter(near_dedup.shingles(ta)), Counter(near_dedup.shingles(tb)))
        diff.append((s[0] == s[1]).mean() - least / most)
    assert abs(np.mean(diff)) < 0.01 and np.std(diff) < 0.03


def test_packed_signatures_tell_texts_apart():
    """Texts without a shingle in common agree in about 1/16 of the components, equal ones in all."""
    texts = [b" ".join(b"t%dw%d" % (i, j) for j in range(300)) for i in range(30)]
    s = near_dedup.signatures(texts)
    sig = near_dedup._nibbles(s)
    assert (near_dedup._agree(sig, sig) == near_dedup.M).all()
    share = np.mean([near_dedup._agree(sig[i + 1:], sig[i]).mean() for i in range(29)]) / near_dedup.M
    assert abs(share - 1 / 16) < 0.01
    # components that agree in full agree in their four bits
    a, b = near_dedup.signatures([texts[0] + b" " + texts[1][:200], texts[0]])
    pair = near_dedup._nibbles(np.array([a, b]))
    assert (a == b).sum() <= near_dedup._agree(pair[:1], pair[1:])[0] < near_dedup.M


def _classes(docs):
    sh = {i: Counter(near_dedup.shingles(t.encode())) for i, t in docs}
    inv, parent = defaultdict(list), {i: i for i in sh}
    for i, c in sh.items():
        for k in c:
            inv[k].append(i)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    pairs = {(a, b) for v in inv.values() for n, a in enumerate(v) for b in v[n + 1:]}
    for a, b in pairs:
        least, most = near_dedup.overlap(sh[a], sh[b])
        if 5 * least >= 4 * most:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in sh}


@pytest.mark.parametrize("side,together", [(2048, 20_000), (4, 10)])
def test_near_classes_against_all_pairs(spark, side, together):
    rng = random.Random(side)
    words = [f"v{i}" for i in range(500)]
    docs, base = [], [rng.choice(words) for _ in range(120)]
    for i in range(80):  # one group with every degree of likeness
        t = list(base)
        for _ in range(rng.randint(0, 12)):
            t[rng.randrange(len(t))] = rng.choice(words)
        docs.append((i, " ".join(t)))
    for i in range(80, 120):
        docs.append((i, " ".join(rng.choice(words) for _ in range(rng.randint(1, 60)))))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in near_dedup.near_groups(df, side=side, together=together).collect()}
    assert got == _classes(docs)


def test_earlier_bands_are_told_by_their_whole_keys(spark):
    """Keys of another band that are equal in half their bits do not hide a pair."""
    run = object.__new__(near_dedup.Linker)
    run.least = 0
    nodes = [(bytes([i] * 16), bytes(256), [(7 << 32) + i, 99]) for i in range(3)]
    run.nodes = spark.createDataFrame(nodes, "node binary, sig binary, bands array<long>")
    run.members = spark.createDataFrame([(n, 1, 99, 3) for n, _, _ in nodes], "node binary, nth int, band long, n long")
    root = spark.createDataFrame([], "node binary, root binary")
    got = set()
    for r in run.tiles(root, 2048, 20_000).collect():
        at = np.frombuffer(r.pairs, "<i2").reshape(-1, 2).tolist()
        got |= {frozenset((bytes(r.nodes[a]), bytes(r.nodes[b]))) for a, b in at}
    assert len(got) == 3


def test_versions_just_below_the_similarity_make_no_rows_of_pairs(spark):
    """n texts that are all near 0.78 of each other: a node has a row for each tile it is
    in, not for each pair, and classes equal all pairs."""
    words = [f"v{i}" for i in range(3000)]
    rows = {}
    for n in (50, 100, 200, 400):
        rng = random.Random(n)
        base = [rng.choice(words) for _ in range(400)]
        docs = []
        for i in range(n):
            t = list(base)
            for at in rng.sample(range(0, 400, 6), 5):
                t[at] = rng.choice(words)
            docs.append((i, " ".join(t)))
        df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
        run = near_dedup.Linker(df, near_dedup.M, near_dedup.BANDS, near_dedup.WIDTH, 5, near_dedup.AT_LEAST)
        tiles = run.tiles(spark.createDataFrame([], "node binary, root binary"), near_dedup.SIDE, near_dedup.TOGETHER).collect()
        rows[n] = sum(len(t.nodes) for t in tiles)
        if n <= 200:
            assert {r.doc_id: r.class_id for r in near_dedup.near_groups(df).collect()} == _classes(docs)
    assert sum(len(t.pairs) // 4 for t in tiles) > 20_000  # there is work in them
    assert all(rows[n] <= n * (-(-n // near_dedup.TILE) + 1) for n in rows)


def test_near_classes_of_whole_table(spark):
    docs = [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = {r.doc_id: r.class_id for r in Q.op6_near_dedup(spark, SF_SMALL).collect()}
    assert got == _classes(docs)


def test_quality_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality")
    got = Q.op7_quality(spark, sf)
    rows = got.join(labels, "doc_id").filter("held_out").collect()
    good = [r for r in rows if r.predicted == r.quality]
    assert len(rows) > 100 and len(good) / len(rows) > 0.93
    ones = [r for r in rows if r.quality == 1]
    assert sum(r.predicted for r in ones) / len(ones) > 0.97
    # calibrated: among the scores of a fifth, the mean is near the share of label 1
    rows.sort(key=lambda r: r.score)
    parts = [rows[i * len(rows) // 5:(i + 1) * len(rows) // 5] for i in range(5)]
    gaps = [abs(sum(r.score - r.quality for r in p)) / len(p) for p in parts]
    assert sum(gaps) / 5 < 0.06


def test_held_out_labels_are_not_learnt(spark):
    from tidemark.llm import quality
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    flipped = labels.withColumn("quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (sorted(map(tuple, quality.quality_scores(docs, x).collect())) for x in (labels, flipped))
    assert a == b


def test_every_word_has_its_own_vector(spark):
    """More words than any shared table had rows; rare ones joined as the hot ones are looked up."""
    from tidemark.llm import quality
    rng, n = random.Random(9), 40_000
    texts = [" ".join(f"w{i}" for i in range(a, a + 400)) for a in range(0, n, 400)]
    texts += [" ".join(f"w{int(n * rng.random() ** 4)}" for _ in range(300)) for _ in range(50)] + ["", "alone"]
    docs = spark.createDataFrame([(i, 0, t) for i, t in enumerate(texts)], "doc_id long, tag long, text string").repartition(5)
    sums = defaultdict(lambda: np.zeros(quality.DIM, np.int64))
    hashes = {}
    for t in texts:
        h = quality.word_rows([t.encode()])[0]
        draws = mix(h ^ np.uint64(0xD1B54A32D192ED03))
        hashes.update(zip(t.split(), h.view(np.int64).tolist()))
        for i in range(len(h)):
            for j in range(max(0, i - 2), min(len(h), i + 3)):
                for nth in range(2 if i != j else 0):
                    bits = int(draws[j]) >> (16 * nth)
                    sums[hashes[t.split()[i]]][bits % quality.DIM] += (bits >> 12 & 1) * 2 - 1
    vectors = quality.word_vectors(docs)
    got = {r.word: r.sums for r in vectors.collect()}
    assert len(got) == len(hashes) == n + 1
    for w, h in hashes.items():
        v = got[h]
        assert np.array_equal(np.frombuffer(v, f"<i{len(v) // quality.DIM}"), sums[h])
    x = [sorted((r.doc_id, r.x) for r in quality.pooled(docs, vectors, hot).collect()) for hot in (1, 1000, 1 << 20)]
    assert x[0] == x[1] == x[2] and len(x[0]) == len(texts)
    for i, t in enumerate(texts[:-2]):
        e = np.array([sums[hashes[w]] for w in t.split()], float)
        e /= np.maximum(np.linalg.norm(e, axis=1, keepdims=True), 1e-12)
        assert np.allclose(x[0][i][1], [*e.mean(0), *e.std(0)], atol=1e-4)


def _distance(a, b):
    p = list(range(len(b) + 1))
    for i, x in enumerate(a):
        q = [i + 1]
        for j, y in enumerate(b):
            q.append(min(p[j + 1] + 1, q[j] + 1, p[j] + (x != y)))
        p = q
    return p[-1]


def test_bit_parallel_distance(spark):
    rng, pairs = random.Random(3), []
    for _ in range(800):
        a = "".join(rng.choice("ab\U0001F600é") for _ in range(rng.randint(0, 14)))
        b = list(a)
        for _ in range(rng.randint(0, 4)):
            at = rng.randint(0, len(b))
            b[at:at + rng.randint(0, 1)] = rng.choice(["", "a", "c"])
        pairs.append((a, "".join(b)))
    df = spark.createDataFrame(pairs, "a string, b string")
    for edits in (1, 2, 3):
        d = line_dedup.edit_distance(line_dedup._characters("a"), line_dedup._characters("b"), edits)
        for r in df.select("a", "b", d.alias("d")).collect():
            assert min(r.d, edits + 1) == min(_distance(r.a, r.b), edits + 1)


@pytest.mark.parametrize("allowed,hot", [(line_dedup.ALLOWED, 3), (line_dedup.ALLOWED, 1000), (((4, 1),), 1000)])
def test_lines_against_all_pairs(spark, allowed, hot):
    rng, docs = random.Random(3), []
    words = ["alpha", "beta", "gamma", "delta", "omega", "kappa"]
    for i in range(40):
        lines = []
        for _ in range(rng.randint(0, 8)):
            x = rng.random()
            if x < 0.3:
                lines.append("template line number %05d of the set" % rng.randint(0, 400))
            elif x < 0.5:
                lines.append(rng.choice(["", f"short{rng.randint(0, 3)}", "sort1", "With and.", "With, and.", "abc", "abd", "abcde",
                                         "abcdef", "abxdefg", "é雪\U0001F600abc", "é雪\U0001F600abd", "ab", "a"]))
            else:
                t = " ".join(rng.choice(words) for _ in range(4))
                at = rng.randrange(len(t))
                lines.append(t[:at] + rng.choice(["x", ""]) + t[at + rng.randint(0, 1):])
        docs.append((i, "\n".join(lines)))
    first = {}
    for d, t in docs:
        for p, line in enumerate(t.split("\n")):
            if line.strip():
                first.setdefault(line, (d, p))
    most = lambda a, b: max((e for n, e in allowed if max(len(a), len(b)) >= n), default=0)
    near = {a for a in first if any(first[b] < first[a] and abs(len(a) - len(b)) <= most(a, b) and _distance(a, b) <= most(a, b)
                                    for b in first if a != b)}
    assert any(len(a) < 8 for a in near)
    got = {r.doc_id: (r.n_lines, r.n_removed, r.kept) for r in line_dedup.dedup_lines(
        spark.createDataFrame(docs, "doc_id long, text string"), allowed=allowed, hot=hot).collect()}
    for d, t in docs:
        lines = t.split("\n")
        kept = [x for p, x in enumerate(lines) if not x.strip() or (first[x] == (d, p) and x not in near)]
        n = sum(1 for x in lines if x.strip())
        assert got[d] == (n, n - sum(1 for x in kept if x.strip()), "\n".join(kept))


def test_rows_without_doc_id_spread_over_chunks(spark):
    """A third of the texts without a doc_id is no chunk of its own; results as with one chunk."""
    from tidemark.llm import substring_dedup, windows
    from tidemark.llm.common import keyed
    rng = random.Random(4)
    some = " ".join(f"s{i}" for i in range(20))
    docs = [(None if i % 3 == 0 else i, f"{some if i % 7 == 0 else ''} " + " ".join(f"w{rng.randrange(900)}" for _ in range(40)))
            for i in range(300)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    per = [r["count"] for r in keyed(df).groupBy(windows.chunk_of(10)).count().collect()]
    assert len(per) == 10 and max(per) < 60
    a, b = (substring_dedup.dedup_substrings(df, chunk_bytes=c) for c in (1 << 30, 1 << 12))
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_frequent_minimisers_go_last(spark):
    """Forcing the avoidance of frequent minimisers changes no result."""
    from tidemark.llm import substring_dedup, windows
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    a = substring_dedup.dedup_substrings(docs)
    b = substring_dedup.dedup_substrings(docs, bucket_bytes=1 << 14, chunk_bytes=1 << 16)
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    gram = np.arange(10, dtype=np.uint64) << np.uint64(50)
    hot = np.sort((gram >> np.uint64(1))[[0, 3]])
    assert [int(x >> np.uint64(63)) for x in windows._avoid(gram.copy(), hot)] == [1, 0, 0, 1] + [0] * 6
