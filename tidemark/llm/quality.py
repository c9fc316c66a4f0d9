"""Quality classifier on random-indexing word vectors.

Words here are runs of letters and digits (every byte from 128 on counts as a
letter) and single other characters. Every word has a sparse random index
vector: ``NONZERO`` components of +1 or -1, drawn from its hash. Its word
vector is the sum of the index vectors of the words at most ``REACH`` places
away, over *all* documents, scaled to unit length. Every word (64-bit hash) has a
vector of its own: tasks add up the words they meet, and tables are summed by
buckets of words, whose number grows with the corpus.

Documents look up the ``HOT`` most frequent words in a broadcast table. Their
counts of all other words are joined with the vectors by word, and the joined
rows go to their document. Vectors are whole multiples of 1 / ``UNIT`` there, so sums
are exact in any order.

A document is the mean and the standard deviation of its words' vectors. A
two-layer network (tanh, logistic output) is fitted in numpy on the driver to
a bounded sample of labelled documents, at most ``TRAIN_ROWS`` of highest hash, and
its probabilities are calibrated by a temperature fitted to a fifth of them
that the network did not see.

Null texts count as empty. Empty texts have the zero vector and are scored
like any other. Labels that are null are left out, and repeated labels of a
document are averaged (0.5 and up: 1). Without labels of both kinds every
score is the share of label 1 (0.5 without any). Rows with a null doc_id are
scored, with held_out false. The score reads nothing but the text: rows with equal texts tie, other columns are not
read (keep_good carries them along). A text of any length is read whole, in blocks of whole words. An empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from .common import cut, keep_rows, keyed, real_id, stored
from .windows import mix, word_hashes

DIM, NONZERO, REACH = 16, 2, 2
#: Words looked up in a broadcast table; the others are joined.
HOT = 1 << 18
UNIT = 1 << 20
#: Labelled documents the network is fitted to, at most.
TRAIN_ROWS = 20_000
#: Rows, and bytes of text, handled at once.
ROWS = 512
BLOCK = 1 << 18
#: Words of a task's table, and the most words of text it counts: both bound memory
#: only, full tables go out and new ones begin.
TABLE, COUNTED = 1 << 17, 1 << 27
#: Bytes of text for each bucket of words, and the fewest buckets.
BUCKET_BYTES, BUCKETS = 1 << 23, 8

# Bytes by kind: 0 white space, 1 letters and digits, 2 others.
_KIND = np.full(256, 2, np.uint8)
_KIND[[32, 9, 10, 11, 12, 13]] = 0
_KIND[128:] = 1
for _a, _z in (b"09", b"AZ", b"az"):
    _KIND[_a:_z + 1] = 1


def word_rows(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, and each word's text."""
    buf = b"\n".join(texts) + b"\n"
    arr = np.frombuffer(buf, np.uint8)
    kind = _KIND[arr]
    before = np.concatenate([[0], kind[:-1]])
    begin = np.flatnonzero((kind == 2) | ((kind == 1) & (before != 1)))
    after = np.concatenate([kind[1:], [0]])
    end = np.flatnonzero((kind == 2) | ((kind == 1) & (after != 1))) + 1
    ends = np.cumsum([len(t) + 1 for t in texts])
    return word_hashes(arr, begin, end), np.searchsorted(ends, begin, "right")


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of a few rows: a worker copies the texts of one at a time."""
    for b in batches:
        for at in range(0, b.num_rows, ROWS):
            yield b.slice(at, ROWS)


def _parts(texts: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    """First text and texts of each block; a longer text is a block alone."""
    at, size = 0, 0
    for i, t in enumerate(texts):
        if i > at and size + len(t) > BLOCK:
            yield at, texts[at:i]
            at, size = i, 0
        size += len(t)
    if texts:
        yield at, texts[at:]


def _pieces(text: bytes) -> list[bytes]:
    """A very long text in parts of whole words (a word over BLOCK is cut)."""
    out, at = [], 0
    while len(text) - at > BLOCK:
        z = max(text.rfind(b" ", at, at + BLOCK), text.rfind(b"\n", at, at + BLOCK))
        z = z if z > at else at + BLOCK
        out.append(text[at:z])
        at = z
    return [*out, text[at:]]


def _packed(v: np.ndarray) -> pa.Array:
    """Rows of whole numbers, each in the narrowest type that holds it."""
    most = np.abs(v).max(axis=1, initial=0)
    size = 1 << np.searchsorted([1 << 7, 1 << 15, 1 << 31], most, "right")
    ends = np.concatenate([[0], np.cumsum(size * v.shape[1])])
    data = np.empty(ends[-1], np.uint8)
    for s in (1, 2, 4, 8):
        rows = np.flatnonzero(size == s)
        data[ends[rows][:, None] + np.arange(s * v.shape[1])] = v[rows].astype(f"<i{s}").view(np.uint8)
    return pa.array([], pa.binary()) if not len(v) else pa.BinaryArray.from_buffers(
        pa.binary(), len(v), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data)])


def _unpacked(a: pa.Array, width: int) -> np.ndarray:
    """The rows that :func:`_packed` packed; zeros where null."""
    v = np.zeros((len(a), width), np.int64)
    if a.null_count == len(a):
        return v
    a = a.cast(pa.binary())
    ends = np.frombuffer(a.buffers()[1], np.int32)[a.offset:a.offset + len(a) + 1].astype(np.int64)
    data = np.frombuffer(a.buffers()[2], np.uint8)
    size = np.diff(ends) // width
    for s in (1, 2, 4, 8):
        rows = np.flatnonzero(size == s)
        v[rows] = data[ends[rows][:, None] + np.arange(s * width)].view(f"<i{s}")
    return v


def _cuts(*keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys begin."""
    new = np.ones(len(keys[0]), bool)
    new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return np.flatnonzero(new)


Sums = tuple[np.ndarray, np.ndarray, np.ndarray]


def _added(parts: list[Sums]) -> Sums:
    """Words, counts and sums, one row for each word, in their order."""
    word, n, sums = (np.concatenate(p) for p in zip(*parts))
    order = np.argsort(word, kind="stable")
    word = word[order]
    cuts = _cuts(word)
    return (word[cuts], np.add.reduceat(n[order], cuts),
            np.add.reduceat(sums[order], cuts, axis=0, dtype=sums.dtype))


def _dealt(buckets: int, word: np.ndarray, n: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
    """A table in compressed parts, one for each bucket (words are in order)."""
    z, bucket = zstandard.ZstdCompressor(level=3), _bucket(word, buckets)
    order = np.argsort(bucket, kind="stable")
    cuts = _cuts(bucket[order])
    parts = []
    for rows in np.split(order, cuts[1:]):
        packed = _packed(sums[rows])
        head = np.diff(word[rows], prepend=0), n[rows].astype(np.int32), np.diff(
            np.frombuffer(packed.buffers()[1], np.int32)).astype(np.int16)
        parts.append(z.compress(len(rows).to_bytes(8, "little") + b"".join(c.tobytes() for c in head)
                                + packed.buffers()[2].to_pybytes()))
    return pa.RecordBatch.from_pydict({"bucket": pa.array(bucket[order][cuts]), "part": pa.array(parts, pa.binary())})


def _bucket(word: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(word.view(np.uint64).copy()) % np.uint64(buckets)).astype(np.int64)


def _opened(part: bytes) -> Sums:
    data = zstandard.ZstdDecompressor().decompress(part)
    k, at = int.from_bytes(data[:8], "little"), 8
    word = np.cumsum(np.frombuffer(data, np.int64, k, at))
    n = np.frombuffer(data, np.int32, k, at + 8 * k).astype(np.int64)
    ends = np.concatenate([[0], np.cumsum(np.frombuffer(data, np.int16, k, at + 12 * k), dtype=np.int32)]).astype(np.int32)
    packed = pa.BinaryArray.from_buffers(pa.binary(), k, [None, pa.py_buffer(ends), pa.py_buffer(data[at + 14 * k:])])
    return word, n, _unpacked(packed, DIM)


def _contexts(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, held, counted = [], 0, 0
        for b in _slices(batches):
            texts = [p for t in b.column("text").cast(pa.binary()).to_pylist() for p in _pieces(t)]
            for _, part in _parts(texts):
                h, owner = word_rows(part)
                if not len(h):
                    continue
                word, row, n = np.unique(h.view(np.int64), return_inverse=True, return_counts=True)
                row = row * DIM
                draws, flat, sign = mix(h ^ np.uint64(0xD1B54A32D192ED03)), [], []
                for step in range(1, REACH + 1):
                    near = owner[step:] == owner[:-step]
                    for nth in range(NONZERO):
                        bits = (draws >> np.uint64(16 * nth)).astype(np.int64)
                        place, plus = bits % DIM, ((bits >> 12) & 1) * 2 - 1
                        flat += [(row[:-step] + place[step:])[near], (row[step:] + place[:-step])[near]]
                        sign += [plus[step:][near], plus[:-step][near]]
                sums = np.bincount(np.concatenate(flat), np.concatenate(sign), len(word) * DIM)
                table.append((word, n, sums.astype(np.int32).reshape(-1, DIM)))
                held, counted = held + len(word), counted + len(h)
                if held > TABLE or counted > COUNTED:
                    table = [_added(table)]
                    held = len(table[0][0])
                    if held > TABLE // 2 or counted > COUNTED:
                        yield _dealt(buckets, *table[0])
                        table, held, counted = [], 0, 0
        if table:
            yield _dealt(buckets, *_added(table))
    return run


def _summed(t: pa.Table) -> pa.Table:
    table, more, held = [], [], 0
    for part in t.column("part"):
        more.append(_opened(part.as_py()))
        held += len(more[-1][0])
        if held > TABLE // 4:
            table, more, held = [_added(table + more)], [], 0
    word, n, sums = _added(table + more)
    return pa.table({"word": pa.array(word), "n": pa.array(n), "sums": _packed(sums)})


def word_vectors(docs: DataFrame) -> DataFrame:
    """word, n, sums of every word: its hash, its count, and its vector before scaling."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return stored(docs.select("text").mapInArrow(_contexts(max(BUCKETS, size // BUCKET_BYTES)), "bucket long, part binary")
                  .groupBy("bucket").applyInArrow(_summed, "word long, n long, sums binary"))


def _cells(rows: DataFrame, cell, most: int) -> list:
    """The cells (a column of whole numbers, a few thousand at most), greatest first, that
    together hold at most ``most`` rows: what a sort and a limit give, without
    a task that merges the rows."""
    counts = rows.groupBy(cell.alias("cell")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("cell")).collect()
    out, sum_ = [], 0
    for r in counts:
        sum_ += r["n"]
        if sum_ > most:
            break
        out.append(r["cell"])
    return out


def most_frequent(vectors: DataFrame, most: int) -> DataFrame:
    """The words of the highest counts, as many whole classes of counts as hold at most
    ``most`` words. A class is a count up to 64, then an eightieth of a power of ten."""
    cell = F.when(F.col("n") <= 64, F.col("n")).otherwise(F.floor(F.log10("n") * 80)).cast("int")
    cells = _cells(vectors, cell, most)
    return vectors.filter(cell >= (min(cells) if cells else 1 << 30))


def _units(sums: np.ndarray) -> np.ndarray:
    """Vectors of length one in whole units."""
    return np.rint(sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12) * UNIT)


def _moments(units: np.ndarray) -> np.ndarray:
    """Vectors and their squares, in whole units."""
    return np.hstack([units, np.floor(units * units / UNIT)])


def _counted(hot):
    """A row for each document (sums of its hot words, n of all words) and one
    for each of its other words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, units = hot.value
        for b in _slices(batches):
            ids, tags = b.column("doc_id").to_numpy(), b.column("tag").to_numpy()
            texts = b.column("text").cast(pa.binary()).to_pylist()
            pieces, of = [], []
            for i, t in enumerate(texts):
                for p in _pieces(t):
                    pieces.append(p)
                    of.append(i)
            n, sums = np.zeros(len(texts), np.int64), np.zeros((len(texts), 2 * DIM), np.int64)
            of_text = np.array(of)
            for at, part in _parts(pieces):
                h, owner = word_rows(part)
                if not len(h):
                    continue
                h = h.view(np.int64)
                cuts = _cuts(owner)
                rows = of_text[at + owner[cuts]]
                np.add.at(n, rows, np.diff(np.append(cuts, len(owner))))
                place = np.minimum(np.searchsorted(words, h), len(words) - 1)
                rare = words[place] != h
                place[rare] = len(words)
                for i, a, z in zip(rows.tolist(), cuts.tolist(), [*cuts[1:].tolist(), len(h)]):
                    sums[i] += _moments(units[place[a:z]].astype(np.float64)).sum(axis=0).astype(np.int64)
                own, word = of_text[at + owner[rare]], h[rare]
                order = np.lexsort((word, own))
                own, word = own[order], word[order]
                cuts = _cuts(own, word)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(ids[own[cuts]]), "tag": pa.array(tags[own[cuts]]), "word": pa.array(word[cuts]),
                    "n": pa.array(np.diff(np.append(cuts, len(own)))), "own": pa.nulls(len(cuts), pa.binary())})
            # any word will do in a document's row: a hash, so that they spread
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array(ids), "tag": pa.array(tags), "n": pa.array(n), "own": _packed(sums),
                "word": pa.array(mix(ids.astype(np.uint64) ^ tags.astype(np.uint64)).view(np.int64))}
                ).select(["doc_id", "tag", "word", "n", "own"])
    return run


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in the order of their documents, one for each document's row."""
    def out(ids, tags, rows, n, sums):
        share = sums / UNIT / np.maximum(n, 1)[:, None]
        mean, square = share[:, :DIM], share[:, DIM:]
        x = np.hstack([mean, np.sqrt(np.maximum(square - mean**2, 0))]).astype(np.float32)
        each = np.repeat(np.arange(len(rows)), rows)
        for at in range(0, len(each), 10_000):
            e = each[at:at + 10_000]
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array(ids[e]), "tag": pa.array(tags[e]),
                "x": pa.ListArray.from_arrays(np.arange(len(e) + 1, dtype=np.int32) * (2 * DIM), x[e].ravel())})

    last = None
    for b in batches:
        if not b.num_rows:
            continue
        n = b.column("n").to_numpy()
        whole = b.column("own").is_valid().to_numpy(zero_copy_only=False)
        sums = _unpacked(b.column("own"), 2 * DIM)
        rare = np.flatnonzero(~whole)
        units = _units(_unpacked(b.column("sums").take(pa.array(rare)), DIM))
        sums[rare] = _moments(units).astype(np.int64) * n[rare][:, None]
        every = (b.column("doc_id").to_numpy(), b.column("tag").to_numpy(), whole.astype(np.int64),
                 np.where(whole, n, 0), sums)
        if last:
            every = tuple(np.concatenate(c) for c in zip(last, every))
        cuts = _cuts(*every[:2])
        every = (every[0][cuts], every[1][cuts], *(np.add.reduceat(c, cuts, axis=0) for c in every[2:]))
        last = tuple(c[-1:] for c in every)
        yield from out(*(c[:-1] for c in every))
    if last:
        yield from out(*last)


def pooled(docs: DataFrame, vectors: DataFrame, hot: int = HOT) -> DataFrame:
    """doc_id, tag, x: the features of every document (doc_id, tag, text)."""
    top = most_frequent(vectors, hot).toArrow().combine_chunks()
    word = top.column("word").to_numpy()
    order = np.argsort(word)
    units = _units(np.vstack([_unpacked(c, DIM) for c in top.column("sums").chunks] or [np.zeros((0, DIM))]))
    units = np.vstack([units[order], np.zeros((1, DIM))]).astype(np.float32)  # the last: not hot
    w = docs.sparkSession.sparkContext.broadcast((word[order], units))
    rows = docs.mapInArrow(_counted(w), "doc_id long, tag long, word long, n long, own binary")
    # equal rows of a key sum up to the same means, and come out as often as they went in
    return (rows.join(vectors.select("word", "sums"), "word", "left").select("doc_id", "tag", "n", "own", "sums")
            .repartition("doc_id", "tag").sortWithinPartitions("doc_id", "tag")
            .mapInArrow(_features, "doc_id long, tag long, x array<float>"))


class Network:
    """x -> tanh layer -> logit; standardises its input; has a temperature."""

    def __init__(self, x: np.ndarray, y: np.ndarray, hidden: int = 64, epochs: int = 80, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.temperature, self.base = 1.0, 0.0
        share = y.mean() if len(y) else 0.5
        self.flat = len(y) == 0 or share in (0.0, 1.0)
        if self.flat:
            self.share = float(share)
            return
        self.mu, self.sd = x.mean(0), x.std(0) + 1e-6
        last = np.arange(len(y)) % 5 == 4 if len(y) >= 50 else np.zeros(len(y), bool)
        d = x.shape[1]
        p = [rng.normal(0, d**-0.5, (d, hidden)), np.zeros(hidden), rng.normal(0, hidden**-0.5, hidden), np.zeros(1)]
        m, v, t = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0
        fit_x, fit_y = self._scaled(x[~last]), y[~last]
        for epoch in range(epochs):
            order = rng.permutation(len(fit_y))
            for at in range(0, len(order), 256):
                i = order[at:at + 256]
                h = np.tanh(fit_x[i] @ p[0] + p[1])
                g = (1 / (1 + np.exp(-(h @ p[2] + p[3]))) - fit_y[i]) / len(i)
                gh = np.outer(g, p[2]) * (1 - h * h)
                grads = [fit_x[i].T @ gh + 1e-4 * p[0], gh.sum(0), h.T @ g + 1e-4 * p[2], g.sum(keepdims=True)]
                t += 1
                for k, gr in enumerate(grads):
                    m[k] = 0.9 * m[k] + 0.1 * gr
                    v[k] = 0.999 * v[k] + 0.001 * gr * gr
                    p[k] = p[k] - 3e-3 * (1 - epoch / epochs) * (m[k] / (1 - 0.9**t)) / (
                        np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)
        self.p = p
        if last.any():
            z, yy = self.logits(x[last]), y[last]
            grid = np.exp(np.linspace(-2, 3, 201))
            loss = [np.logaddexp(0, np.where(yy == 1, -z, z) / t).mean() for t in grid]
            self.temperature = float(grid[int(np.argmin(loss))])

    def _scaled(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mu) / self.sd, -8, 8)

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(self._scaled(x) @ self.p[0] + self.p[1]) @ self.p[2] + self.p[3]

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.flat:
            return np.full(len(x), self.share)
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -500, 500)))


def _scored(net: Network):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column("x").flatten().to_numpy().reshape(-1, 2 * DIM).astype(np.float64)
            yield pa.RecordBatch.from_pydict({"doc_id": b.column("doc_id"), "tag": b.column("tag"),
                                              "score": pa.array(net.scores(x))})
    return run


def held_out(doc_id: str = "doc_id"):
    """Documents whose labels are never learnt from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(x: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> Network:
    """The network for features ``x`` (doc_id, x) from labels (doc_id, quality)."""
    known = (labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
             .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.avg("quality") >= 0.5).cast("int").alias("y")))
    known = known.join(x.select("doc_id").distinct(), "doc_id", "left_semi")
    cell = F.shiftrightunsigned(F.xxhash64("doc_id"), 52).cast("int")
    cells = _cells(known, cell, train_rows)
    known = known.filter(cell >= (min(cells) if cells else 1 << 30))
    # of rows that repeat a doc_id, one; in a fixed order, so that reruns fit the same network
    rows = (x.join(known, "doc_id").groupBy("doc_id", "y").agg(F.min("x").alias("x")).toArrow())
    rows = rows.sort_by("doc_id").select(["x", "y"])
    y = rows.column("y").to_numpy().astype(np.float64)
    flat = rows.column("x").combine_chunks().flatten().to_numpy() if len(y) else np.zeros(0)
    return Network(flat.reshape(-1, 2 * DIM).astype(np.float64), y)


def _scores(docs: DataFrame, labels: DataFrame, train_rows: int) -> DataFrame:
    d = keyed(docs)
    x = cut(pooled(d, word_vectors(d)))
    return x.mapInArrow(_scored(fit(x, labels, train_rows)), "doc_id long, tag long, score double")


def quality_scores(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    s = _scores(docs, labels, train_rows).select(real_id().alias("doc_id"), "score")
    return s.select("doc_id", held_out().alias("held_out"), "score",
                    (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """The rows of ``docs``, all columns, that score 0.5 or more."""
    return keep_rows(docs, _scores(docs, labels, train_rows).filter("score >= 0.5"), once=False)
