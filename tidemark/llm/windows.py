"""Windows of k units (bytes or words) dealt out by minimiser.

The minimiser of a window is its m-gram of least hash. Consecutive windows
with the same minimiser travel as one packed string (a run, or super-k-mer) to
the bucket of that minimiser, so equal windows of all documents meet in one
bucket and each window costs a fraction of a string.

Steps, all over chunks of documents (some megabytes each, dealt once by doc_id and tag):

1. Each chunk sends its distinct minimisers, 32 bits each, to their buckets,
   where those met in one document only are told from the shared ones; a bit per
   minimiser goes back. Equal windows have equal minimisers, so only runs with a
   shared one can hold repeats.
2. Each chunk sends its shared runs as packed strings; a bucket finds the
   windows that also start in a smaller document.
3. Each chunk gets its findings back.

Hot groups. Equal strings of one chunk are settled on the spot: only those of
the smallest document travel, the others are known to repeat it. A first
pass counts the minimisers, and those too frequent for a bucket are ordered
after all others, so windows take them only where nothing else is left, inside
stretches that repeat as wholes. Chunks and buckets are many (their numbers follow
the input), so a task holds one at a time.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

#: Bytes of text handled at once by the array code, and of a chunk.
BLOCK, CHUNK = 1 << 19, 1 << 23
#: Bytes of packed strings a bucket should hold.
BUCKET = 1 << 23
#: Windows of a run at most.
RUN = 256
#: Minimisers that the tasks are told to avoid, at most.
HOT = 4096

U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, in place."""
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Least of each w consecutive values."""
    span = 1
    while span * 2 <= w:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return np.minimum(x[:len(x) - (w - span)], x[w - span:]) if w > span else x


@dataclass
class Units:
    """A block of documents as units: ``buf`` holds the bytes; unit i spans
    ``begin[i]`` to ``end[i]`` (None: units are single bytes); ``gram[i]`` is
    the hash of the m units from i on; document j has ``count[j]`` units from
    ``first[j]`` on, the first of them being its unit ``offset[j]``."""

    buf: bytes
    gram: np.ndarray | None
    begin: np.ndarray | None
    end: np.ndarray | None
    first: np.ndarray
    count: np.ndarray
    row: np.ndarray
    offset: np.ndarray


def byte_units(k: int, m: int) -> Callable[[list[bytes]], Iterator[Units]]:
    def units(texts: list[bytes]) -> Iterator[Units]:
        def block(parts: list[tuple[int, int, bytes]]) -> Units:
            buf = b"".join(p[2] for p in parts) + bytes(m + 8)
            n = len(buf) - m - 8
            gram = np.ndarray((n,), "<u8", buf, 0, (1,)) * U(0x9E3779B97F4A7C15)
            gram ^= gram >> U(32)
            gram += np.ndarray((n,), "<u8", buf, m - 8, (1,))
            size = np.array([len(p[2]) for p in parts], np.int64)
            return Units(buf, mix(gram), None, None, np.cumsum(size) - size, size,
                         np.array([p[0] for p in parts]), np.array([p[1] for p in parts]))

        held, size = [], 0
        for row, t in enumerate(texts):
            for at in range(0, max(1, len(t) - k + 1), BLOCK):
                part = t[at:at + BLOCK + k - 1]
                if held and size + len(part) > BLOCK + k:
                    yield block(held)
                    held, size = [], 0
                if len(part) >= k:
                    held.append((row, at, part))
                    size += len(part)
        if held:
            yield block(held)
    return units


_POW: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64."""
    n = 1 << (n - 1).bit_length()
    if n not in _POW:
        base = 0x5851F42D4C957F2D
        inv = pow(base, -1, 1 << 64)
        both = []
        for b in (base, inv):
            p = np.full(n, b, U)
            p[0] = 1
            both.append(np.multiply.accumulate(p))
        _POW.clear()
        _POW[n] = (both[0], both[1])
    return _POW[n]


def word_hashes(arr: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of the bytes begin[i] to end[i] of ``arr`` for each i."""
    up, down = _powers(len(arr))
    total = np.zeros(len(arr) + 1, U)
    np.cumsum((arr + U(1)) * up[:len(arr)], out=total[1:])
    return mix((total[end] - total[begin]) * down[begin])


def word_units(k: int, m: int) -> Callable[[list[bytes]], Iterator[Units]]:
    def units(texts: list[bytes]) -> Iterator[Units]:
        def block(parts: list[tuple[int, int, bytes]]) -> Units:
            buf = b"\n".join(p[2] for p in parts) + b"\n"
            arr = np.frombuffer(buf, np.uint8)
            end = np.flatnonzero((arr == 32) | (arr == 10))
            begin = np.concatenate([[0], end[:-1] + 1])
            word = word_hashes(arr, begin, end)
            gram = np.zeros(len(word), U)
            for j in range(m):
                part = word[j:] * U(2 * 0x9E3779B97F4A7C15 * (j + 1) % 2**64 + 1)
                gram[:len(part)] += part ^ (part >> U(29))
            last = np.flatnonzero(arr[end] == 10)
            first = np.concatenate([[0], last[:-1] + 1])
            return Units(buf, mix(gram), begin, end, first, last - first + 1,
                         np.array([p[0] for p in parts]), np.array([p[1] for p in parts]))

        held, size = [], 0
        for row, t in enumerate(texts):
            for at, part in _word_parts(t, k):
                if held and size + len(part) > BLOCK:
                    yield block(held)
                    held, size = [], 0
                held.append((row, at, part))
                size += len(part)
        if held:
            yield block(held)
    return units


def _word_parts(text: bytes, k: int) -> Iterator[tuple[int, bytes]]:
    """The words of a text joined by blanks, very long texts in parts that
    overlap by k - 1 words; texts under k words have no part."""
    t = b" ".join(text.split())
    if len(t) <= 2 * BLOCK:
        if t.count(b" ") >= k - 1:
            yield 0, t
        return
    ends = np.append(np.flatnonzero(np.frombuffer(t, np.uint8) == 32), len(t))
    step = max(k, BLOCK // 8)
    for at in range(0, max(1, len(ends) - k + 1), step):
        upto = min(len(ends), at + step + k - 1)
        yield at, t[0 if at == 0 else ends[at - 1] + 1:ends[upto - 1]]


@dataclass
class Dealing:
    """How windows are made: ``units`` of a list of texts, k and m."""

    units: Callable[[list[bytes]], Iterator[Units]]
    k: int
    m: int


def _avoid(gram: np.ndarray, hot: np.ndarray) -> np.ndarray:
    """Hashes in ``hot`` (sorted, without their lowest bit) go last."""
    gram >>= U(1)
    if len(hot):
        seen = np.zeros(1 << 16, bool)
        seen[(hot >> U(47)).astype(np.int64)] = True
        maybe = np.flatnonzero(seen[(gram >> U(47)).astype(np.int64)])
        at = np.minimum(np.searchsorted(hot, gram[maybe]), len(hot) - 1)
        gram[maybe[hot[at] == gram[maybe]]] |= U(1 << 63)
    return gram


def find_runs(u: Units, k: int, m: int, hot: np.ndarray) -> tuple[np.ndarray, ...]:
    """First window, number of windows, minimiser and its place in the first
    window, of every run of the block."""
    gram, w = _avoid(u.gram, hot), k - m + 1
    if len(gram) < k:
        none = np.zeros(0, np.int64)
        return none, none, none.astype(U), none
    least = sliding_min(gram, w)
    edge = np.zeros(len(gram) + 1, np.int32)
    fits = u.count >= k
    np.add.at(edge, u.first[fits], 1)
    np.add.at(edge, (u.first + u.count - k + 1)[fits], -1)
    inside = np.cumsum(edge)[:len(least)] > 0
    same = inside[1:] & inside[:-1] & (least[1:] == least[:-1])
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~same
    ends[:-1] &= ~same
    s, e = np.flatnonzero(begins), np.flatnonzero(ends)
    parts = (e - s) // RUN + 1
    if parts.max(initial=1) > 1:
        nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        s, e = np.repeat(s, parts) + nth * RUN, np.repeat(e, parts)
    n = np.minimum(e - s + 1, RUN)
    value = least[s]
    place = np.argmax(gram[s[:, None] + np.arange(w)] == value[:, None], axis=1)
    return s, n, value, place


def count_minimisers(deal: Dealing):
    """The frequent minimisers of each batch, with their numbers of runs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column("text").cast(pa.binary()).to_pylist()
            seen = [find_runs(u, deal.k, deal.m, np.zeros(0, U))[2] for u in deal.units(texts)]
            v, n = np.unique(np.concatenate(seen) if seen else np.zeros(0, U), return_counts=True)
            much = n >= max(16, n.sum() // 2000)
            yield pa.RecordBatch.from_pydict({"value": pa.array(v[much].view(np.int64)),
                                              "n": pa.array(n[much].astype(np.int64))})
    return run


def _small(x: np.ndarray) -> bytes:
    """Whole numbers from 0 on in as few bytes each as the greatest needs."""
    kind = next(t for t in ("u1", "u2", "u4", "u8") if not len(x) or int(x.max()) <= np.iinfo(t).max)
    return kind.encode() + x.astype(kind).tobytes()


def _wide(data: bytes) -> np.ndarray:
    return np.frombuffer(data, data[:2].decode(), -1, 2).astype(np.int64)


def pack(strings: list[bytes], columns: list[np.ndarray], settled: list[np.ndarray]) -> bytes:
    """A blob: the strings, their sizes and columns, then columns of settled
    windows, each compressed on its own."""
    text, plain = zstandard.ZstdCompressor(level=3), zstandard.ZstdCompressor(level=1)
    parts = [text.compress(b"".join(strings)), plain.compress(_small(np.array([len(s) for s in strings], np.int64)))]
    for c in [*columns, *settled]:
        c = np.asarray(c, np.int64)
        low = int(c.min()) if len(c) else 0
        parts.append(plain.compress(struct.pack("<q", low) + _small((c - low).view(U) if len(c) else c)))
    return b"".join(struct.pack("<q", len(p)) + p for p in parts)


def unpack(blob: bytes) -> tuple[list[bytes], list[np.ndarray], list[np.ndarray]]:
    z, at, parts = zstandard.ZstdDecompressor(), 0, []
    while at < len(blob):
        (n,) = struct.unpack_from("<q", blob, at)
        parts.append(z.decompress(blob[at + 8:at + 8 + n]))
        at += 8 + n
    ends = np.cumsum(_wide(parts[1]))
    begins = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    strings = [parts[0][a:b] for a, b in zip(begins.tolist(), ends.tolist())]
    rest = [_wide(p[8:]) + struct.unpack_from("<q", p)[0] for p in parts[2:]]
    return strings, rest[:len(COLUMNS)], rest[len(COLUMNS):]


#: Of a string: document, its tag, first window, windows, and the bytes where
#: its minimiser begins and ends.
COLUMNS = ("doc_id", "tag", "start", "n", "from", "to")


def _texts(t: pa.Table) -> list[bytes]:
    return t.column("text").cast(pa.binary()).to_pylist()


def _dealt(value: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket and 32 further bits of each minimiser, as one sortable number."""
    h = mix(value.copy())
    return (h % U(buckets)) << U(32) | h >> U(32)


def survey(deal: Dealing, hot: np.ndarray, buckets: int):
    """Rows (bucket, chunk, few): a chunk's distinct minimisers of a bucket, in
    order, and whether each is in several of its documents."""
    def run(t: pa.Table) -> pa.Table:
        keys, rows = [], []
        for u in deal.units(_texts(t)):
            s, _, value, _ = find_runs(u, deal.k, deal.m, hot)
            keys.append(_dealt(value, buckets))
            rows.append(u.row[np.searchsorted(u.first, s, "right") - 1])
        key = np.concatenate(keys) if keys else np.zeros(0, U)
        row = np.concatenate(rows) if rows else np.zeros(0, np.int64)
        out_b, out_v = [], []
        if len(key):
            order = np.argsort(key, kind="stable")
            key, row = key[order], row[order]
            cuts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            several = np.minimum.reduceat(row, cuts) != np.maximum.reduceat(row, cuts)
            key = key[cuts]
            bucket, low = (key >> U(32)).astype(np.int64), key.astype(np.uint32)
            at = np.flatnonzero(np.diff(bucket, prepend=-1))
            for a, z in zip(at.tolist(), [*at[1:].tolist(), len(key)]):
                out_b.append(int(bucket[a]))
                out_v.append(low[a:z].tobytes() + np.packbits(several[a:z]).tobytes())
        return pa.table({"bucket": pa.array(out_b, pa.int64()),
                         "chunk": pa.array([t.column("chunk")[0].as_py()] * len(out_b), pa.int64()),
                         "few": pa.array(out_v, pa.binary())})
    return run


def shared(t: pa.Table) -> pa.Table:
    """One bucket: rows (chunk, bucket, bits), a bit for each minimiser of the
    chunk in order: whether it is in several documents of all."""
    lows, bits = [], []
    for x in t.column("few").to_pylist():
        n = len(x) * 8 // 33
        lows.append(np.frombuffer(x, np.uint32, n))
        bits.append(np.unpackbits(np.frombuffer(x, np.uint8, -1, 4 * n), count=n).astype(bool))
    low, several = np.concatenate(lows), np.concatenate(bits)
    _, where, count = np.unique(low, return_inverse=True, return_counts=True)
    several |= count[where] > 1
    ends = np.cumsum([len(x) for x in lows])
    return pa.table({"chunk": t.column("chunk"), "bucket": t.column("bucket"),
                     "bits": pa.array([np.packbits(x).tobytes() for x in np.split(several, ends[:-1])], pa.binary())})


def deal_out(deal: Dealing, hot: np.ndarray, buckets: int):
    """Rows (bucket, blob) of the shared runs of a chunk."""
    def run(t: pa.Table, told: pa.Table) -> pa.Table:
        found, keys = [], []
        ids, tags = (t.column(c).to_numpy() for c in ("doc_id", "tag")) if t.num_rows else (None, None)
        for u in deal.units(_texts(t)) if t.num_rows else ():
            runs = find_runs(u, deal.k, deal.m, hot)
            u.gram = None  # the largest part, no longer needed
            found.append((u, runs))
            keys.append(_dealt(runs[2], buckets))
        key = np.concatenate(keys) if keys else np.zeros(0, U)
        distinct, where = np.unique(key, return_inverse=True)
        told = dict(zip(told.column("bucket").to_pylist(), told.column("bits").to_pylist()))
        n = np.bincount((distinct >> U(32)).astype(np.int64)) if len(distinct) else []
        live = np.concatenate([np.unpackbits(np.frombuffer(told[b], np.uint8), count=n[b]).astype(bool)
                               for b in sorted(told)] or [np.zeros(0, bool)])[where]
        strings, cols, at = [], [[] for _ in COLUMNS], 0
        for u, (s, n, _, place) in found:
            on = live[at:at + len(s)]
            at += len(s)
            s, n, place = s[on], n[on], place[on]
            j = np.searchsorted(u.first, s, "right") - 1
            last, gram = s + n + deal.k - 2, s + place
            if u.begin is None:
                a, z, g, h = s, last + 1, gram, gram + deal.m
            else:
                a, z, g, h = u.begin[s], u.end[last], u.begin[gram], u.end[gram + deal.m - 1]
            strings += [u.buf[x:y] for x, y in zip(a.tolist(), z.tolist())]
            for c, x in zip(cols, (ids[u.row[j]], tags[u.row[j]], s - u.first[j] + u.offset[j], n, g - a, h - a)):
                c.append(x)
        out_b, out_v = [], []
        if strings:
            cols = [np.concatenate(c) for c in cols]
            bucket = (key[live] >> U(32)).astype(np.int64)
            doc = cols[0].tolist()
            first: dict[bytes, int] = {}
            for s, d in zip(strings, doc):
                if first.setdefault(s, d) > d:
                    first[s] = d
            stays = np.fromiter((first[s] == d for s, d in zip(strings, doc)), bool, len(doc))
            settled = [c[~stays] for c in cols[:4]]
            which = np.flatnonzero(stays)
            which = which[np.argsort(bucket[which], kind="stable")]
            cuts = np.flatnonzero(np.diff(bucket[which], prepend=-1))
            for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(which)]):
                some = which[a:b]
                out_b.append(int(bucket[some[0]]))
                # what is settled here travels with the first blob, to be passed on
                out_v.append(pack([strings[i] for i in some.tolist()], [c[some] for c in cols],
                                  settled if not out_v else [c[:0] for c in settled]))
        return pa.table({"bucket": pa.array(out_b, pa.int64()), "blob": pa.array(out_v, pa.binary())})
    return run


#: From the strings of groups with one minimiser each (string, group, document) to
#: the pairs (string, window) whose text is also in a string of a smaller document.
Repeats = Callable[[list[bytes], np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def settle(repeats: Repeats):
    """Reduce side, one bucket: rows (doc_id, tag, start, n) of windows that
    also start in a smaller document."""
    def run(table: pa.Table) -> pa.Table:
        strings, parts, out = [], [], [[], [], [], []]
        for blob in table.column("blob").to_pylist():
            s, c, settled = unpack(blob)
            strings += s
            parts.append(c)
            for o, x in zip(out, settled):
                o.append(x)
        if strings:
            cols = [np.concatenate(c) for c in zip(*parts)]
            doc = cols[0].tolist()
            first: dict[bytes, int] = {}
            for s, d in zip(strings, doc):
                if first.setdefault(s, d) > d:
                    first[s] = d
            stays = np.fromiter((first[s] == d for s, d in zip(strings, doc)), bool, len(doc))
            for o, x in zip(out, cols[:4]):
                o.append(x[~stays])
            # one string of each text, in groups by minimiser; a minimiser of
            # one string, or of one document, repeats nothing
            number = {s: i for i, s in enumerate(first)}
            groups: dict[bytes, list[int]] = {}
            name = [-1] * len(number)
            for i, (s, f, t) in enumerate(zip(strings, cols[4].tolist(), cols[5].tolist())):
                k = number[s]
                if name[k] < 0:
                    name[k] = i
                    groups.setdefault(s[f:t], []).append(k)
            texts, docs = list(first), list(first.values())
            picked, group = [], []
            for g, members in enumerate(groups.values()):
                if len(members) > 1 and len({docs[k] for k in members}) > 1:
                    picked += members
                    group += [g] * len(members)
            if picked:
                which, window = repeats([texts[k] for k in picked], np.array(group),
                                        np.array([docs[k] for k in picked], np.int64))
                flagged: dict[int, np.ndarray] = {}
                by = np.lexsort((window, which))
                which, window = which[by], window[by]
                cuts = np.flatnonzero(np.diff(which, prepend=-1)).tolist()
                for a, b in zip(cuts, [*cuts[1:], len(which)]):
                    flagged[picked[which[a]]] = window[a:b]
                extra: list[tuple[int, int, int, int]] = []
                for i in np.flatnonzero(stays).tolist():
                    w = flagged.get(number[strings[i]])
                    if w is not None:
                        at = np.flatnonzero(np.diff(w, prepend=-2) != 1)
                        for a, b in zip(at.tolist(), [*at[1:].tolist(), len(w)]):
                            extra.append((doc[i], int(cols[1][i]), int(cols[2][i] + w[a]), b - a))
                if extra:
                    for o, x in zip(out, np.array(extra, np.int64).T):
                        o.append(x)
        return pa.table({c: pa.array(np.concatenate(o) if o else np.zeros(0, np.int64))
                         for c, o in zip(("doc_id", "tag", "start", "n"), out)})
    return run


def chunk_of(chunks: int):
    """The chunk of a row, by doc_id and tag: texts that share a doc_id, or have none, spread."""
    return F.pmod(F.xxhash64("doc_id", "tag"), F.lit(chunks)).alias("chunk")


def without_repeats(docs: DataFrame, deal: Dealing, repeats: Repeats, keep: Callable[[bytes, np.ndarray], tuple],
                    columns: str, bucket_bytes: int = BUCKET, chunk_bytes: int = CHUNK) -> DataFrame:
    """doc_id and ``columns`` (of ``keep``) of every row of ``docs`` (doc_id,
    tag, text). ``keep`` takes a text and the covered ranges of units, an array
    of (start, end) rows, that start in a smaller doc_id too."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets, chunks = max(1, int(size * 4 // bucket_bytes)), max(1, int(size // chunk_bytes))
    counts = (docs.select("text").mapInArrow(count_minimisers(deal), "value long, n long")
              .groupBy("value").agg(F.sum("n").alias("n"))
              .filter(F.col("n") >= bucket_bytes // 1024))
    hot = [r["value"] for r in counts.orderBy(F.desc("n"), "value").limit(HOT).collect()]
    hot = np.unique(np.array(hot, np.int64).view(U))
    by_chunk = chunk_of(chunks)
    # the same exchange of the texts serves all three uses
    own = docs.select(by_chunk, "doc_id", "tag", "text").repartition("chunk")
    bits = (own.groupBy("chunk").applyInArrow(survey(deal, hot, buckets), "bucket long, chunk long, few binary")
            .groupBy("bucket").applyInArrow(shared, "chunk long, bucket long, bits binary"))
    found = (own.groupBy("chunk").cogroup(bits.groupBy("chunk"))
             .applyInArrow(deal_out(deal, hot, buckets), "bucket long, blob binary")
             .groupBy("bucket").applyInArrow(settle(repeats), "doc_id long, tag long, start long, n long"))
    found = found.select(by_chunk, "doc_id", "tag", "start", "n")
    return own.groupBy("chunk").cogroup(found.groupBy("chunk")).applyInArrow(
        _kept(keep, deal.k, [c.split()[0] for c in columns.split(", ")], columns), f"doc_id long, {columns}")


def _kept(keep, k: int, names: list[str], columns: str):
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    types = [kinds[c.split()[1]] for c in columns.split(", ")]

    def run(t: pa.Table, found: pa.Table) -> pa.Table:
        out = [[] for _ in names]
        if t.num_rows:
            key = list(zip(t.column("doc_id").to_pylist(), t.column("tag").to_pylist()))
            spans: dict[tuple[int, int], np.ndarray] = {}
            if found.num_rows:
                d, g, a, n = (found.column(c).to_numpy() for c in ("doc_id", "tag", "start", "n"))
                order = np.lexsort((a, g, d))
                d, g = d[order], g[order]
                both = np.column_stack([a[order], a[order] + n[order] + k - 1])
                cuts = np.flatnonzero(np.concatenate([[True], (d[1:] != d[:-1]) | (g[1:] != g[:-1])])).tolist()
                for x, y in zip(cuts, [*cuts[1:], len(d)]):
                    spans[int(d[x]), int(g[x])] = both[x:y]
            none = np.zeros((0, 2), np.int64)
            for i, text in zip(key, _texts(t)):
                for o, v in zip(out, keep(text, spans.get(i, none))):
                    o.append(v)
        return pa.table({"doc_id": t.column("doc_id") if t.num_rows else pa.array([], pa.int64())}
                        | {c: pa.array(o, k) for c, o, k in zip(names, out, types)})
    return run


def covered(size: int, ranges: np.ndarray) -> np.ndarray:
    """Which of ``size`` units lie in ``ranges``."""
    edge = np.zeros(size + 1, np.int32)
    np.add.at(edge, ranges[:, 0], 1)
    np.add.at(edge, ranges[:, 1], -1)
    return np.cumsum(edge)[:size] > 0
