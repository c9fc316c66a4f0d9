"""Near-duplicates by BagMinHash on multisets of word shingles.

A document is the multiset of its runs of five words (white-space separated;
a text of one to four words is one shingle). Two documents are linked if their
multisets overlap by 0.8 or more (sum of least counts over sum of greatest),
and classes are the components of the links.

Signatures. Every shingle of weight w owns Poisson processes on the weight
levels (0,1], (1,2], (2,4], (4,8], ... up to w: a level is one process whose
rate is its length, and the last, partly covered one is thinned by the position
of each point, so processes of different weights agree where they overlap.
Points come in the order of their times, each with a component drawn from the
shingle's hash; the earliest point of a component is its value. Two documents
agree in a component with exactly the probability of their weighted Jaccard
similarity. A document draws points only up to the time by which its components
are likely full (some M ln M points in all, whatever its length), and goes on where they
are not.

Links. Texts of equal words are one node. ``BANDS`` bands of ``WIDTH``
components make candidates (a pair at 0.8 shares none with probability 3e-6).
A band gives the pairs with its hub, the node that shares most bands. Pairs
whose signatures agree too little to reach 0.8 (4.5 standard deviations) are left
out, the rest are verified on the texts. Bands whose nodes are then still in
several classes are compared across classes, signature against signature in
blocks, each pair in the first band it shares. What may reach 0.8 leaves a block as
tiles, at most ``2 * TILE`` nodes with the pairs among them as packed numbers; a tile's texts are
fetched once each, its pairs verified there, and only links that join something
come out (a spanning forest). So no link that would join classes is lost to a band's size, and no
group is written out as pairs: where n texts are close to 0.8 of each other without reaching it, each
has a row for every tile it is in, n / ``TILE`` + 1 at most.

Null, empty and blank texts have no shingles and are classes of their own. The
class id is the least doc_id of the class; null doc_ids count as greatest.
Rows that repeat a doc_id with one text are one document. Texts of any length are
compared whole. An empty table gives no rows. Other columns are not read, so their names can't clash;
:func:`drop_near` carries them along.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import cut, keep_rows, keyed, real_id, spread_join
from .components import components
from .windows import U, mix, word_hashes

SHINGLE = 5
M, BANDS, WIDTH = 512, 24, 4
#: The similarity from which documents are linked, as a fraction.
AT_LEAST = (4, 5)
#: Nodes of a block where large bands are compared across classes, and about
#: as many rows of small bands are compared in one group.
SIDE, TOGETHER = 2048, 20_000
#: Nodes on each side of a tile whose pairs are verified together.
TILE = 256
#: Bytes of text handled at once, and documents: each draws some M ln M points, however short it is.
BLOCK, MOST = 1 << 18, 256
#: Pairs that are numbered at once.
PAIRS = 1 << 16


def shingles(text: bytes, k: int = SHINGLE) -> list[bytes]:
    w = text.split()
    if len(w) <= k:
        return [b" ".join(w)] if w else []
    return [b" ".join(w[i:i + k]) for i in range(len(w) - k + 1)]


def overlap(a: Counter, b: Counter) -> tuple[int, int]:
    """Sums of least and of greatest counts."""
    if len(a) > len(b):
        a, b = b, a
    least = sum(min(n, b[s]) for s, n in a.items() if s in b)
    return least, a.total() + b.total() - least


def _elements(texts: list[bytes], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, shingle hash) pairs with their counts; texts have words."""
    buf = b"\n".join(texts) + b"\n"
    arr = np.frombuffer(buf, np.uint8)
    end = np.flatnonzero((arr == 32) | (arr == 10))
    begin = np.concatenate([[0], end[:-1] + 1])
    word = word_hashes(arr, begin, end)
    last = np.flatnonzero(arr[end] == 10)
    size = np.diff(last, prepend=-1)
    gram = np.zeros(len(word), U)
    for j in range(k):
        part = word[j:] * U((2 * 0x9E3779B97F4A7C15 * (j + 1) + 1) % 2**64)
        gram[:len(part)] += part ^ (part >> U(29))
    mix(gram)
    n = np.maximum(size - k + 1, 1)
    doc = np.repeat(np.arange(len(texts)), n)
    at = np.repeat(last - size + 1, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    h = gram[at]
    for i in np.flatnonzero(size < k).tolist():  # one shingle, not the next text's words
        h[np.searchsorted(doc, i)] = xxhash.xxh3_64_intdigest(texts[i])
    key = np.sort(doc.astype(U) << U(52) | h >> U(12))
    cuts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    key = key[cuts]
    return (key >> U(52)).astype(np.int64), key & U(2**52 - 1), np.diff(np.append(cuts, len(h)))


def _levels(doc: np.ndarray, element: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, ...]:
    """document, hash, rate and covered share of each (element, weight level)."""
    parts = [(doc, mix(element.copy()), np.ones(len(doc)), np.ones(len(doc)))]
    low, level = 1, 1
    while (more := count > low).any():
        doc, element, count = doc[more], element[more], count[more]
        parts.append((doc, mix(element + U(level << 52)), np.full(len(doc), float(low)),
                      np.minimum(1.0, (count - low) / low)))
        low, level = low * 2, level + 1
    return tuple(np.concatenate(p) for p in zip(*parts))


def signatures(texts: list[bytes], m: int = M, k: int = SHINGLE) -> np.ndarray:
    """BagMinHash values, one row per text (words joined by single blanks, at
    least one word)."""
    doc, element, count = _elements(texts, k)
    weight = np.bincount(doc, count, len(texts))
    d, seed, rate, share = _levels(doc, element, count)
    best = np.full(len(texts) * m, np.inf)
    value = np.zeros(len(texts) * m, U)
    limit = (np.log(m) + 2) / weight
    live = np.arange(len(d))
    while len(live):
        where, when, what = [], [], []
        now, nth, e, batch = np.zeros(len(live)), 0, live, 4
        while len(e):
            step = np.arange(nth, nth + batch, dtype=U) * U(0x9E3779B97F4A7C15)
            h = mix(seed[e][:, None] + step[None, :] + U(1))
            gap = -np.log(((h >> U(11)).astype(np.float64) + 1) * 2.0**-53) / (rate[e] * m)[:, None]
            t = now[:, None] + np.cumsum(gap, axis=1)
            row, col = np.nonzero(t <= limit[d[e]][:, None])
            if len(row):
                h2 = mix(h[row, col] ^ U(0x2545F4914F6CDD1D))
                own = e[row]
                took = ((h2 >> U(32)).astype(np.float64) * 2.0**-32) < share[own]
                where.append((d[own] * m + ((h2 & U(0xFFFFFFFF)) % U(m)).astype(np.int64))[took])
                when.append(t[row, col][took])
                what.append(h2[took])
            on = t[:, -1] <= limit[d[e]]
            now, e = t[on, -1], e[on]
            nth, batch = nth + batch, 16
        if where:
            where, when, what = np.concatenate(where), np.concatenate(when), np.concatenate(what)
            np.minimum.at(best, where, when)
            won = when == best[where]
            value[where[won]] = what[won]
        open_ = ~np.isfinite(best.reshape(-1, m)).all(axis=1)
        limit *= 2
        live = live[open_[d[live]]]
    return value.reshape(-1, m)


def _signed(m: int, bands: int, width: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [b" ".join(t.split()) for t in b.column("text").cast(pa.binary()).to_pylist()]
            some = [i for i, t in enumerate(texts) if t]
            at = 0
            while at < len(some):
                z, size = at, 0
                while z < len(some) and z - at < MOST and (z == at or size + len(texts[some[z]]) <= BLOCK):
                    size += len(texts[some[z]])
                    z += 1
                part = [texts[i] for i in some[at:z]]
                s = signatures(part, m, k)
                key = np.full((len(part), bands), 0, U)
                for j in range(bands):
                    for c in range(width):
                        key[:, j] = mix(key[:, j] * U(3) + s[:, j * width + c] + U(j * width + c))
                rows = pa.array(some[at:z])
                yield pa.RecordBatch.from_pydict({
                    "doc_id": b.column("doc_id").take(rows), "tag": b.column("tag").take(rows),
                    "node": pa.array([xxhash.xxh3_128_digest(t) for t in part], pa.binary()),
                    "sig": pa.array([r.tobytes() for r in _nibbles(s)], pa.binary()),
                    "bands": pa.ListArray.from_arrays(np.arange(0, key.size + 1, bands, dtype=np.int32),
                                                      key.view(np.int64).ravel())})
                at = z
    return run


def _nibbles(s: np.ndarray) -> np.ndarray:
    """Four bits of each component, two components a byte. They are drawn from
    the whole value: its own lowest bits say no more than the component's place."""
    low = (mix(s.copy()) & U(15)).astype(np.uint8)
    return low[:, ::2] << 4 | low[:, 1::2]


def _agree(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Agreeing components of packed signatures, row by row."""
    d = x ^ y
    return ((d & 0xF0) == 0).sum(axis=1) + ((d & 0x0F) == 0).sum(axis=1)


def enough(m: int, at_least: tuple[int, int]) -> int:
    """Agreeing components (of four bits) below which a pair is taken not to
    reach the similarity: 4.5 standard deviations under it."""
    p = at_least[0] / at_least[1]
    p += (1 - p) / 16
    return int(np.floor(m * p - 4.5 * np.sqrt(m * p * (1 - p))))


def _agreeing(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x, y = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint8).reshape(b.num_rows, -1)
                        for c in ("sig_a", "sig_b"))
                yield b.select(["a", "b"]).filter(pa.array(_agree(x, y) >= least))
    return run


def _verified(at_least: tuple[int, int], k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, own = None, Counter()
        for b in batches:
            a, other = b.column("a").to_pylist(), b.column("b").to_pylist()
            ta, tb = (b.column(c).cast(pa.binary()) for c in ("text_a", "text_b"))
            out = []
            for i in range(b.num_rows):
                if a[i] != last:
                    last, own = a[i], Counter(shingles(ta[i].as_py(), k))
                least, most = overlap(own, Counter(shingles(tb[i].as_py(), k)))
                if least * at_least[1] >= most * at_least[0]:
                    out.append(i)
            yield pa.RecordBatch.from_pydict({"a": pa.array([a[i] for i in out], pa.binary()),
                                              "b": pa.array([other[i] for i in out], pa.binary())})
    return run


def _across(least: int):
    """Pairs of nodes of different classes that share a band, first this one,
    and whose signatures agree enough: of one block of a large band, or of
    many small bands. In tiles: the nodes of a tile, and its pairs as two numbers each."""
    def run(t: pa.Table) -> pa.Table:
        band = t.column("band").to_numpy()
        order = np.argsort(band, kind="stable")
        band = band[order]
        node, root = (np.array(t.column(c).to_pylist(), dtype="S16")[order] for c in ("node", "root"))
        own, nth = t.column("own").to_numpy()[order], t.column("nth").to_numpy()[order]
        sig = np.frombuffer(b"".join(t.column("sig").to_pylist()), np.uint8).reshape(t.num_rows, -1)[order]
        keys = t.column("keys").combine_chunks().flatten().to_numpy().reshape(t.num_rows, -1)[order]
        low, high = t.column("i")[0].as_py(), t.column("j")[0].as_py()
        cuts = np.flatnonzero(np.concatenate([[True], band[1:] != band[:-1]]))
        a, b = [np.empty(0, np.int32)], [np.empty(0, np.int32)]
        for x, z in zip(cuts.tolist(), [*cuts[1:].tolist(), len(band)]):
            r = root[x:z]
            if (r == r[0]).all():
                continue
            for i in range(x, z):
                if own[i] != low:
                    continue
                others = np.arange(i + 1, z) if low == high else x + np.flatnonzero(own[x:z] == high)
                others = others[root[others] != root[i]]
                others = others[_agree(sig[others], sig[i]) >= least]
                if nth[i]:
                    others = others[~(keys[others, :nth[i]] == keys[i, :nth[i]]).any(axis=1)]
                a.append(np.full(len(others), i, np.int32))
                b.append(others.astype(np.int32))
        # nodes in the order of their bands, so that the pairs of a band share tiles
        raw = t.column("node").combine_chunks().take(pa.array(order))
        _, first, number = np.unique(node, return_index=True, return_inverse=True)
        rank = np.argsort(np.argsort(first))[number]
        at = np.sort(first)
        # a pair is one number that sorts by its tile, then by its nodes
        a, b = np.concatenate(a), np.concatenate(b)
        code = np.empty(len(a), np.int64)
        wide = len(at) // TILE + 1
        for i in range(0, len(a), PAIRS):
            x, y = rank[a[i:i + PAIRS]], rank[b[i:i + PAIRS]]
            x, y = np.minimum(x, y), np.maximum(x, y)
            code[i:i + PAIRS] = (((x // TILE) * wide + y // TILE) * TILE + x % TILE) * TILE + y % TILE
        del a, b
        code.sort()
        code = code[np.diff(code, prepend=-1) != 0]
        cuts = np.flatnonzero(np.diff(code // TILE**2, prepend=-1))
        out = {"tile": [], "nodes": [], "pairs": []}
        place = "/".join(str(t.column(c)[0].as_py()) for c in ("cell", "large", "i", "j"))
        for k, part in enumerate(np.split(code, cuts[1:]) if len(code) else []):
            tile = int(part[0]) // TILE**2
            pair = np.stack([tile // wide * TILE + part // TILE % TILE, tile % wide * TILE + part % TILE], axis=1)
            used, own_number = np.unique(pair, return_inverse=True)
            out["tile"].append(f"{place}/{k}")
            out["nodes"].append(raw.take(pa.array(at[used])).to_pylist())
            out["pairs"].append(own_number.reshape(-1).astype("<i2").tobytes())
        return pa.table(out, schema=pa.schema([("tile", pa.string()), ("nodes", pa.list_(pa.binary())), ("pairs", pa.binary())]))
    return run


def _tile_links(at_least: tuple[int, int], k: int):
    """The links of a tile that join something, by its texts: shingles are numbered
    within the tile, and each pair of nodes not yet connected is counted exactly."""
    def run(t: pa.Table) -> pa.Table:
        at = t.column("pos").to_numpy()
        row = np.empty(len(at), np.int64)
        row[at] = np.arange(len(at))
        pairs = np.frombuffer(next(p.as_py() for p in t.column("pairs") if p.is_valid), "<i2").reshape(-1, 2)
        texts, nodes = t.column("text").cast(pa.binary()), t.column("node").to_pylist()
        number: dict[bytes, int] = {}
        held = []
        for i in range(len(at)):
            c = Counter(shingles(texts[int(row[i])].as_py(), k))
            ids = np.fromiter((number.setdefault(s, len(number)) for s in c), np.int64, len(c))
            held.append((ids, np.fromiter(c.values(), np.int64, len(c)), c.total()))
        root = list(range(len(at)))

        def find(i: int) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        a, b, last = [], [], -1
        dense = np.zeros(len(number), np.int64)
        for x, y in pairs.tolist():
            small, great = sorted((held[x][2], held[y][2]))
            if small * at_least[1] < great * at_least[0] or find(x) == find(y):
                continue
            if x != last:
                if last >= 0:
                    dense[held[last][0]] = 0
                dense[held[x][0]] = held[x][1]
                last = x
            least = int(np.minimum(dense[held[y][0]], held[y][1]).sum())
            if least * at_least[1] >= (small + great - least) * at_least[0]:
                root[find(x)] = find(y)
                a.append(nodes[int(row[x])])
                b.append(nodes[int(row[y])])
        return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})
    return run


class Linker:
    """The state of one run: nodes, their signatures and texts."""

    def __init__(self, docs: DataFrame, m: int, bands: int, width: int, k: int, at_least: tuple[int, int]):
        self.k, self.at_least, self.least = k, at_least, enough(m, at_least)
        self.docs = keyed(docs)
        self.signed = cut(self.docs.mapInArrow(
            _signed(m, bands, width, k), "doc_id long, tag long, node binary, sig binary, bands array<long>"))
        # rows of one node have one text: any signature of it serves
        self.nodes = cut(self.signed.groupBy("node").agg(
            F.min(F.struct("doc_id", "tag")).alias("rep"), F.count(F.lit(1)).alias("copies"),
            F.first("sig").alias("sig"), F.first("bands").alias("bands"))
            .select("node", "rep.doc_id", "rep.tag", "copies", "sig", "bands"))
        self.sigs = self.nodes.select("node", "sig")
        keys = self.nodes.select("node", F.posexplode("bands").alias("nth", "band"))
        many = keys.groupBy("band").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        self.members = cut(keys.join(many, "band"))

    def _side(self, name: str) -> DataFrame:
        return self.sigs.select(F.col("node").alias(name), F.col("sig").alias(f"sig_{name}"))

    def candidates(self) -> DataFrame:
        """The pairs of each band's nodes with its hub."""
        mass = self.members.groupBy("node").agg(F.sum("n").alias("mass"))
        rows = self.members.join(mass, "node")
        hubs = rows.groupBy("band").agg(F.max(F.struct("mass", "node")).alias("hub"))
        return (rows.join(hubs, "band").filter("node <> hub.node")
                .select(F.col("hub.node").alias("a"), F.col("node").alias("b")).distinct())

    def likely(self, pairs: DataFrame) -> DataFrame:
        return (pairs.join(self._side("a"), "a").join(self._side("b"), "b")
                .select("a", "b", "sig_a", "sig_b").mapInArrow(_agreeing(self.least), "a binary, b binary"))

    def texts(self, wanted: DataFrame) -> DataFrame:
        """node, text of the nodes ``wanted`` (node, distinct)."""
        reps = self.nodes.join(wanted, "node", "left_semi").select("node", "doc_id", "tag")
        return self.docs.join(reps, ["doc_id", "tag"]).select("node", "text").dropDuplicates(["node"])

    def verify(self, pairs: DataFrame) -> DataFrame:
        """The pairs that reach the similarity, by their texts."""
        texts = cut(self.texts(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()))
        j = pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
        # a is a hub: its pairs are spread over salts, and rows of one a and salt follow
        # each other, so its shingles are counted once for each
        j = spread_join(j, texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a", "b")
        return j.select("a", "b", "text_a", "text_b").mapInArrow(
            _verified(self.at_least, self.k), "a binary, b binary")

    def tiles(self, root: DataFrame, side: int, together: int) -> DataFrame:
        """tile, nodes, pairs: what may link nodes of different classes that share a band."""
        rows = self.members.join(root, "node", "left").withColumn("root", F.coalesce("root", "node"))
        mixed = cut(rows.groupBy("band").agg(F.min("root").alias("least"), F.max("root").alias("most"),
                                             F.count(F.lit(1)).alias("rows"))
                    .filter("least <> most and rows > 2").select("band", "rows"))
        cells = max(1, (mixed.agg(F.sum("rows")).first()[0] or 0) // together)
        blocks = F.ceil(F.col("n") / side).cast("int")
        # bands of one block are dealt to cells together, larger ones block by block
        cell = F.when(blocks == 1, F.pmod("band", F.lit(cells))).otherwise(F.col("band"))
        rows = (rows.join(mixed.select("band"), "band")
                .withColumn("own", F.pmod(F.xxhash64("node"), blocks).cast("int"))
                .withColumn("with", F.explode(F.sequence(F.lit(0), blocks - 1)))
                .join(self.nodes.select("node", "sig", F.col("bands").alias("keys")), "node")
                .select(cell.alias("cell"), (blocks > 1).alias("large"), F.least("own", "with").alias("i"),
                        F.greatest("own", "with").alias("j"), "band", "nth", "own", "node", "root", "sig", "keys"))
        return rows.groupBy("cell", "large", "i", "j").applyInArrow(
            _across(self.least), "tile string, nodes array<binary>, pairs binary")

    def between(self, tiles: DataFrame) -> DataFrame:
        """The links of tiles that join something, by the texts of their nodes."""
        each = tiles.select("tile", F.posexplode("nodes").alias("pos", "node"), "pairs")
        each = each.withColumn("pairs", F.when(F.col("pos") == 0, F.col("pairs")))
        with_text = each.join(self.texts(each.select("node").distinct()), "node")
        return with_text.groupBy("tile").applyInArrow(_tile_links(self.at_least, self.k), "a binary, b binary")


def near_classes(docs: DataFrame, m: int = M, bands: int = BANDS, width: int = WIDTH, k: int = SHINGLE,
                 at_least: tuple[int, int] = AT_LEAST, side: int = SIDE, together: int = TOGETHER) -> DataFrame:
    """doc_id, tag, class_id, class_size of every row (null doc_id: NO_ID)."""
    run = Linker(docs, m, bands, width, k, at_least)
    links = cut(run.verify(cut(run.likely(run.candidates()))))
    root = components(links)
    more = cut(run.between(cut(run.tiles(root, side, together))))
    if not more.isEmpty():
        links = links.union(more)
        root = components(links)
    classed = run.nodes.select("node", "doc_id", "copies").join(root, "node", "left").withColumn(
        "root", F.coalesce("root", "node"))
    sizes = classed.groupBy("root").agg(F.min("doc_id").alias("class_id"), F.sum("copies").alias("class_size"))
    of_node = spread_join(classed.select("root", "node"), sizes, "root", "node").drop("root")
    per = spread_join(run.signed.select("doc_id", "tag", "node").distinct(), of_node, "node", "doc_id")
    every = run.docs.select("doc_id", "tag")
    return every.join(per.drop("node"), ["doc_id", "tag"], "left").select(
        "doc_id", "tag", F.coalesce("class_id", "doc_id").alias("class_id"),
        F.coalesce("class_size", F.lit(1)).alias("class_size"))


def near_groups(docs: DataFrame, **options) -> DataFrame:
    """doc_id, class_id, class_size, kept of every row."""
    return near_classes(docs, **options).select(
        real_id().alias("doc_id"), real_id("class_id").alias("class_id"), "class_size",
        (F.col("doc_id") == F.col("class_id")).alias("kept"))


def drop_near(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, all columns, that stand for their class."""
    return keep_rows(docs, near_classes(docs, **options).filter("doc_id = class_id"))


#: DuckDB SQL of the same rows: all pairs that share a shingle, then the closure of the links.
SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) <= 5 THEN [array_to_string(w, ' ')]
        ELSE [array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)] END AS sh FROM d WHERE len(w) > 0),
e AS (SELECT doc_id, x, count(*) AS n FROM (SELECT doc_id, unnest(sh) AS x FROM s) GROUP BY ALL),
t AS (SELECT doc_id, sum(n) AS total FROM e GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, sum(least(a.n, b.n)) AS shared FROM e a JOIN e b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN t x ON x.doc_id = a JOIN t y ON y.doc_id = b WHERE 5 * shared >= 4 * (x.total + y.total - shared)),
m AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id, doc_id AS root FROM d UNION SELECT m.b, r.root FROM r JOIN m ON r.doc_id = m.a),
c AS (SELECT doc_id, min(root) AS class_id FROM r GROUP BY doc_id)
SELECT d.doc_id, class_id, count(*) OVER (PARTITION BY class_id) AS class_size, d.doc_id = class_id AS kept
FROM d JOIN c ON d.doc_id = c.doc_id
"""
