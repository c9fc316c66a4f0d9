"""Phrase collocation mining with stripes.

A stripe is the counter of the words that follow one prefix: prefix -> {next
word: count}. Every task counts the stripes of a block of text (numpy over
word numbers), and stripes of the same prefix are merged elementwise in their
bucket. One structure gives all numbers: the entries of the empty prefix are
the word counts and their sum n; the entries of a prefix of k words are the
counts of its extensions to k + 1 words, and the counts of prefixes, rests and
longer phrases are entries of other stripes.

Stripes grow level by level. A phrase of m words can only be frequent if both
phrases of m - 1 words in it are, so the windows of the next level are first
looked up in a bit table of the frequent phrases (at most ``FILTER_BITS`` bits, a
fixed size, broadcast). A chance hit costs a few bytes and never changes a result.

Stripes travel packed: one row per block and bucket holds the prefixes, the
next words and the counts of many stripes. The bucket is a hash of the prefix
and of one of ``parts`` shares of the next words, so the stripe of a hot prefix
is spread over buckets, and buckets and shares grow with the corpus. A hot pair
sends one entry per block.

Only frequent entries leave the merge. Candidates, their sub-phrases and their
longer phrases then meet in salted joins on (lang, phrase).

Null texts count as empty, a null lang as ``und``. Texts without words, and an
empty table, give no rows. Repeated rows count as often as they occur. A text of any
length is counted in blocks that overlap by three words, so no window is
lost or counted twice. Only ``text`` and ``lang`` are read, so other columns can't clash.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import or_empty, spread_join, stored

MOST_WORDS, LEAST, TOP = 4, 30, 2000
NO_LANG = "und"
#: Bytes of text counted at once, and packed bytes of one bucket.
BLOCK, BUCKET = 8 << 20, 8 << 20
FILTER_BITS = 1 << 28

END = b"\xff"  # between pieces; no byte of UTF-8
_TABLE = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t.,;:!?\n\x0b\x0c\r",
                         b"abcdefghijklmnopqrstuvwxyz " + END * 10)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _mix(h: np.ndarray) -> np.ndarray:
    """Spreads the bits of a 64-bit number (a finaliser of xor-shifts)."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x7FB5D329728EA185)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def _numbered(words: list) -> tuple[np.ndarray, pa.BinaryArray]:
    """Every word's number, and the words by number."""
    d = pa.array(words, pa.binary()).dictionary_encode()
    return d.indices.to_numpy(zero_copy_only=False).astype(np.int64), d.dictionary


def _window_hash(h: np.ndarray, lang: str) -> np.ndarray:
    """Of rows of word hashes, one hash each."""
    out = np.full(len(h), zlib.crc32(lang.encode()), np.uint64)
    for j in range(h.shape[1]):
        out = _mix(out * _STEP + h[:, j])
    return out


def _blocks(data: bytes, size: int) -> Iterator[tuple[bytes, int]]:
    """``data`` in blocks of about ``size`` bytes, cut between pieces or, within
    a longer one, between words; with each block the number of words at its start
    that the block before has counted."""
    at, seen, lead = 0, 0, b""
    while at < len(data):
        end = len(data)
        if end - at > size:
            cut = data.rfind(END, at, at + size)
            if cut < 0:
                cut = data.find(b" ", at + size)
                stop = data.find(END, at + size)
                cut = min((c for c in (cut, stop) if c >= 0), default=end - 1)
            end = cut + 1
        part = lead + data[at:end]
        yield part, seen
        lead, seen, at = b"", 0, end
        if end < len(data) and not part.endswith(END):  # within a piece: its last words go along
            tail = b" ".join(part.rsplit(None, MOST_WORDS)[1 - MOST_WORDS:])
            tail = tail.rsplit(END, 1)[-1].split()
            lead, seen = b" ".join(tail) + b" ", len(tail)


class Block:
    """The words of a block of text as numbers."""

    def __init__(self, data: bytes):
        self.code, vocab = _numbered(data.replace(END, b" " + END + b" ").split())
        words = vocab.to_pylist()
        self.hashes = pd.util.hash_array(np.array(words, dtype=object), categorize=False)
        self.word = ~np.array([w == END for w in words], bool)[self.code]
        # words with a blank behind: a run of them is a slice of one buffer
        self.spaced = pa.array([w + b" " for w in words], pa.binary())


def _stripes(m: int, lang: str, text: Block, seen: int, buckets: int, parts: int,
             table: np.ndarray | None) -> pa.RecordBatch | None:
    """The stripes of the prefixes of m - 1 words of one block, packed by bucket."""
    code, hashes, word, vocab, spaced = text.code, text.hashes, text.word, text.hashes, text.spaced
    if len(code) < m:
        return None
    n = len(code) - m + 1
    ok = np.ones(n, bool)
    for j in range(m):
        ok &= word[j:n + j]
    ok[:max(0, seen - m + 1)] = False
    at = np.flatnonzero(ok)
    if table is not None and len(at):
        shift = np.uint64(64 - int(math.log2(len(table) * 64)))
        for j in (0, 1):  # both shorter phrases must be frequent
            place = _window_hash(hashes[code[at[:, None] + np.arange(j, j + m - 1)]], lang) >> shift
            hit = (table[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1)
            at = at[hit.astype(bool)]
    if not len(at):
        return None
    # the number of a window's first words, then of the window
    prefix = np.zeros(len(at), np.int64)
    for j in range(m - 1):
        prefix = np.unique(prefix * len(vocab) + code[at + j], return_inverse=True)[1]
    pair, first, count = np.unique(prefix * len(vocab) + code[at + m - 1], return_index=True, return_counts=True)
    start, prefix, last = at[first], pair // len(vocab), pair % len(vocab)
    share = (hashes[last] % np.uint64(parts)).reshape(-1, 1)
    before = hashes[code[start[:, None] + np.arange(m - 1)]] if m > 1 else np.zeros((len(start), 0), np.uint64)
    bucket = (_window_hash(np.hstack([before, share]), lang) % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((prefix, bucket))
    start, prefix, last, bucket = start[order], prefix[order], last[order], bucket[order]
    count = count[order].astype("<i8")
    new_row = np.flatnonzero(np.diff(bucket, prepend=-1))
    new = np.flatnonzero((np.diff(bucket, prepend=-1) != 0) | (np.diff(prefix, prepend=-1) != 0))
    size = np.diff(new, append=len(order)).astype("<i4")

    def joined(numbers: np.ndarray, edges: np.ndarray) -> pa.BinaryArray:
        taken = spaced.take(pa.array(numbers))
        offsets = np.frombuffer(taken.buffers()[1], "<i4")[taken.offset:taken.offset + len(taken) + 1]
        return pa.Array.from_buffers(pa.binary(), len(edges) - 1,
                                     [None, pa.py_buffer(offsets[edges].astype("<i4").tobytes()), taken.buffers()[2]])

    def packed(numbers: np.ndarray, edges: np.ndarray) -> pa.BinaryArray:
        offsets = (edges * numbers.itemsize).astype("<i4")
        return pa.Array.from_buffers(pa.binary(), len(edges) - 1,
                                     [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(numbers.tobytes())])

    rows = np.append(new_row, len(order))
    stripes = np.searchsorted(new, rows)
    firsts = code[start[new][:, None] + np.arange(m - 1)].reshape(-1) if m > 1 else np.zeros(0, np.int64)
    return pa.RecordBatch.from_pydict({
        "lang": pa.array([lang] * len(new_row), pa.string()),
        "words": pa.array([m] * len(new_row), pa.int32()),
        "bucket": pa.array(bucket[new_row], pa.int64()),
        "prefixes": joined(firsts, stripes * (m - 1)), "sizes": packed(size, stripes),
        "nexts": joined(last, rows), "counts": packed(count, rows)})


STRIPES = "lang string, words int, bucket long, prefixes binary, sizes binary, nexts binary, counts binary"


def _count(levels: tuple[int, ...], buckets: int, parts: int, block: int, table):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = None if table is None else np.frombuffer(table.value, "<u8")
        held: dict[str, list[bytes]] = {}
        size: dict[str, int] = {}

        def flush(lang: str) -> Iterator[pa.RecordBatch]:
            size.pop(lang)
            for part, seen in _blocks(b"".join(held.pop(lang)), block):
                text = Block(part)
                for m in levels:
                    out = _stripes(m, lang, text, seen, buckets, parts, bits)
                    if out is not None:
                        yield out

        for b in batches:
            for lang, text in zip(b.column("lang"), b.column("text")):
                raw, lang = text.as_buffer().to_pybytes().translate(_TABLE) + END, lang.as_py()
                held.setdefault(lang, []).append(raw)
                size[lang] = size.get(lang, 0) + len(raw)
                if size[lang] >= block:
                    yield from flush(lang)
                elif sum(size.values()) >= 4 * block:  # many languages share the memory
                    yield from flush(max(size, key=size.get))
        for lang in list(held):
            yield from flush(lang)
    return run


FREQUENT = "lang string, words int, phrase string, f long, h long"


def _merge(least: int):
    """Merges the stripes of a bucket elementwise; its entries of at least
    ``least``, and (of the empty prefix) the sum of all entries, with no phrase."""
    def one(lang: str, m: int, mine: pa.Table) -> dict:
        size = np.frombuffer(b"".join(mine.column("sizes").to_pylist()), "<i4")
        count = np.frombuffer(b"".join(mine.column("counts").to_pylist()), "<i8")
        firsts = b"".join(mine.column("prefixes").to_pylist()).split()
        code, vocab = _numbered(firsts + b"".join(mine.column("nexts").to_pylist()).split())
        first, last = code[:len(firsts)].reshape(-1, m - 1) if m > 1 else None, code[len(firsts):]
        # prefixes are numbered once per stripe, then windows
        prefix = np.zeros(len(size), np.int64)
        for j in range(m - 1):
            prefix = np.unique(prefix * len(vocab) + first[:, j], return_inverse=True)[1]
        pair = np.repeat(prefix, size) * len(vocab) + last
        order = np.argsort(pair)
        new = np.flatnonzero(np.diff(pair[order], prepend=-1))
        f = np.add.reduceat(count[order], new)
        often = f >= least
        f, at = f[often], order[new[often]]
        stripe = np.searchsorted(np.cumsum(size), at, "right")
        window = np.hstack([first[stripe] if m > 1 else np.zeros((len(at), 0), np.int64), last[at].reshape(-1, 1)])
        used, place = np.unique(window, return_inverse=True)
        words = vocab.take(pa.array(used))
        h = pd.util.hash_array(np.array(words.to_pylist(), dtype=object), categorize=False)[place.reshape(window.shape)]
        words = [w.decode() for w in words.to_pylist()]
        out = {"phrase": [" ".join(words[c] for c in w) for w in place.reshape(window.shape)], "f": f.tolist(),
               "h": _window_hash(h, lang).view(np.int64).tolist()}
        if m == 1:
            out = {"phrase": [*out["phrase"], None], "f": [*out["f"], int(count.sum())], "h": [*out["h"], 0]}
        return {"lang": [lang] * len(out["f"]), "words": [m] * len(out["f"])} | out

    schema = pa.schema([("lang", pa.string()), ("words", pa.int32()), ("phrase", pa.string()), ("f", pa.int64()),
                        ("h", pa.int64())])

    def run(rows: pa.Table) -> pa.Table:
        langs, words = rows.column("lang").to_pylist(), rows.column("words").to_pylist()
        kinds = sorted(set(zip(langs, words)))
        tables = [pa.table(one(*k, rows.filter(pa.array([x == k for x in zip(langs, words)]))), schema=schema) for k in kinds]
        return pa.concat_tables(tables)
    return run


def _bit_table(frequent: DataFrame):
    """A broadcast bit table of the phrases' hashes, 16 bits a phrase up to
    ``FILTER_BITS`` in all."""
    n = frequent.count()
    bits = min(max(10, math.ceil(math.log2(16 * n + 1))), int(math.log2(FILTER_BITS)))
    place = F.shiftrightunsigned("h", 64 - bits)
    one = F.expr("shiftleft(1L, cast(place & 63 as int))")
    cells = (frequent.select(place.alias("place")).groupBy(F.shiftright("place", 6).alias("cell"))
             .agg(F.bit_or(one).alias("bits")).toArrow())
    table = np.zeros(1 << (bits - 6), "<i8")
    table[cells.column("cell").to_numpy()] = cells.column("bits").to_numpy()
    return frequent.sparkSession.sparkContext.broadcast(table.tobytes())


def frequent_phrases(docs: DataFrame, least: int = LEAST, most_words: int = MOST_WORDS, block: int = BLOCK,
                     bucket: int = BUCKET) -> DataFrame:
    """lang, words, phrase, f of every phrase of up to ``most_words`` words that
    occurs ``least`` times or more, and per lang rows without phrase whose f add up to n."""
    d = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANG)).alias("lang"),
                    or_empty().cast("binary").alias("text"))
    total = d.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # a level's packed stripes are about as large as the texts
    buckets = max(1, -(-total // bucket))
    parts = max(64, buckets // 4)
    def counted(levels: tuple[int, ...], table) -> DataFrame:
        # a bucket holds the stripes of its prefixes for one level or two
        s = d.mapInArrow(_count(levels, buckets, parts, block, table), STRIPES)
        return stored(s.groupBy("bucket", "words").applyInArrow(_merge(least), FREQUENT))

    # words and pairs need no filter: one pass
    out = level = counted(tuple(range(1, min(most_words, 2) + 1)), None)
    for m in range(3, most_words + 1):
        table = _bit_table(level.filter(F.col("words") == m - 1).filter(F.col("phrase").isNotNull()))
        level = counted((m,), table)
        table.destroy()
        out = out.unionByName(level)
    return out


def _split(phrase: Column, words: Column) -> Column:
    """All cuts of a phrase: k, first part, rest."""
    w = F.split(phrase, " ")
    return F.transform(F.sequence(F.lit(1), words - 1), lambda k: F.struct(
        k.alias("k"), F.array_join(F.slice(w, F.lit(1), k), " ").alias("first"),
        F.array_join(F.slice(w, k + 1, words - k), " ").alias("rest")))


def phrases(docs: DataFrame, least: int = LEAST, top: int = TOP, salts: int = 64, **sizes) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each lang's ``top`` phrases of 2
    to 4 words, as the stripes give them."""
    f = frequent_phrases(docs, least, **sizes)
    n = f.filter(F.col("phrase").isNull()).groupBy("lang").agg(F.sum("f").alias("n"))
    f = f.filter(F.col("phrase").isNotNull()).select("lang", "words", "phrase", "f")
    # The longest counts: a phrase inside a longer one lies inside one that is
    # a word longer and occurs at least as often, so one word is enough.
    w = F.split("phrase", " ")
    longer = (f.filter("words > 2").select("lang", "f", F.explode(F.array(
        F.array_join(F.slice(w, F.lit(1), F.col("words") - 1), " "),
        F.array_join(F.slice(w, F.lit(2), F.col("words") - 1), " "))).alias("phrase"))
        .groupBy("lang", "phrase").agg(F.max("f").alias("longest")))
    cand = (f.filter("words > 1").join(longer, ["lang", "phrase"], "left")
            .filter(F.col("longest").isNull() | (F.col("longest") * 100 < F.col("f") * 80))
            .select("lang", "phrase", F.col("f").alias("a"), F.explode(_split(F.col("phrase"), F.col("words"))).alias("c"))
            .select("lang", "phrase", "a", "c.*"))
    known = f.select(F.struct("lang", "phrase").alias("key"), "f")
    for part, out in (("first", "l"), ("rest", "r")):
        cand = spread_join(cand.withColumn("key", F.struct("lang", F.col(part).alias("phrase"))),
                           known.withColumnRenamed("f", out), "key", "phrase").drop("key")
    score = F.expr("(cast(a as decimal(20,0)) * 2000000) div (cast(l as decimal(20,0)) + r)")
    best = (cand.withColumn("score", score).groupBy("lang", "phrase", "a")
            .agg(F.min(F.struct("score", "k", "l", "r")).alias("b"))
            .select("lang", "phrase", "a", "b.l", "b.r", "b.score"))
    # first within a share of each lang, then among the best of all its shares
    order = [F.desc("score"), F.desc("a"), "phrase"]
    shares = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(salts))).orderBy(*order)
    some = best.withColumn("rank", F.row_number().over(shares)).filter(F.col("rank") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    return (ranked.filter(F.col("rank") <= top).join(n, "lang")
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))


#: DuckDB SQL of the same rows. Word lists of pieces, all their windows.
SQL = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
c AS (SELECT lang, m, unnest([array_to_string(w[i:i + m - 1], ' ') FOR i IN range(1, len(w) - m + 2)]) AS phrase
      FROM w, range(1, 5) r(m)),
n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
f AS (SELECT lang, m, phrase, count(*) AS f FROM c GROUP BY ALL HAVING count(*) >= 30),
s AS (SELECT lang, m, phrase, string_split(phrase, ' ') AS w, f FROM f),
b AS (SELECT lang, phrase, max(f) AS longest FROM (
        SELECT lang, array_to_string(w[1:m - 1], ' ') AS phrase, f FROM s WHERE m > 2
        UNION ALL SELECT lang, array_to_string(w[2:m], ' '), f FROM s WHERE m > 2) x GROUP BY ALL),
k AS (SELECT s.lang, s.phrase, s.f AS a, k, array_to_string(w[1:k], ' ') AS first, array_to_string(w[k + 1:m], ' ') AS rest
      FROM s LEFT JOIN b ON s.lang = b.lang AND s.phrase = b.phrase, range(1, 4) r(k)
      WHERE m > 1 AND k < m AND (longest IS NULL OR 100 * longest < 80 * s.f)),
t AS (SELECT k.lang, k.phrase, a, k, x.f AS l, y.f AS r, (2000000::HUGEINT * a) // (x.f::HUGEINT + y.f) AS score
      FROM k JOIN f x ON x.lang = k.lang AND x.phrase = first JOIN f y ON y.lang = k.lang AND y.phrase = rest),
u AS (SELECT lang, phrase, a, l, r, score::BIGINT AS score FROM t
      QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT u.lang, row_number() OVER (PARTITION BY u.lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, n, score
FROM u JOIN n ON u.lang = n.lang
QUALIFY row_number() OVER (PARTITION BY u.lang ORDER BY score DESC, a DESC, encode(phrase)) <= 2000
"""
