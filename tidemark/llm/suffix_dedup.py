"""Suffix-array dedup of byte strings, one bucket at a time.

Every whole text is a string of UTF-8 bytes; a byte goes if a 50-byte string
over it also starts in a document with a smaller doc_id. The suffixes (starts
of 50-byte strings) are dealt into buckets by minimiser (the 16-byte gram of
least hash, see :mod:`.windows`), so suffixes that agree in 50 bytes share a
bucket, and a bucket is some megabytes however large the corpus.

Within a bucket the suffixes of strings that share a minimiser are sorted:

1. by their first 15 bytes, five at a time, keeping only ties that hold
   several documents;
2. for the ties left, the positions of a difference cover modulo 13 are ranked
   by prefix doubling (the cover is closed under steps of 13, so a rank over d
   bytes and the rank d further on give a rank over 2d);
3. any two tied suffixes reach cover positions after the same step of at most
   12 bytes, so their order is the order of two ranks. All tie groups are
   split at once, each around one of its members, until every member is placed.

Neighbours in this order that agree in 50 bytes are repeats. Memory is bounded
by the bucket: a long common text costs ranks of 4/13 of its positions and no
comparisons of long strings.

The method's suffix buckets are by leading bytes; here they are by minimiser, since moving 50 bytes for every
position would be fifty times the input. What is sorted in a bucket are thus suffixes of fragments (a
minimiser's run with its context, 305 bytes at most), and the cover's ranks are those of the fragments.

Null texts are empty. Null doc_ids come after all others. Rows that repeat a
doc_id are as one document: they never make each other's strings repeats. Texts of any length are read
whole, in blocks that overlap by a string. An empty table gives no rows. Other columns than doc_id and text are
not read, so their names can't clash.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from .common import keyed, real_id
from .windows import Dealing, byte_units, covered, without_repeats

K, M = 50, 16

#: A difference cover modulo 13: every residue is a difference of two members.
PERIOD, COVER = 13, (0, 1, 3, 9)
#: Suffixes sorted at once (a group of one minimiser is never divided).
AT_ONCE = 1 << 20

_IN_COVER = np.isin(np.arange(PERIOD), COVER)
#: _STEP[a, b]: least step that takes both residues a and b into the cover.
_STEP = np.array([[next(d for d in range(PERIOD) if (a + d) % PERIOD in COVER and (b + d) % PERIOD in COVER)
                   for b in range(PERIOD)] for a in range(PERIOD)])


def _regroup(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order by key, and the group numbers along it."""
    order = np.argsort(key)
    s = key[order]
    return order, np.cumsum(np.concatenate([[0], s[1:] != s[:-1]])) if len(s) else s


class Text:
    """Strings laid end to end with zeros between; bytes count from 1, so an
    end sorts before every byte (0xFF is not in UTF-8)."""

    PAD = 16

    def __init__(self, strings: list[bytes]):
        up = bytes((i + 1) % 256 for i in range(256))
        gap = bytes(self.PAD)
        self.raw = gap.join(s.translate(up) for s in strings) + gap + gap
        self.size = np.array([len(s) for s in strings], np.int64)
        self.first = np.cumsum(self.size + self.PAD) - self.size - self.PAD
        n = len(self.raw) - 7
        self.words = np.ndarray((n,), ">u8", self.raw, 0, (1,))

    def five(self, at: np.ndarray) -> np.ndarray:
        return self.words[at].astype(np.uint64) >> np.uint64(24)

    def expand(self, which: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """string and offset of the first ``count`` positions of each string."""
        owner = np.repeat(which, count)
        return owner, np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)


def cover_ranks(t: Text, which: np.ndarray) -> np.ndarray:
    """Ranks (from 1; 0 elsewhere and beyond a string's end) of the cover
    positions of the strings ``which`` among each other, by whole suffix."""
    owner, offset = t.expand(which, t.size[which])
    at = t.first[owner] + offset
    keep = _IN_COVER[at % PERIOD]
    at, end = at[keep], (t.first + t.size)[owner[keep]]
    rank = np.zeros(len(t.words) + 7 + PERIOD, np.int64)
    group = np.zeros(len(at), np.int64)
    for step in (0, 5, 10):
        order, g = _regroup(group.astype(np.uint64) << np.uint64(40) | t.five(np.minimum(at + step, end)))
        group = np.empty_like(g)
        group[order] = g
    depth, longest = PERIOD, int(t.size[which].max(initial=0))
    while True:
        rank[at] = group + 1
        if depth >= longest or not len(at) or group.max() == len(at) - 1:
            return rank
        further = np.where(at + depth < end, rank[np.minimum(at + depth, len(rank) - 1)], 0)
        order, g = _regroup(group.astype(np.uint64) << np.uint64(32) | further.astype(np.uint64))
        group = np.empty_like(g)
        group[order] = g
        depth *= 2


def split_ties(at: np.ndarray, group: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Final places (equal for equal suffixes) of tied suffixes, given their
    tie groups in ascending order: each group is split around a member into
    less, equal and greater ones, all groups in one pass, until done."""
    place = np.empty(len(at), np.int64)
    place[:] = np.searchsorted(group, group)  # a group's first place
    todo = np.arange(len(at))
    while len(todo):
        g = place[todo]
        firsts = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
        size = np.diff(np.append(firsts, len(g)))
        pivot = np.repeat(at[todo[firsts + size // 2]], size)
        own = at[todo]
        step = _STEP[own % PERIOD, pivot % PERIOD]
        side = np.sign(rank[own + step] - rank[pivot + step]) + 1
        order = np.lexsort((side, g))
        todo, g, side = todo[order], g[order], side[order]
        new = np.flatnonzero(np.concatenate([[True], (g[1:] != g[:-1]) | (side[1:] != side[:-1])]))
        size_new = np.diff(np.append(new, len(g)))
        first_of = np.repeat(np.repeat(firsts, size)[new], size_new)
        place[todo] = g + np.repeat(new, size_new) - first_of
        more = (side != 1) & (np.repeat(size_new, size_new) > 1)
        todo = todo[more]
    return place


def _several(group: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Which rows are in a group (ascending) of several documents."""
    if not len(group):
        return np.zeros(0, bool)
    cuts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    mixed = np.minimum.reduceat(doc, cuts) != np.maximum.reduceat(doc, cuts)
    return np.repeat(mixed, np.diff(np.append(cuts, len(group))))


def equal_prefixes(strings: list[bytes], group: np.ndarray, doc: np.ndarray,
                   k: int = K) -> tuple[np.ndarray, np.ndarray]:
    """The pairs (string, offset) whose k bytes are also in a string of the
    same group with a smaller document."""
    t = Text(strings)
    owner, offset = t.expand(np.arange(len(strings)), t.size - k + 1)
    at = t.first[owner] + offset
    g = group[owner].astype(np.int64)
    for step in (0, 5, 10):
        g -= g.min(initial=0)
        order, g = _regroup(g.astype(np.uint64) << np.uint64(40) | t.five(at + step))
        owner, offset, at = owner[order], offset[order], at[order]
        live = _several(g, doc[owner])
        owner, offset, at, g = owner[live], offset[live], at[live], g[live]
        if len(g):
            g = np.cumsum(np.concatenate([[0], g[1:] != g[:-1]]))
    if not len(at):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    place = split_ties(at, g, cover_ranks(t, np.unique(owner)))
    order = np.argsort(place, kind="stable")
    owner, offset, at, g = owner[order], offset[order], at[order], g[order]
    same = g[1:] == g[:-1]
    for step in [*range(8, k - 8, 8), k - 8]:
        live = np.flatnonzero(same)
        same[live] = t.words[at[live] + step] == t.words[at[live + 1] + step]
    cuts = np.flatnonzero(np.concatenate([[True], ~same]))
    least = np.repeat(np.minimum.reduceat(doc[owner], cuts), np.diff(np.append(cuts, len(owner))))
    again = doc[owner] > least
    return owner[again], offset[again]


def _repeats(k: int):
    def run(strings: list[bytes], group: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = np.cumsum([len(s) - k + 1 for s in strings])
        ends = np.flatnonzero(np.append(np.diff(group) != 0, True)) + 1
        which, window, a = [], [], 0
        for j, z in enumerate(ends.tolist()):
            # as many whole groups as fit
            if j + 1 < len(ends) and n[ends[j + 1] - 1] - (n[a - 1] if a else 0) <= AT_ONCE:
                continue
            w, o = equal_prefixes(strings[a:z], group[a:z], doc[a:z], k)
            which.append(w + a)
            window.append(o)
            a = z
        return np.concatenate(which), np.concatenate(window)
    return run


def _keep(text: bytes, ranges: np.ndarray) -> tuple[int, int, int, bytes]:
    if not len(ranges):
        return len(text), 0, 0, text
    gone = covered(len(text), ranges)
    n_spans = int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum())
    return len(text), int(gone.sum()), n_spans, np.frombuffer(text, np.uint8)[~gone].tobytes()


def dedup_suffixes(docs: DataFrame, k: int = K, m: int = M, **options) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept (the
    bytes left, which may cut a character)."""
    out = without_repeats(keyed(docs), Dealing(byte_units(k, m), k, m), _repeats(k), _keep,
                          "n_bytes long, n_removed long, n_spans long, kept binary", **options)
    return out.withColumn("doc_id", real_id())


SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
b AS (SELECT doc_id, j, substr(h, 1024 * j + 1, 1122) AS x FROM (SELECT doc_id, h, unnest(range(0, len(h) // 1024 + 1)) AS j FROM d)),
s AS (SELECT doc_id, 512 * j + o AS i, substr(x, 2 * o + 1, 100) AS w
      FROM (SELECT *, unnest(range(0, least(512, len(x) // 2 - 49))) AS o FROM b WHERE len(x) >= 100)),
f AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY w) < doc_id AS again FROM s),
r AS (SELECT doc_id, i, i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS gap FROM f WHERE again),
q AS (SELECT doc_id, i, sum(CASE WHEN gap <= 50 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM r),
p AS (SELECT doc_id, min(i) AS a, max(i) + 50 AS z FROM q GROUP BY doc_id, run),
g AS (SELECT doc_id, a, z, coalesce(lag(z) OVER o, 0) AS before, row_number() OVER (PARTITION BY doc_id ORDER BY a DESC) = 1 AS final FROM p WINDOW o AS (PARTITION BY doc_id ORDER BY a)),
k AS (SELECT g.doc_id, sum(z - a) AS gone, count(*) AS n, string_agg(substr(h, 2 * before + 1, 2 * (a - before)) || CASE WHEN final THEN substr(h, 2 * z + 1) ELSE '' END, '' ORDER BY a) AS kept
      FROM g JOIN d USING (doc_id) GROUP BY g.doc_id)
SELECT doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(gone, 0)::BIGINT AS n_removed, coalesce(n, 0)::BIGINT AS n_spans,
       sha256(unhex(CASE WHEN n IS NULL THEN h ELSE kept END)) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""
