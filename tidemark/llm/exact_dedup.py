"""Exact dedup by content-defined chunk recipes.

A text is normalised (white-space runs become one blank) and cut into chunks
where a hash of the last eight bytes hits a mask, so equal stretches of text
are cut alike wherever they lie. Every distinct chunk gets one identifier, a
64-bit hash that is *verified*: the distinct (hash, chunk) pairs are counted
per hash, and chunks that share a hash get further numbers. A document is then
its recipe, the ordered list of identifiers; equal recipes are equal texts.

What moves: each distinct chunk once per map task, to be verified; after that
only recipes (8 bytes per chunk). Long documents are never compared or moved
as wholes. Groups are counted with partial aggregates, and the way back is a
join on salted recipes, so a hot group of copies is not one task's.

Null texts count as empty; an empty text has the empty recipe. Null doc_ids
come after all others when the kept row is chosen. Rows that repeat a doc_id
with the same text, all are marked kept by exact_groups (they are one document);
drop_copies leaves one of them. A text of any length is cut into chunks whole. An empty table gives
no rows. Only doc_id and text are read by exact_groups; drop_copies carries all columns along, so names can't clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import keep_rows, keyed, one_spaced, real_id, spread_join

#: A boundary falls on one byte in 1,024; chunks have 256 to 8,192 bytes.
MASK, LEAST, MOST = 1023, 256, 8192


def cut_points(data: bytes, mask: int = MASK, least: int = LEAST, most: int = MOST) -> list[int]:
    """Ends of the chunks of ``data``, the last being its length."""
    n = len(data)
    if n <= least:
        return [n] if n else []
    found = []
    for at in range(0, n - 7, 1 << 20):  # a window of the text at a time
        v = np.ndarray((min(1 << 20, n - 7 - at),), "<u8", data, at, (1,))
        h = (v * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)
        found.append(np.flatnonzero((h & np.uint64(mask)) == 0) + (at + 8))
    ends, last = [], 0
    for p in np.concatenate(found).tolist():
        while p - last > most:
            last += most
            ends.append(last)
        if p - last >= least and p < n:
            ends.append(p)
            last = p
    while n - last > most:
        last += most
        ends.append(last)
    return ends + [n]


def chunks(data: bytes) -> list[bytes]:
    at, out = 0, []
    for end in cut_points(data):
        out.append(data[at:end])
        at = end
    return out


def chunk_hash(chunk: bytes, bits: int) -> int:
    return xxhash.xxh3_64_intdigest(chunk) >> (64 - bits) if bits < 64 else \
        xxhash.xxh3_64_intdigest(chunk) - (1 << 63)


def _distinct_chunks(bits: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            seen = {c for t in b["text"] for c in chunks(one_spaced(t.encode()))}
            yield pd.DataFrame({"h": [chunk_hash(c, bits) for c in seen], "chunk": list(seen)})
    return run


def _recipes(bits: int, shared: dict[int, dict[bytes, int]]):
    """``shared``: for hashes of several chunks, the number of each chunk."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            ids, sha = [], []
            for t in b["text"]:
                data = one_spaced(t.encode())
                sha.append(hashlib.sha256(data).hexdigest())
                own = []
                for c in chunks(data):
                    own.append(h := chunk_hash(c, bits))
                    if h in shared:
                        own.append(shared[h][c])
                ids.append(own)
            yield pd.DataFrame({"doc_id": b["doc_id"], "tag": b["tag"], "recipe": ids, "text_sha256": sha})
    return run


#: Chunks that share a hash are told to the tasks as a table of at most so many.
MOST_SHARED = 100_000


def _shared(d: DataFrame, bits: int) -> dict[int, dict[bytes, int]]:
    """Numbers of the chunks whose hash is not theirs alone. Random 64-bit
    hashes of 10**11 chunks (100 TB) give some 270 such pairs."""
    verified = d.select("text").mapInPandas(_distinct_chunks(bits), "h long, chunk binary").distinct()
    twice = verified.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("h")
    bad = [r["h"] for r in twice.limit(MOST_SHARED + 1).collect()]
    if len(bad) > MOST_SHARED:
        raise ValueError(f"over {MOST_SHARED} chunk hashes are not unique; use more bits")
    out: dict[int, dict[bytes, int]] = {}
    if bad:
        for r in verified.filter(F.col("h").isin(bad)).collect():
            out.setdefault(r["h"], {})[bytes(r["chunk"])] = 0
        for same in out.values():
            for k, c in enumerate(sorted(same)):
                same[c] = k
    return out


def recipes(docs: DataFrame, bits: int = 64) -> DataFrame:
    """doc_id (null: NO_ID), tag, recipe array<long>, text_sha256 of every row.

    ``bits`` shortens the chunk hash (tests use it to force collisions).
    """
    d = keyed(docs)
    return d.mapInPandas(_recipes(bits, _shared(d, bits)),
                         "doc_id long, tag long, recipe array<long>, text_sha256 string")


def _grouped(docs: DataFrame, bits: int) -> DataFrame:
    r = recipes(docs, bits)
    g = r.groupBy("recipe").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    # a group of copies may hold a third of all rows
    return spread_join(r, g, "recipe", "doc_id")


def exact_groups(docs: DataFrame, bits: int = 64) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    return _grouped(docs, bits).select(
        real_id().alias("doc_id"), real_id("keep_id").alias("keep_id"), "group_size",
        (F.col("doc_id") == F.col("keep_id")).alias("kept"), "text_sha256")


def drop_copies(docs: DataFrame, bits: int = 64) -> DataFrame:
    """The kept row of every group of equal texts, with all its columns. Rows
    that repeat both doc_id and text are one document: one row stays."""
    return keep_rows(docs, _grouped(docs, bits).filter("doc_id = keep_id"))
