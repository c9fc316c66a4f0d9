"""Substring dedup over word windows by super-k-mer partitioning.

Words are maximal runs of other characters than white space, a window is 13
consecutive words of one document. Consecutive windows with the same minimiser
(the four-word gram of least hash) travel as one packed string to the
minimiser's bucket, see :mod:`.windows`; there the windows of strings that
share a minimiser are sorted as texts, and equal neighbours are counted
exactly. A word goes if a window over it also starts in a document with a
smaller doc_id, judged on the input.

Null and empty texts have no words. Null doc_ids come after all others and
repeat each other nothing. Rows that repeat a doc_id are as one document: they
never make each other's windows repeats; of equal doc_ids none is smaller. Texts of any length are read
whole, in blocks that overlap by a window. An empty table gives no rows. Other columns than doc_id and text are
not read, so their names can't clash.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from .common import keyed, real_id
from .windows import Dealing, covered, without_repeats, word_units

K, M = 13, 4


def _repeats(k: int):
    def run(strings: list[bytes], group: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rows = []
        for i, (s, g, d) in enumerate(zip(strings, group.tolist(), doc.tolist())):
            at = [0]
            while (nxt := s.find(b" ", at[-1])) >= 0:
                at.append(nxt + 1)
            at.append(len(s) + 1)
            for j in range(len(at) - k):
                rows.append((g, s[at[j]:at[j + k] - 1], d, i, j))
        rows.sort()
        which, window, last, least = [], [], None, 0
        for g, s, d, i, j in rows:
            if last != (g, s):
                last, least = (g, s), d
            elif d > least:
                which.append(i)
                window.append(j)
        return np.array(which, np.int64), np.array(window, np.int64)
    return run


def _keep(text: bytes, ranges: np.ndarray) -> tuple[int, int, str]:
    words = text.split()
    n = len(words)
    if len(ranges):
        words = [words[i] for i in np.flatnonzero(~covered(n, ranges)).tolist()]
    return n, n - len(words), b" ".join(words).decode()


def dedup_substrings(docs: DataFrame, k: int = K, m: int = M, **options) -> DataFrame:
    """doc_id, n_words, n_removed, kept (the words left, joined by blanks)."""
    out = without_repeats(keyed(docs), Dealing(word_units(k, m), k, m), _repeats(k), _keep,
                          "n_words long, n_removed long, kept string", **options)
    return out.withColumn("doc_id", real_id())


SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13),
n AS (SELECT doc_id, i, list_slice(w, i, i + 12) AS g FROM s),
f AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY g) < doc_id AS again FROM n),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM f WHERE again),
x AS (SELECT doc_id, list(p) AS gone FROM c GROUP BY doc_id),
k AS (SELECT d.doc_id, len(w) AS n, CASE WHEN len(w) = 0 THEN [] WHEN gone IS NULL THEN w
        ELSE list_filter(w, lambda v, i: NOT list_contains(gone, i)) END AS kept FROM d LEFT JOIN x USING (doc_id))
SELECT doc_id, n::BIGINT AS n_words, (n - len(kept))::BIGINT AS n_removed, sha256(array_to_string(kept, ' ')) AS kept_sha256 FROM k
"""
