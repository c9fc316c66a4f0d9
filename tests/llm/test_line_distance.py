"""The distance of paired lines: ends that are alike are taken off, whatever is left is compared exactly."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from tidemark.llm.line_dedup import SHORT, within


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_lines_within_edits_by_brute_force(spark):
    r, letters, rows = random.Random(5), "abé漢😀 ", []
    for size in [1, 2, 3, 5, 12, 31, 64, 130, SHORT + 40] * 30:
        a = "".join(r.choice(letters[:r.choice([1, 2, 6])]) for _ in range(size))
        b = list(a)
        for _ in range(r.randrange(5)):
            at, what = r.randrange(len(b) + 1), r.randrange(3)
            b[at:at + (what != 0)] = [r.choice(letters)] if what < 2 else []
        rows.append((len(rows), a, "".join(b), r.choice([0, 1, 2])))
    # differences at both ends: nothing is taken off
    middle = "x" * (SHORT + 50)
    rows += [(len(rows), "a" + middle + "b", "c" + middle + "d", 2), (len(rows) + 1, "a" + middle + "b", "c" + middle + "d", 1)]
    p = spark.createDataFrame(rows, "n long, line_a string, line_b string, most int")
    p = p.withColumns({"size_a": F.length("line_a"), "size_b": F.length("line_b")})
    got = {x.n for x in within(p, 2).collect()}
    want = {n for n, a, b, most in rows if _distance(a, b) <= most}
    assert got == want and 0 < len(want) < len(rows)
