"""Lines of one group that differ in whole words leave the join as few pairs, and no near line is lost by that."""

from __future__ import annotations

import random

from pyspark.sql import functions as F
from test_line_distance import _distance
from tidemark.llm import line_dedup


def _group(r):
    """A line's copies, each with a word of its own, and a few that are one or two edits from another."""
    def word():
        return "".join(r.choice("abcdefghijklmnopqrstuvwxyzé漢😀") for _ in range(6))

    base, lines = [word() for _ in range(12)], []
    for k in range(48):
        own = list(base)
        own[k % 12] = word()
        lines.append(" ".join(own))
    for k in range(0, 48, 4):
        a = list(lines[k])
        for _ in range(1 + k % 2):
            at, what = r.randrange(len(a)), r.randrange(3)
            a[at:at + (what != 0)] = ["x"] if what < 2 else []
        lines.append("".join(a))
    return lines


def test_lines_that_differ_in_words_make_few_pairs(spark, monkeypatch):
    lines, seen, within = _group(random.Random(3)), [], line_dedup.within

    def counted(pairs, edits):
        seen.append(pairs.count())
        return within(pairs, edits)

    monkeypatch.setattr(line_dedup, "within", counted)
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    got = {x.doc_id for x in line_dedup.dedup_lines(docs).collect() if x.n_removed}
    want = {i for i, b in enumerate(lines) if any(_distance(a, b) <= 2 for a in lines[:i])}
    assert got == want and len(want) >= 10
    assert seen[0] < 200  # of 1,770 pairs


def test_an_edit_changes_four_bits_of_a_mark_at_most(spark):
    r, rows = random.Random(4), []
    for _ in range(300):
        a = [r.choice("ab漢😀\t ") for _ in range(r.randrange(1, 40))]
        b, at, what = list(a), r.randrange(len(a)), r.randrange(3)
        b[at:at + (what != 0)] = [r.choice("abé")] if what < 2 else []
        rows.append(("".join(a), "".join(b)))
    d = spark.createDataFrame(rows, "a string, b string").select(
        F.bit_count(line_dedup._mark("a").bitwiseXOR(line_dedup._mark("b"))).alias("n"))
    assert 0 < d.agg(F.max("n")).first()[0] <= 4
