"""Line dedup by a segment-partition edit join.

Lines are what ``\\n`` separates; blank ones are left alone. A line goes if the
same line, or one at most ``edits`` character edits away, has an earlier place
(smaller doc_id, then position), judged on the input. How many edits two lines may be
apart is decided by the longer of them (``ALLOWED``): 2 from 12 characters on, 1 from 6 on, none
below, where one edit in five characters makes another word of most lines.
Every line that can have a partner takes part in the join.

Join. A line of length l is split into edits + 1 even segments, so a line
within ``edits`` of it holds one of them unchanged, at a place that shifts by
no more than the edits allow on either side (multi-match-aware windows). The
index has one entry (length, segment number, segment) for each segment; a line
probes the lengths from its own down to ``edits`` less, with the substrings of those
windows. Pairs that meet are verified with a banded bit-parallel edit distance:
one column of 2 * edits + 1 cells is a few bits of a long, moved by additions and
shifts.

Hot segments. A segment shared by more than ``HOT`` lines makes no pairs. Its
lines are taken further: without the segment they are still within the same
edits, so what is left of them is split and probed again under the segment's
key, until no key is hot or no more than ``edits`` characters are left. Lines that still
share a key then differ in those characters only: their number is bounded by
the alphabet, not by the corpus, and they are compared pair by pair. No key is
capped.

Shared segments. Lines of a key that more than ``WARM`` lines share bring a mark of 64 bits: which
pairs of neighbouring characters, by hash, they hold an odd number of times. An edit
changes four pairs at most, so lines whose marks differ in more than 4 * edits bits are further apart
and never leave the join as a pair: lines that have only most of their words in common make no rows. What
passes is verified like all pairs.

Only DataFrame expressions are used. Distinct lines are told apart by their
text; where only their keys travel, by two hashes (96 bits). Null texts count
as empty. Null doc_ids come last. Rows that repeat a doc_id and a text are one document. Of lines
that tie in doc_id the one in the smaller position comes first. A line of any length is one
line; an empty table gives no rows. Other columns are not read, so their names can't clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import cut, few, keyed, real_id, stored

#: (length, edits) from long to short: what two lines may be apart, by the longer one's length.
ALLOWED = ((12, 2), (6, 1))
#: Lines that may share a segment before they are taken further.
HOT = 200
#: Lines that may share a segment before their marks are compared first.
WARM = 16
#: Characters up to which Spark's own distance, which takes the square of them, is the faster one.
SHORT = 256
BLANK = r"^[\x20\x09-\x0D]*$"


def _shifts(i: int, less: int, edits: int) -> range:
    """Where segment i may lie in a line that is ``less`` characters longer."""
    return range(max(-i, less - (edits - i)), min(i, less + (edits - i)) + 1)


def _windows(lines: DataFrame, edits: int, probe: bool, fixed: bool = False) -> DataFrame:
    """``lines`` (with ``size``, the line's length) once for each segment
    (``probe``: for each place where the segment of a line that is ``less`` shorter may
    lie; ``fixed``: for the ``less`` the row has): with less, i, at, n."""
    which = [(less, i, shift) for less in range(edits + 1 if probe else 1) for i in range(edits + 1)
             for shift in (_shifts(i, less, edits) if probe else (0,))]
    each = F.array(*[F.struct(F.lit(a).alias("_less"), F.lit(b).alias("i"), F.lit(c).alias("_shift")) for a, b, c in which])
    x = lines.select("*", F.inline(each))
    x = x.filter(F.col("_less") == F.col("less")) if fixed else x.withColumn("less", F.col("_less"))
    # the other line's length and even segments, the last ones longer by one
    x = x.withColumn("other", F.col("size") - F.col("less"))
    x = x.withColumn("_short", F.floor(F.col("other") / (edits + 1)).cast("int"))
    x = x.withColumn("_plain", F.lit(edits + 1) - (F.col("other") - F.col("_short") * (edits + 1)))
    x = x.withColumn("at", F.col("_short") * F.col("i") + F.greatest(F.lit(0), F.col("i") - F.col("_plain")) + F.col("_shift"))
    x = x.withColumn("n", F.col("_short") + (F.col("i") >= F.col("_plain")).cast("int"))
    return x.filter((F.col("at") >= 0) & (F.col("at") + F.col("n") <= F.col("size")) & (F.col("other") > edits)).drop(
        "_less", "_shift", "_short", "_plain")


def _without(text: str) -> Column:
    """``text`` without its window at, n."""
    return F.concat(F.substring(text, F.lit(1), F.col("at")),
                    F.substring(text, F.col("at") + F.col("n") + 1, F.lit(2**31 - 1)))


def _key(text: str, *parent: str) -> Column:
    return F.xxhash64(*parent, "other", "i", F.substring(text, F.col("at") + 1, F.col("n")))


def edit_distance(a: Column, b: Column, edits: int) -> Column:
    """The edit distance of the character arrays a and b (columns) if it is at most
    ``edits`` (and their sizes differ by no more), else something greater.

    Bit k of a column's words stands for row j - edits + k. ``plus`` and
    ``minus`` mark rows one more or one less than the row above; ``far`` is the
    distance at the band's lowest row.
    """
    width = 2 * edits + 1
    full = F.lit((1 << width) - 1).cast("long")

    def column(acc: Column, j: Column) -> Column:
        c = F.element_at(b, j)
        same = F.lit(0).cast("long")
        for k in range(width):
            row = j - 1 - edits + k  # from 0
            hit = F.coalesce((row >= 0) & (F.get(a, row) == c), F.lit(False))
            same = same.bitwiseOR(F.when(hit, F.lit(1 << k).cast("long")).otherwise(F.lit(0).cast("long")))
        return F.struct(acc["plus"].alias("plus"), acc["minus"].alias("minus"), acc["far"].alias("far"), same.alias("same"))

    def move(s: Column) -> Column:
        plus, minus, same = s["plus"], s["minus"], s["same"]
        diagonal = (same.bitwiseAND(plus) + plus).bitwiseXOR(plus).bitwiseOR(same).bitwiseOR(minus).bitwiseAND(full)
        return F.struct(plus.alias("plus"), minus.alias("minus"), s["far"].alias("far"), diagonal.alias("d"))

    def turn(s: Column) -> Column:
        plus, minus, d = s["plus"], s["minus"], s["d"]
        right = minus.bitwiseOR(F.bitwise_not(d.bitwiseOR(plus))).bitwiseAND(full)
        left = d.bitwiseAND(plus)
        down = F.shiftright(d, 1)
        far = s["far"] + F.when(d.bitwiseAND(F.lit(1 << (width - 1)).cast("long")) == 0, 1).otherwise(0)
        return F.struct(left.bitwiseOR(F.bitwise_not(down.bitwiseOR(right))).bitwiseAND(full).alias("plus"),
                        down.bitwiseAND(right).alias("minus"), far.alias("far"))

    # each step names its intermediate words by passing them through a one-row transform
    def step(acc: Column, j: Column) -> Column:
        one = F.transform(F.array(column(acc, j)), move)
        return F.element_at(F.transform(one, turn), 1)

    start = F.struct(F.lit(((1 << (edits + 1)) - 1) << edits).cast("long").alias("plus"), F.lit(0).cast("long").alias("minus"),
                     F.lit(edits).alias("far"))
    end = F.aggregate(F.sequence(F.lit(1), F.size(b)), start, step)

    def result(e: Column) -> Column:
        out = e["far"]
        for k in range(2 * edits):  # rows between a's end and the band's lowest
            below = F.lit(k) >= F.size(a) - F.size(b) + edits
            out = out - F.when(below, F.shiftright(e["plus"], k).bitwiseAND(F.lit(1).cast("long"))
                               - F.shiftright(e["minus"], k).bitwiseAND(F.lit(1).cast("long"))).otherwise(0)
        return out

    found = F.element_at(F.transform(F.array(end), result), 1)
    return F.when(F.abs(F.size(a) - F.size(b)) > edits, F.lit(edits + 1)).when(F.size(b) == 0, F.size(a)).otherwise(found)


def _characters(text: str) -> Column:
    return F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0))


def _mark(text: str) -> Column:
    """A bit for each of 64 hash values: whether ``text`` holds an odd number of pairs of
    neighbouring characters of that hash. An edit takes or adds four pairs at most."""
    each = F.regexp_extract_all(text, F.lit("(?s)(?=(..))."), F.lit(1))
    return F.aggregate(each, F.lit(0).cast("long"), lambda mark, x: mark.bitwiseXOR(F.call_function(
        "shiftleft", F.lit(1).cast("long"), F.pmod(F.xxhash64(x), F.lit(64)).cast("int"))))


def _holds_most(edits: int, parts: int = 8) -> Column:
    """Whether line_b holds all but ``edits`` of ``parts`` even parts of line_a: no
    edit spoils two, so lines without them are further apart."""
    n = F.floor(F.col("size_a") / parts).cast("int")
    held = F.lit(0)
    for i in range(parts):
        held = held + F.contains("line_b", F.substring("line_a", n * i + 1, n)).cast("int")
    return held >= parts - edits


def _without_ends(pairs: DataFrame, steps: int = 6) -> DataFrame:
    """``pairs`` with rest_a, rest_b: line_a and line_b without (most of) what they begin and
    end with alike, which leaves their distance as it is. Halves, quarters and so on are compared."""
    p = pairs.select("*", F.col("line_a").alias("rest_a"), F.col("line_b").alias("rest_b"))
    for tail in (False, True):
        for k in range(1, steps + 1):
            n = F.floor(F.least("size_a", "size_b") / 2**k).cast("int")

            def end(c: str) -> Column:
                return F.substring(c, -n if tail else F.lit(1), n)

            def other(c: str) -> Column:
                return F.substring(c, F.lit(1) if tail else n + 1, F.length(c) - n)

            same = end("rest_a") == end("rest_b")
            p = p.withColumns({c: F.when(same, other(c)).otherwise(F.col(c)) for c in ("rest_a", "rest_b")})
    return p


def within(pairs: DataFrame, edits: int) -> DataFrame:
    """The ``pairs`` (line_a, size_a, line_b, size_b, most) that are at most ``most`` (up to ``edits``) edits apart."""
    p = _without_ends(pairs)
    long = F.greatest(F.length("rest_a"), F.length("rest_b")) > SHORT
    # a one-row generator: the characters are listed once, not wherever the distance names them
    p = p.select("*", F.inline(F.array(F.struct(F.when(long, _characters("rest_a")).alias("chars_a"),
                                                F.when(long, _characters("rest_b")).alias("chars_b")))))
    near = F.levenshtein("rest_a", "rest_b", edits)
    return p.filter(F.when(F.col("chars_a").isNull(), (near >= 0) & (near <= F.col("most")))
                    .otherwise(edit_distance(F.col("chars_a"), F.col("chars_b"), edits) <= F.col("most")))


def distinct_lines(docs: DataFrame) -> DataFrame:
    """line, h, g (its hashes), size, place (its first doc_id, tag and position) of
    every line that is not blank; ``docs`` as from :func:`keyed`."""
    each = docs.select("doc_id", "tag", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    each = each.filter(~F.col("line").rlike(BLANK))
    d = each.groupBy("line").agg(F.min(F.struct("doc_id", "tag", "pos")).alias("place"))
    return d.select("line", F.xxhash64("line").alias("h"), F.hash("line").alias("g"), F.length("line").alias("size"), "place")


def allowed_edits(longer: Column, allowed: tuple) -> Column:
    out = F.lit(0)
    for length, edits in sorted(allowed):
        out = F.when(longer >= length, F.lit(edits)).otherwise(out)
    return out


def near_lines(lines: DataFrame, allowed: tuple = ALLOWED, hot: int = HOT, warm: int = WARM) -> DataFrame:
    """h, g of the lines that are within the edits allowed of one with an earlier place."""
    edits = max(e for _, e in allowed)
    # a partner of the shortest lines that may differ at all is shorter by the edits
    some = lines.filter(F.col("size") >= min(length - e for length, e in allowed))
    pairs = []

    def meet(index: DataFrame, probe: DataFrame) -> None:
        marked = ["mark"] if "mark" in index.columns else []
        i = index.select("key", F.col("h").alias("a"), *[F.col(c).alias("mark_a") for c in marked])
        p = probe.select("key", F.col("h").alias("b"), "less", *[F.col(c).alias("mark_b") for c in marked])
        met = i.join(p.hint("merge"), "key").filter(
            (F.col("a") < F.col("b")) | ((F.col("less") > 0) & (F.col("a") != F.col("b"))))
        if marked:
            met = met.filter(F.bit_count(F.col("mark_a").bitwiseXOR(F.col("mark_b"))) <= 4 * edits)
        pairs.append(met.select("a", "b"))

    def taken_apart(index: DataFrame, probe: DataFrame, most: int = hot) -> tuple[DataFrame, DataFrame] | None:
        """Adds the pairs of keys that at most ``most`` lines share; the entries of the others."""
        many = cut(index.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > most).select("key"))
        meet(index.join(many, "key", "left_anti"), probe)
        if many.isEmpty():
            return None
        many = few(many)
        return index.join(many, "key", "left_semi"), probe.join(many, "key", "left_semi")

    text = some.filter(F.col("size") > edits).select("h", "line", "size")

    def first(probe: bool) -> DataFrame:
        return _windows(text, edits, probe).select("h", _key("line").alias("key"), "less", "at", "n")

    index = probe = p = None
    left = taken_apart(first(False), first(True), min(warm, hot))
    if left is not None:
        # the mark is made once for each line, and only of those that share such a segment
        index, probe = (cut(x) for x in left)
        wanted = cut(index.select("h").union(probe.select("h")).distinct())
        shared = cut(some.join(few(wanted), "h", "left_semi").select("h", "line", _mark("line").alias("mark")))
        marks = few(shared.select("h", "mark"))
        left = taken_apart(*(cut(x.join(marks, "h")) for x in (index, probe)))
    if left is not None:
        # what is left of the lines themselves, without the segment they share
        index, probe = (cut(x.join(shared.select("h", "line"), "h").select(
            "h", "key", "less", "mark", _without("line").alias("rest")).withColumn("size", F.length("rest"))) for x in left)
    while left is not None:
        # rests of up to ``edits`` characters are not divided further: the lines
        # of such a key differ nowhere else, so they are few, and make pairs
        short = F.col("size") - F.col("less") <= edits
        meet(index.filter(short), probe.filter(short))
        index, probe = (
            _windows(x.filter(~short), edits, is_probe, fixed=True)
            .select("h", _key("rest", "key").alias("key"), "less", "mark", _without("rest").alias("rest"))
            .withColumn("size", F.length("rest")) for x, is_probe in ((index, False), (probe, True)))
        index, probe = cut(index), cut(probe)
        left = taken_apart(index, probe)
        if left is not None:
            index, probe = cut(left[0]), cut(left[1])
    met = pairs[0]
    for p in pairs[1:]:
        met = met.union(p)
    met = cut(met.distinct())
    # only the lines of some pair are fetched, once; the others stay where they are while those are few
    wanted = cut(met.select(F.col("a").alias("h")).union(met.select("b")).distinct())
    side = cut(lines.join(few(wanted), "h", "left_semi").select("h", "g", "place", "size", "line"))
    met = (met.join(side.select(*[F.col(c).alias(f"{c}_a") for c in side.columns]), F.col("a") == F.col("h_a"))
           .join(side.select(*[F.col(c).alias(f"{c}_b") for c in side.columns]), F.col("b") == F.col("h_b"))
           .filter("line_a <> line_b").withColumn("most", allowed_edits(F.greatest("size_a", "size_b"), allowed))
           .filter(_holds_most(edits)))
    close = within(met, edits)
    later = F.when(F.col("place_a") < F.col("place_b"), F.struct(F.col("h_b").alias("h"), F.col("g_b").alias("g"))) \
        .otherwise(F.struct(F.col("h_a").alias("h"), F.col("g_a").alias("g")))
    return close.select(later.alias("l")).select("l.*").distinct()


def dedup_lines(docs: DataFrame, allowed: tuple = ALLOWED, hot: int = HOT) -> DataFrame:
    """doc_id, n_lines (not blank), n_removed, kept (the lines left, and the
    blank ones, joined by ``\\n``) of every row."""
    d = keyed(docs)
    lines = stored(distinct_lines(d))
    near = cut(near_lines(lines, allowed, hot))
    # Each line stays where it comes first, so what a document keeps is known
    # without looking up every line of every document.
    stays = (lines.select("h", "g", "place").join(near, ["h", "g"], "left_anti")
             .groupBy(F.col("place.doc_id").alias("doc_id"), F.col("place.tag").alias("tag"))
             .agg(F.collect_list("place.pos").alias("stays")))
    j = d.join(stays.hint("merge"), ["doc_id", "tag"], "left")
    all_lines = F.split("text", "\n")
    blank = F.filter(F.transform(all_lines, lambda x, i: F.when(x.rlike(BLANK), i)), lambda i: i.isNotNull())
    j = j.select("doc_id", all_lines.alias("l"), F.coalesce("stays", F.array().cast("array<int>")).alias("stays"), blank.alias("blank"))
    own = F.array_sort(F.concat("stays", "blank"))
    return j.select(real_id().alias("doc_id"), (F.size("l") - F.size("blank")).cast("long").alias("n_lines"),
                    (F.size("l") - F.size("blank") - F.size("stays")).cast("long").alias("n_removed"),
                    F.array_join(F.transform(own, lambda i: F.element_at("l", i + 1)), "\n").alias("kept"))
