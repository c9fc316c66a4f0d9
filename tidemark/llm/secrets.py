"""Secret scans with a trigram inverted index.

Each rule is a regular expression. From its parse, a Boolean trigram query is
derived: an OR of alternatives, each an AND of trigrams that every match must
hold (letters in lower case). The index has one posting (trigram, doc_id) for
every document that holds a trigram of some query. The postings of each
alternative are intersected, the documents left are the rule's candidates, and
only they are searched with the expression. A rule without mandatory trigrams
(a class repeated, say) scans every text.

Everything runs as DataFrame expressions. Matches are found with ``split`` and
``regexp_extract_all``: the pieces between matches and the matches themselves
give every match's place, in code points. Java's expressions and the trigram
analysis agree on the constructs that rules use (literals, classes, groups,
alternatives, repeats, ASCII case).

Null texts count as empty; empty texts hold nothing. Rows that share a doc_id
(or have none) share their candidates, which only adds texts to verify; each row is
searched on its own. A text of any length is searched whole, its time in proportion to its matches. Matches
that start at one place come in the order of the rules. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from re import _constants as rc, _parser as rp

from pyspark.sql import Column, DataFrame, functions as F

from .common import NO_ID, or_empty


@dataclass(frozen=True)
class Rule:
    """A kind of secret: its expression, and what a match must have: at least
    ``least`` characters in group ``group`` (0: the whole match)."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


# The base rules, in their order; fixed values.
ASSIGN = Rule("assign", r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6)
ACCESS = Rule("access", r"AKIA[A-Z0-9]+", 0, 20)
# A run of 24 or more is a match of [0-9a-f]+ that is long enough, and no other is.
HEX = Rule("hex", r"[0-9a-f]{24,}")
BASE = (ASSIGN, ACCESS, HEX)
#: Further kinds that the scan adds, by the public formats of their issuers.
MORE = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
)

#: Alternatives of a query at most; beyond it a part of a rule counts as anything.
ALTERNATIVES = 64


def _fold(c: int) -> str | None:
    return chr(c).lower() if c < 128 else None


def _strings(parsed) -> set[str] | None:
    """All strings a parsed expression matches, folded; None if many."""
    out = {""}
    for op, arg in parsed:
        if op is rc.LITERAL:
            one = {_fold(arg)}
        elif op is rc.IN and all(o is rc.LITERAL for o, _ in arg):
            one = {_fold(a) for _, a in arg}
        elif op is rc.SUBPATTERN:
            one = _strings(arg[3])
        elif op is rc.BRANCH:
            each = [_strings(b) for b in arg[1]]
            one = None if None in each else set().union(*each)
        elif op is rc.MAX_REPEAT and arg[1] == 1:
            one = _strings(arg[2])
            if one is not None and arg[0] == 0:
                one = one | {""}
        else:
            one = None
        if one is None or None in one or len(out) * len(one) > ALTERNATIVES:
            return None
        out = {a + b for a in out for b in one}
    return out


def _grams(s: str) -> frozenset[str]:
    return frozenset(s[i:i + 3] for i in range(len(s) - 2))


def _minimal(alternatives: set[frozenset[str]]) -> set[frozenset[str]]:
    return {a for a in alternatives if not any(b < a for b in alternatives)}


def _both(a: set[frozenset[str]], b: set[frozenset[str]]) -> set[frozenset[str]]:
    both = _minimal({x | y for x in a for y in b})
    return both if len(both) <= ALTERNATIVES else min(a, b, key=len)


ANY: set[frozenset[str]] = {frozenset()}


def _query(parsed) -> set[frozenset[str]]:
    """Alternatives of trigrams for a parsed expression."""
    out, run = set(ANY), []

    def close() -> None:
        nonlocal out
        if run:
            s = _strings(run)
            if s is not None:
                out = _both(out, _minimal({_grams(x) for x in s}))
            run.clear()

    for item in parsed:
        if _strings([*run, item]) is not None:  # still a few fixed strings
            run.append(item)
            continue
        close()
        op, arg = item
        if _strings([item]) is not None:
            run.append(item)
        elif op is rc.SUBPATTERN:
            out = _both(out, _query(arg[3]))
        elif op is rc.BRANCH:
            each = set().union(*(_query(b) for b in arg[1]))
            out = _both(out, _minimal(each) if len(each) <= ALTERNATIVES else ANY)
        elif op in (rc.MAX_REPEAT, rc.MIN_REPEAT) and arg[0] > 0:
            out = _both(out, _query(arg[2]))
    close()
    return out


def trigram_query(pattern: str) -> list[list[str]]:
    """The OR of ANDs of trigrams that every match of ``pattern`` satisfies;
    empty if nothing is mandatory."""
    q = _query(rp.parse(pattern, re.ASCII))
    return [] if frozenset() in q else sorted(sorted(x) for x in q)


def postings(docs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """The index: trigram, doc_id (null: NO_ID), for the trigrams of the rules' queries."""
    grams = sorted({g for r in rules for alt in trigram_query(r.pattern) for g in alt})
    folded = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"),
                         F.lower(or_empty()).alias("folded"))
    held = F.filter(F.array(*[F.lit(g) for g in grams]), lambda g: F.contains("folded", g)) if grams \
        else F.array().cast("array<string>")
    return folded.select("doc_id", F.explode(held).alias("trigram"))


def candidates(index: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """doc_id, kinds: the rules for which a document holds all trigrams of
    some alternative."""
    terms = [(r.kind, n, g, len(alt)) for r in rules for n, alt in enumerate(trigram_query(r.pattern)) for g in alt]
    q = index.sparkSession.createDataFrame(terms, "kind string, alternative int, trigram string, need int")
    hit = (index.distinct().join(F.broadcast(q), "trigram")  # as many rows as the rules have trigrams
           .groupBy("doc_id", "kind", "alternative", "need").agg(F.count(F.lit(1)).alias("has"))
           .filter("has = need"))
    return hit.groupBy("doc_id").agg(F.collect_set("kind").alias("kinds"))


def spans(rule: Rule, text: Column) -> Column:
    """array<struct<start, end, kind, nth>> of the rule's matches in ``text``, code
    points, end exclusive; matches that are too short are dropped afterwards."""
    pattern = F.lit(rule.pattern)
    found, between = F.regexp_extract_all(text, pattern, F.lit(0)), F.split(text, rule.pattern, -1)
    sizes = F.transform(found, F.length)
    tested = F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), F.length)
    gaps = F.slice(F.transform(between, F.length), 1, F.size(found))
    parts = F.zip_with(F.arrays_zip(gaps.alias("gap"), sizes.alias("size")), tested, lambda g, t: F.struct(
        (g["gap"] + g["size"]).alias("step"), g["size"].alias("size"), t.alias("tested")))
    return F.filter(_placed(parts, rule.kind), lambda x: x["size"] >= rule.least)


def _total(steps: Column) -> Column:
    return F.aggregate(steps, F.lit(0), lambda acc, x: acc + x["step"])


def _placed(parts: Column, kind: str, block: int = 128) -> Column:
    """array<struct<start, end, kind, size>> of matches (step: to the match's end from the
    last one's, size, tested). Running sums in two levels, so that a text with very many
    matches costs in proportion to them: the ends of blocks, then the places in a block. Every
    level is bound by a transform over one element, or its expression would be evaluated anew for each match."""
    def with_ends(s: Column) -> Column:
        n = F.size(s["p"])
        sums = F.transform(F.when(n > 0, F.sequence(F.lit(0), n - 1, F.lit(block))).otherwise(F.array().cast("array<int>")),
                           lambda at: _total(F.slice(s["p"], at + 1, F.lit(block))))
        ends = F.aggregate(sums, F.array(F.lit(0)), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)))
        return F.struct(s["p"].alias("p"), ends.alias("ends"))

    def place(s: Column) -> Column:
        def one(x: Column, i: Column) -> Column:
            nth = F.floor(i / block).cast("int")
            end = F.get(s["ends"], nth) + _total(F.slice(s["p"], nth * block + 1, i - nth * block + 1))
            return F.struct((end - x["size"]).alias("start"), end.alias("end"), F.lit(kind).alias("kind"),
                            x["tested"].alias("size"))
        return F.transform(s["p"], one)

    bound = F.transform(F.array(F.struct(parts.alias("p"))), with_ends)
    return F.element_at(F.transform(bound, place), 1)


def scan(docs: DataFrame, rules: tuple[Rule, ...] = BASE + MORE) -> DataFrame:
    """doc_id, found array<struct<start, end, kind>> of every row, in the
    order of the rules."""
    kinds = candidates(postings(docs, rules), rules)
    d = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"), or_empty().alias("text"))
    d = d.join(kinds.hint("merge"), "doc_id", "left")
    none = F.array().cast("array<struct<start:int,end:int,kind:string,size:int>>")
    each = [F.when(F.array_contains("kinds", r.kind), spans(r, F.col("text"))).otherwise(none)
            if trigram_query(r.pattern) else spans(r, F.col("text")) for r in rules]
    return d.select(F.when(F.col("doc_id") != NO_ID, F.col("doc_id")).alias("doc_id"), F.concat(*each).alias("found"))


def listed(found: Column, rules: tuple[Rule, ...]) -> Column:
    """kind:start:end of the spans of ``rules``, by start and then kind, comma-joined."""
    order = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.kind), F.lit(i))])
    keyed = F.transform(F.filter(found, lambda x: x["kind"].isin([r.kind for r in rules])),
                        lambda x: F.struct(x["start"].alias("start"), order[x["kind"]].alias("k"), x["end"].alias("end"), x["kind"].alias("kind")))
    return F.array_join(F.transform(F.array_sort(keyed), lambda x: F.concat_ws(
        ":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def report(found: DataFrame, rules: tuple[Rule, ...] = BASE + MORE) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    def number(kind: str) -> Column:
        return F.size(F.filter("found", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    count = [number(r.kind) for r in BASE]
    return found.select("doc_id", *count, F.sha2(listed(F.col("found"), BASE).cast("binary"), 256).alias("base_sha256"),
                        listed(F.col("found"), rules).alias("spans"))


def sql(rules: tuple[Rule, ...] = BASE + MORE) -> str:
    """DuckDB SQL for the report: every rule over every text."""
    parts = []
    for i, r in enumerate(rules):
        p = r.pattern.replace("'", "''")
        parts.append(f"""SELECT doc_id, {i} AS k, '{r.kind}' AS kind, n, s AS size, t,
  list_sum(list_slice(gaps, 1, n)) + coalesce(list_sum(list_slice(sizes, 1, n - 1)), 0) AS start
FROM (SELECT doc_id, gaps, sizes, unnest(range(1, len(sizes) + 1)) AS n, unnest(sizes) AS s, unnest(tests) AS t FROM
  (SELECT doc_id, list_transform(regexp_split_to_array(text, '{p}'), lambda x: length(x)) AS gaps,
    list_transform(regexp_extract_all(text, '{p}'), lambda x: length(x)) AS sizes,
    list_transform(regexp_extract_all(text, '{p}', {r.group}), lambda x: length(x)) AS tests FROM d))
WHERE t >= {r.least}""")
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
m AS ({' UNION ALL '.join(parts)}),
j AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS a, count(*) FILTER (kind = 'access') AS b, count(*) FILTER (kind = 'hex') AS c,
  string_agg(kind || ':' || start::BIGINT || ':' || (start + size)::BIGINT, ',' ORDER BY start, k) FILTER (k < {len(BASE)}) AS base,
  string_agg(kind || ':' || start::BIGINT || ':' || (start + size)::BIGINT, ',' ORDER BY start, k) AS spans FROM m GROUP BY doc_id)
SELECT d.doc_id, coalesce(a, 0) AS n_assign, coalesce(b, 0) AS n_access, coalesce(c, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN j USING (doc_id)
"""
