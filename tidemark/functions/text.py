"""String helpers (F6, F8) and the keyword tokenizer."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

# Fixed value: a token is a maximal run of Unicode letters or digits, taken
# from the lower-cased text. This replaces the reference's dictionary
# segmenter (not available here); see README "Re-aimed".
TOKEN_PATTERN = r"[\p{L}\p{N}]+"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_empty(c) -> Column:
    """null or the empty string."""
    return F.coalesce(_c(c), F.lit("")) == F.lit("")


def tokens(text, pattern: str = TOKEN_PATTERN) -> Column:
    """Tokens of ``text`` in text order, duplicates kept.

    A JVM expression (``regexp_extract_all``), so it stays inside whole-stage
    codegen; the whole text is tokenised.
    """
    return F.regexp_extract_all(F.lower(_c(text)), F.lit(pattern), F.lit(0))


def split_list(c, sep: str = ",") -> Column:
    """F8: split a separated list exactly (no trimming)."""
    return F.split(_c(c), sep, -1)


def register_tokenizer(spark, name: str = "ik_analyze") -> None:
    """U1 by name, for SQL written against a registered table function:
    ``SELECT keyword FROM t, LATERAL ik_analyze(fullword)``.

    A SQL table function over the JVM tokenizer, so Catalyst inlines it.
    """
    if not re.fullmatch(r"\w+", name):
        raise ValueError(f"not a function name: {name!r}")
    pattern = TOKEN_PATTERN.replace("\\", "\\\\")
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {name}(fullword STRING) RETURNS TABLE (keyword STRING)
        RETURN SELECT explode(regexp_extract_all(lower(fullword), '{pattern}', 0))""")
