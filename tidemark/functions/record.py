"""Schemaless JSON records.

A record is a ``MAP<STRING, VARIANT>`` of its top-level keys: nothing is lost
(unknown keys, nesting and number types survive), fields are read by path
with ``variant_get``, and edits are ``map_filter``/``transform_values``
instead of in-place mutation. ``to_json`` turns it back into text.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

REC_TYPE = "map<string,variant>"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def record_of(variant) -> Column:
    """Parsed JSON (variant) -> record map; NULL unless it is an object.
    Top-level JSON nulls are dropped, as a serializer that omits nulls would."""
    m = F.try_variant_get(_c(variant), "$", REC_TYPE)
    return F.map_filter(m, lambda k, v: v.isNotNull() & ~F.is_variant_null(v))


def parse_record(value) -> Column:
    """JSON text -> record map; NULL for anything that is not one complete
    JSON object (malformed, empty, NULL, a scalar or array)."""
    return record_of(F.try_parse_json(_c(value)))


def field(rec, path: str, type_: str = "string") -> Column:
    """Value at ``key[.sub...]`` of a record, cast to ``type_``; NULL when
    missing or of another shape."""
    key, _, rest = path.partition(".")
    return F.try_variant_get(_c(rec)[key], "$" + ("." + rest if rest else ""), type_)


def present(rec, key: str) -> Column:
    """Key exists with a non-null value."""
    return _c(rec)[key].isNotNull()


def string_map(v) -> Column:
    """Variant object -> ``map<string,string>``; nested values become JSON
    text (what a string-map table column shows)."""
    m = F.try_variant_get(_c(v), "$", REC_TYPE)
    return F.transform_values(
        m, lambda k, x: F.coalesce(F.try_variant_get(x, "$", "string"), F.to_json(x)))


def drop_keys(rec, *keys: str) -> Column:
    return F.map_filter(_c(rec), lambda k, v: ~k.isin(*keys))


def set_sub_field(rec, key: str, sub: str, json_value: str) -> Column:
    """Record with ``rec[key][sub]`` replaced by a JSON literal."""
    obj = F.try_variant_get(_c(rec)[key], "$", REC_TYPE)
    new_obj = F.to_variant_object(F.map_concat(
        F.map_filter(obj, lambda k, v: k != sub),
        F.create_map(F.lit(sub), F.parse_json(F.lit(json_value)))))
    return F.transform_values(
        _c(rec), lambda k, v: F.when(k == key, new_obj).otherwise(v))


def to_text(rec) -> Column:
    """Record -> JSON text."""
    return F.to_json(_c(rec))
