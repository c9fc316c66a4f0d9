"""Record shapes.

Raw and routed logs are schemaless JSON objects: they are held as one
``VARIANT`` column (``rec``) so unknown keys and nesting survive untouched.
Typed schemas below are for the relations whose columns the reference fixes.
"""

from pyspark.sql import types as T

# Page log as the keyword job declares it: maps of strings plus epoch ms.
PAGE_LOG_DDL = "common map<string,string>, page map<string,string>, ts bigint"
PAGE_LOG = T.StructType([
    T.StructField("common", T.MapType(T.StringType(), T.StringType())),
    T.StructField("page", T.MapType(T.StringType(), T.StringType())),
    T.StructField("ts", T.LongType()),
])

# Config row (one per source table) and its changelog envelope.
TABLE_PROCESS = T.StructType([
    T.StructField("source_table", T.StringType()),
    T.StructField("sink_table", T.StringType()),
    T.StructField("sink_columns", T.StringType()),
    T.StructField("sink_pk", T.StringType()),
    T.StructField("sink_extend", T.StringType()),
])
CONFIG_CHANGE = T.StructType([
    T.StructField("op", T.StringType()),
    T.StructField("before", TABLE_PROCESS),
    T.StructField("after", TABLE_PROCESS),
    T.StructField("ts_ms", T.LongType()),
])

# Keyword window result, in declaration order (the append sink binds by it).
KEYWORD_BEAN = T.StructType([
    T.StructField("stt", T.StringType()),
    T.StructField("edt", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("keyword", T.StringType()),
    T.StructField("keyword_count", T.LongType()),
    T.StructField("ts", T.LongType()),
])

# Dictionary lookup table.
BASE_DIC = T.StructType([
    T.StructField("dic_code", T.StringType()),
    T.StructField("dic_name", T.StringType()),
    T.StructField("parent_code", T.StringType()),
    T.StructField("create_time", T.TimestampType()),
    T.StructField("operate_time", T.TimestampType()),
])

# Raw log as read from a source: the text and its arrival position.
RAW_LOG = T.StructType([
    T.StructField("value", T.StringType()),
    T.StructField("seq", T.LongType()),
])
