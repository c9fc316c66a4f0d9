"""Small constant relations (config changelog, code dictionary, markers).

Built from literals on the JVM side in one partition, so they need no
Python worker and no RDD scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T


def literal_frame(spark: SparkSession, rows, schema: T.StructType | str) -> DataFrame:
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    fields = schema.fields
    structs = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(r, fields)])
               for r in rows]
    if not structs:
        return spark.createDataFrame([], schema)
    return spark.range(1, numPartitions=1).select(F.inline(F.array(*structs)))
