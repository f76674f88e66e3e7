"""Small literal tables built on the JVM side.

``spark.createDataFrame(list_of_tuples)`` ships pickled rows through Python
workers (starting them if needed). Parameter tables here — a disease
signature, a gene list, a manifest — are a handful of literal rows, so they
are built as ``inline(array(struct(lit, ...)))``: a local relation that
never leaves the JVM.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def literal_rows(spark: SparkSession, rows: Sequence[Sequence], schema: T.StructType | str) -> DataFrame:
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    fields = schema.fields
    if not rows:
        return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in fields])
    structs = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, fields)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))
