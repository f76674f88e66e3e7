"""Caller-supplied batch functions and ad-hoc SQL (inventory I3, J2).

``batch_map`` is the reference's ``batch_process``: a caller's pandas
function applied slice by slice. In Spark the slices come from the Arrow
record batches of each partition (``mapInPandas``), cut to ``batch_size``
rows; the function must be row-local (it sees one slice at a time), exactly
like the reference.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def batch_map(df: DataFrame, func: Callable[[pd.DataFrame], pd.DataFrame], schema: StructType | str,
              batch_size: int | None = None) -> DataFrame:
    """Apply ``func`` to slices of at most ``batch_size`` rows of each partition.

    Arrow delivers each partition as record batches; they are re-sliced
    inside the task, so the session's Arrow settings are left untouched.
    """
    size = int(batch_size) if batch_size else None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if size is None or len(pdf) <= size:
                yield func(pdf)
            else:
                for start in range(0, len(pdf), size):
                    yield func(pdf.iloc[start:start + size])

    return df.mapInPandas(run, schema)


def execute_query(spark: SparkSession, sql: str, tables: dict[str, DataFrame] | None = None,
                  args: dict | None = None) -> DataFrame:
    """Run SQL text over named DataFrames (``{name}`` placeholders) with
    bound scalar parameters (``:name``); no string formatting of values."""
    return spark.sql(sql, args=args or None, **(tables or {}))
