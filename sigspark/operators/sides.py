"""Joins whose sides grow with the data.

Spark broadcasts a side whose files, cut down to the columns it reads, are
smaller than ``autoBroadcastJoinThreshold``. Columns of few or ascending values
take up to some 50 times as much as rows: 10 MB of part keys are 500 MB, which
the driver has to collect, build and keep, for each join that runs at the time.
So a side is left to Spark's estimate only up to ``FILE_BYTES``. A larger one is
joined by shuffle, where partitions spill and AQE splits skewed ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

FILE_BYTES = 1 << 18  # some 13 MB as rows
# Beyond so many times the threshold Spark shuffles both sides, also with the columns
# that later steps leave out, and AQE broadcasts only what it has measured as rows.
SLACK = 8


def _estimate(df: DataFrame) -> int:
    """Spark's own estimate of the size: no job, file sizes and column kinds only."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def _grown(*sides: DataFrame) -> bool:
    """Spark might broadcast one of the sides, and each has grown."""
    most = sides[0].sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    if most <= FILE_BYTES:
        return False
    sizes = []
    for side in sides:
        sizes.append(_estimate(side))
        if sizes[-1] <= FILE_BYTES:
            return False
    return min(sizes) <= SLACK * most


def unsent(side: DataFrame) -> DataFrame:
    """A side of joins in SQL text, which is not broadcast once it has grown."""
    return side.hint("merge") if _grown(side) else side


def joined(left: DataFrame, right: DataFrame, on: str | list[str] | Column, how: str = "inner") -> DataFrame:
    """``left.join(right, on, how)``; no side that may be broadcast is, once it has grown."""
    sides = {"inner": (right, left), "right": (left,)}.get(how, (right,))
    return left.join(right.hint("merge") if _grown(*sides) else right, on, how)
