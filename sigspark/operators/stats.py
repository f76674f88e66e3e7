"""Distributed building blocks: row index, exact quantiles, scalar attach.

* ``sequence_index`` numbers rows in a global order without a single-
  partition window: the sorted frame is tagged with
  ``monotonically_increasing_id`` (partition id in the high bits), the
  per-partition row counts (one row per partition) give each partition's
  offset, and a broadcast join of those offsets yields the index. The tagged
  frame is checkpointed to the shared checkpoint folder first, so both uses
  see the same partitioning.
* ``order_statistics`` finds values by rank without a sort: a map-side sketch
  gives splitting values close to each rank, a count of the values between them
  says which narrow range holds it, and only the rows of that range go on. The
  counts are exact, the sketch only makes the ranges narrow, so ties, heavy
  tails and infinities are right whatever it answers.
* ``exact_quantiles`` takes the two ranks around ``(n-1)·p`` and interpolates
  linearly (numpy / ``percentile_cont``). Per group it counts equal values first
  (map-side), so a value that a third of the rows share is one row from there
  on; running counts over the distinct values locate the ranks, and no task
  holds a whole group.
* ``with_scalars`` attaches a one-row aggregate to every row as scalar
  subqueries (computed once, no join).
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sigspark.functions.literals import literal_rows
from sigspark.session import ensure_checkpoint_dir

_LOW_BITS = (1 << 33) - 1


def landed(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder, for a result that several parts of a plan read."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def with_scalars(df: DataFrame, scalars: DataFrame) -> DataFrame:
    """Attach the columns of a one-row frame to every row of ``df``.

    Each column becomes a scalar subquery (``DataFrame.scalar()``): Spark
    computes the one-row aggregate once (several columns of the same
    aggregate are merged into one subquery) and substitutes the value — no
    join, no broadcast of a table.
    """
    return df.select("*", *[scalars.select(c).scalar().alias(c) for c in scalars.columns])


def sequence_index(df: DataFrame, order_by: Sequence[Column | str], name: str = "index",
                   checkpoint: bool = True) -> DataFrame:
    """0-based position of each row in ``order_by`` order (ties in arbitrary order)."""
    tagged = df.orderBy(*order_by).withColumn("__mid", F.monotonically_increasing_id())
    if checkpoint:
        ensure_checkpoint_dir(df.sparkSession)
        tagged = tagged.checkpoint(eager=True)
    tagged = tagged.withColumn("__pid", F.shiftright("__mid", 33)) \
                   .withColumn("__off", F.col("__mid").bitwiseAND(F.lit(_LOW_BITS)))
    counts = tagged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    # One row per partition: the running sum runs on a tiny frame.
    before = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__pid", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__base"))
    return (tagged.join(F.broadcast(offsets), "__pid", "inner")
            .withColumn(name, F.col("__base") + F.col("__off"))
            .drop("__pid", "__off", "__mid", "__base"))


def running_total(df: DataFrame, order_by: Sequence[Column | str], weight: str, name: str) -> DataFrame:
    """Sum of ``weight`` over all rows before each row in ``order_by`` order.

    Rows must be unique in that order. Range partitions are numbered, summed
    within themselves, and shifted by the totals of the partitions before.
    """
    ensure_checkpoint_dir(df.sparkSession)
    tagged = df.orderBy(*order_by).withColumn("__mid", F.monotonically_increasing_id()).checkpoint(eager=True)
    tagged = tagged.withColumn("__pid", F.shiftright("__mid", 33))
    totals = tagged.groupBy("__pid").agg(F.sum(weight).alias("__w"))
    before = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    bases = totals.select("__pid", F.coalesce(F.sum("__w").over(before), F.lit(0)).alias("__base"))
    inner = Window.partitionBy("__pid").orderBy("__mid").rowsBetween(Window.unboundedPreceding, -1)
    return (tagged.withColumn("__in", F.coalesce(F.sum(weight).over(inner), F.lit(0)))
            .join(F.broadcast(bases), "__pid", "inner")
            .withColumn(name, F.col("__base") + F.col("__in")).drop("__pid", "__mid", "__in", "__base"))


SKETCH_ACCURACY = 10_000
CANDIDATES = 1 << 16  # values that the last step puts in order


def _in_range(value: str, ranges: Sequence[dict]) -> Column:
    """Number of the closed range that holds the value, null outside all."""
    which = F.lit(None).cast("int")
    for i, r in enumerate(ranges):
        which = F.when(F.col(value).between(F.lit(r["lo"]), F.lit(r["hi"])), F.lit(i)).otherwise(which)
    return which


def _splits(r: dict, sketched: Sequence[float]) -> list[float]:
    """Where a range is cut: at the sketched values and just above them (a
    frequent value then is a range of its own), and in the middle, so that each
    step cuts whatever the sketch said."""
    middle = r["lo"] / 2 + r["hi"] / 2
    cuts = {middle if r["lo"] < middle <= r["hi"] else r["hi"]}
    for x in sketched:
        cuts |= {x, math.nextafter(x, math.inf)}
    return sorted(c for c in cuts if r["lo"] < c <= r["hi"])


def _sketch(value: Column, shares: Sequence[float]) -> Column:
    """Values close below and above each share of the rows."""
    margin = 2.0 / SKETCH_ACCURACY
    return F.percentile_approx(value, sorted({min(1.0, max(0.0, p + d)) for p in shares for d in (-margin, margin)}), SKETCH_ACCURACY)


def _narrowed(vals: DataFrame, value: str, ranges: Sequence[dict]) -> list[dict]:
    """Each range cut around its ranks: a scan for the sketches (unless the range
    has them) and one for a few dozen counts."""
    tagged = vals.select(value, _in_range(value, ranges).alias("__r")).where(F.col("__r").isNotNull())
    if all("near" in r for r in ranges):
        near = [r["near"] for r in ranges]
    else:
        near = tagged.agg(*[_sketch(F.when(F.col("__r") == i, F.col(value)), [(k - r["base"]) / r["size"] for k in r["ranks"]])
                            for i, r in enumerate(ranges)]).first()
    cuts = [_splits(r, got) for r, got in zip(ranges, near)]
    piece = F.lit(0)
    for i, at in enumerate(cuts):
        piece = F.when(F.col("__r") == i, reduce(lambda a, c: a + (F.col(value) >= F.lit(c)).cast("int"), at, F.lit(0))).otherwise(piece)
    counted = tagged.groupBy("__r", piece.alias("__p")).agg(F.count(F.lit(1)).alias("n"), F.min(value).alias("lo"), F.max(value).alias("hi"))
    out, base, last = [], 0, None
    for row in sorted(counted.collect(), key=lambda x: (x["__r"], x["__p"])):
        r = ranges[row["__r"]]
        base = base if row["__r"] == last else r["base"]
        last = row["__r"]
        held = [k for k in r["ranks"] if base <= k < base + row["n"]]
        if held:
            out.append({"lo": row["lo"], "hi": row["hi"], "base": base, "size": row["n"], "ranks": held})
        base += row["n"]
    return out


def order_statistics(vals: DataFrame, value: str, ranks: Sequence[int], whole: dict, candidates: int | None = None) -> dict[int, float]:
    """The values at 0-based ``ranks`` of a column of doubles without nulls or
    NaN; ``whole`` is its range (lo, hi, size, and near: sketched values, if known).

    A step reads the column twice and leaves about a 1,500th of the rows; up to
    some 1e8 values one is enough, 1e12 values take three. A few dozen numbers
    reach the driver. Land an expensive input first."""
    candidates = CANDIDATES if candidates is None else candidates
    ranges = [{**whole, "base": 0, "ranks": sorted(set(ranks))}] if ranks else []
    found: dict[int, float] = {}
    while ranges:
        found.update({k: r["lo"] for r in ranges if r["lo"] == r["hi"] for k in r["ranks"]})
        ranges = [r for r in ranges if r["lo"] != r["hi"]]
        if sum(r["size"] for r in ranges) <= candidates:
            break
        ranges = _narrowed(vals, value, ranges)
    if not ranges:
        return found
    rows = vals.select(value, _in_range(value, ranges).alias("__r")).where(F.col("__r").isNotNull())
    order = Window.partitionBy("__r").orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = rows.groupBy("__r", value).agg(F.count(F.lit(1)).alias("__c")).withColumn("__upto", F.sum("__c").over(order))
    held = reduce(lambda a, b: a | b, [(F.col("__r") == i) & (F.col("__upto") > k - r["base"]) & (F.col("__upto") - F.col("__c") <= k - r["base"])
                                       for i, r in enumerate(ranges) for k in r["ranks"]])
    for row in placed.where(held).collect():
        r = ranges[row["__r"]]
        found.update({k: row[value] for k in r["ranks"] if row["__upto"] - row["__c"] <= k - r["base"] < row["__upto"]})
    return found


def _whole_quantiles(vals: DataFrame, value: str, probs: Sequence[float], names: Sequence[str]) -> DataFrame:
    schema = ", ".join(f"`{n}` double" for n in names)
    n, lo, hi, near = vals.agg(F.count(F.lit(1)), F.min(value), F.max(value), _sketch(F.col(value), probs)).first()
    if not n:
        return literal_rows(vals.sparkSession, [(None,) * len(names)], schema)
    at = [(n - 1) * float(p) for p in probs]
    found = order_statistics(vals, value, [r for pos in at for r in (math.floor(pos), math.ceil(pos))], {"lo": lo, "hi": hi, "size": n, "near": near})

    def between(pos: float) -> float:
        a, b = found[math.floor(pos)], found[math.ceil(pos)]
        return a if a == b else a + (b - a) * (pos - math.floor(pos))

    return literal_rows(vals.sparkSession, [tuple(map(between, at))], schema)


def exact_quantiles(df: DataFrame, value: str, probs: Sequence[float], group_by: Sequence[str] = (),
                    names: Sequence[str] | None = None) -> DataFrame:
    """Exact linear-interpolation quantiles of ``value`` (nulls and NaN dropped), per group.

    Returns one row per group with one column per probability (``names`` or
    ``q_<p>``); a group with no values is absent.
    """
    group_by = list(group_by)
    names = list(names) if names else [f"q_{str(p).replace('.', '_')}" for p in probs]
    vals = (df.select(*group_by, F.col(value).cast("double").alias("__v"))
            .where(F.col("__v").isNotNull() & ~F.isnan("__v")))
    if not group_by:
        return _whole_quantiles(vals, "__v", probs, names)
    counts = vals.groupBy(*group_by, "__v").agg(F.count(F.lit(1)).alias("__c"))
    ranked = running_total(counts, [*group_by, "__v"], "__c", "__before")
    bounds = [F.min("__before").alias("__start"), F.sum("__c").alias("__n")]
    groups = ranked.groupBy(*group_by).agg(*bounds).select(*[F.col(c).alias(f"__g_{c}") for c in group_by], "__start", "__n")
    same = [F.col(c).eqNullSafe(F.col(f"__g_{c}")) for c in group_by]
    placed = ranked.join(groups, reduce(lambda a, b: a & b, same), "inner")
    first = F.col("__before") - F.col("__start")

    def at(rank: Column) -> Column:
        return F.max(F.when((first <= rank) & (rank < first + F.col("__c")), F.col("__v")))

    aggs = []
    for i, p in enumerate(probs):
        pos = (F.col("__n") - 1) * F.lit(float(p))
        aggs += [at(F.floor(pos)).alias(f"__lo{i}"), at(F.ceil(pos)).alias(f"__hi{i}"), F.max(pos - F.floor(pos)).alias(f"__f{i}")]
    found = placed.groupBy(*group_by).agg(*aggs)
    return found.select(*group_by, *[(F.col(f"__lo{i}") + (F.col(f"__hi{i}") - F.col(f"__lo{i}")) * F.col(f"__f{i}")).alias(n)
                                     for i, n in enumerate(names)])


def moments(value: Column) -> list[Column]:
    """Count, mean, sample std and bias-corrected skewness / excess kurtosis.

    Spark's ``skewness``/``kurtosis`` are the population forms g1, g2; the
    pandas estimators are G1 = g1·sqrt(n(n-1))/(n-2) and
    G2 = ((n+1)·g2 + 6)·(n-1)/((n-2)(n-3)).
    """
    n = F.count(value).cast("double")
    g1, g2 = F.skewness(value), F.kurtosis(value)
    skew = F.when(n > 2, g1 * F.sqrt(n * (n - 1)) / (n - 2))
    kurt = F.when(n > 3, ((n + 1) * g2 + 6) * (n - 1) / ((n - 2) * (n - 3)))
    return [F.count(value).alias("count"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"),
            F.min(value).alias("min"), F.max(value).alias("max"), skew.alias("skewness"), kurt.alias("kurtosis")]
