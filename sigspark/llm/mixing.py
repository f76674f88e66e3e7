"""Mixing sources to target weights by capped water-filling.

Each source's target is its weighted share of the mix, clamped at a maximum
number of epochs over the source; what the clamp leaves over is shared again by
weight until no target is above its clamp. A document is then repeated whole
floor(target / source size) times; the remaining words are one seeded
fractional repetition of the source: in the order of a seeded hash, documents
are taken whole once more until the remainder is used up, the one at the cut
in part. So every source meets its target to the word.

The cut is found without sorting a source: words are summed by hash bucket,
the buckets of a source by a window of at most ``BUCKETS`` rows, and only the
documents of the one bucket that holds the cut are ordered.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sigspark.llm.common import WORD, free_prefix, land
from sigspark.operators.stats import sequence_index

BUCKETS = 4096  # three hexadecimal digits of the seeded hash


@dataclass(frozen=True)
class Params:
    """``weights`` repeat over the sources in code point order, null last."""

    weights: tuple[int, ...] = (5, 2, 1)
    epochs: float = 1.5
    max_epochs: int = 2
    seed: int = 9


def word_count(column):
    return F.coalesce(F.regexp_count(column, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def seeded_hash(id_col, text_col, seed: int):
    """A hexadecimal hash of seed, id and whole text: the order of documents in
    a fractional repetition. Only equal rows share one."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.coalesce(id_col.cast("string"), F.lit("-")), F.coalesce(text_col, F.lit(""))))


def _weights(params: Params, rank):
    n = len(params.weights)
    return F.element_at(F.array(*(F.lit(w) for w in params.weights)), (F.pmod(rank, F.lit(n)) + 1).cast("int"))


def water_fill(sources: DataFrame, params: Params = Params()) -> DataFrame:
    """``sources`` (source, size) with weight and target. One row per source,
    whatever the number of documents; each round is one aggregate of them."""
    ranked = sequence_index(land(sources, "source-words"), [F.col("source").asc_nulls_last()], "rank")
    ranked = land(ranked.select("source", "size", _weights(params, F.col("rank")).alias("weight"),
                                (F.col("size") * params.max_epochs).alias("cap")), "sources")
    budget = (ranked.agg(F.sum("size")).first()[0] or 0) * params.epochs
    level, fixed, weight = 0.0, 0, ranked.agg(F.sum("weight")).first()[0] or 0
    while weight:
        now = (budget - fixed) / weight
        if now <= level:
            break
        level = now
        above = F.col("cap") < F.lit(level) * F.col("weight")
        got = ranked.agg(F.sum(F.when(above, F.col("cap"))).alias("fixed"), F.sum(F.when(~above, F.col("weight"))).alias("weight")).first()
        fixed, weight = got["fixed"] or 0, got["weight"] or 0
    return ranked.select("source", "size", "weight", F.least(F.col("cap").cast("double"), F.lit(level) * F.col("weight")).alias("target"))


def mix(df: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", params: Params = Params(),
        size_out: str = "size", source_size_out: str = "source_size", target_out: str = "target", taken_out: str = "taken") -> DataFrame:
    """``df`` with each document's words, its source's words and target, and
    the words that the mix takes of it, repeats counted.

    A null text has no words; a null source is a source of its own, the last; a
    null id is ordered like any other. Equal rows share a part at the cut
    evenly. Sources without words get target 0. An empty table gives none.
    Other columns stay; the added names must be free. Reruns agree."""
    p = free_prefix(df, "_mx_")
    work = df.withColumns({f"{p}size": word_count(df[text_col]), f"{p}h": seeded_hash(df[id_col], df[text_col], params.seed)})
    narrow = work.select(F.col(source_col).cast("string").alias("source"), F.col(f"{p}size").alias("size"), F.col(f"{p}h").alias("h"))
    narrow = land(narrow, "sizes")
    bucket = F.substring("h", 1, 3).alias("bucket")
    sums = land(narrow.groupBy("source", bucket).agg(F.sum("size").alias("words")), "bucket-words")
    plan = water_fill(sums.groupBy("source").agg(F.sum("words").alias("size")), params)
    plan = plan.withColumn("whole", F.when(F.col("size") > 0, F.floor(F.col("target") / F.col("size"))).otherwise(F.lit(0)).cast("long"))
    plan = land(plan.withColumn("extra", F.floor(F.col("target") - F.col("whole") * F.col("size")).cast("long")), "targets")

    order = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    named = plan.select(F.col("source").alias("s"), "extra").filter("extra > 0")
    edge = (sums.withColumn("upto", F.sum("words").over(order)).join(named, F.col("source").eqNullSafe(F.col("s")))
            .filter((F.col("upto") >= F.col("extra")) & (F.col("upto") - F.col("words") < F.col("extra")))
            .select("s", F.col("bucket").alias("b"), (F.col("extra") - F.col("upto") + F.col("words")).alias("rest")))
    inside = (narrow.withColumn("bucket", F.substring("h", 1, 3)).join(land(edge, "edges"), F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b")))
              .groupBy("s", "h", "rest").agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("ties")))
    order = Window.partitionBy("s").orderBy("h").rowsBetween(Window.unboundedPreceding, 0)
    cut = (inside.withColumn("upto", F.sum("words").over(order))
           .filter((F.col("upto") >= F.col("rest")) & (F.col("upto") - F.col("words") < F.col("rest")))
           .select("s", F.col("h").alias("cut"), F.expr("(rest - upto + words) div ties").alias("part")))
    plan = plan.join(cut, F.col("source").eqNullSafe(F.col("s")), "left")
    plan = land(plan.select(F.col("source").alias(f"{p}source"), F.col("size").alias(f"{p}source_size"), F.col("target").alias(f"{p}target"),
                            F.col("whole").alias(f"{p}whole"), F.col("cut").alias(f"{p}cut"), F.col("part").alias(f"{p}part")), "plan")

    extra = (F.when(F.col(f"{p}h") < F.col(f"{p}cut"), F.col(f"{p}size")).when(F.col(f"{p}h") == F.col(f"{p}cut"), F.col(f"{p}part"))
             .otherwise(F.lit(0).cast("long")))
    out = work.join(plan, work[source_col].cast("string").eqNullSafe(F.col(f"{p}source")))
    return out.select(*(work[c] for c in df.columns), F.col(f"{p}size").alias(size_out), F.col(f"{p}source_size").alias(source_size_out),
                      F.col(f"{p}target").alias(target_out), (F.col(f"{p}whole") * F.col(f"{p}size") + extra).alias(taken_out))
