"""Best partner by shared genes: bounded search in blocks (E2g).

For every unknown compound, the known compound with most genes in common. A
gene self-join would emit every pair of compounds that share a gene, which is
quadratic in a gene that all have. Instead:

* genes get integer codes by rarity, and a compound is one row with its codes;
  genes that only one side has are left out;
* known compounds lie in blocks in falling order of their number of genes,
  which bounds what any unknown compound can share with the block;
* every unknown compound visits the first block, and from then on only blocks
  whose largest compound could still reach the best found;
* in a task both sides are bitsets over the block's genes. An unknown compound
  whose genes, cut with those of the whole block, are fewer than its best so far
  is passed over; for the others one AND and a bit count give all overlaps.

A task holds one block and about as many unknown compounds; a block that many
visit is read by several tasks. No (compound, compound) row is ever made.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sigspark.functions.literals import literal_rows
from sigspark.session import ensure_checkpoint_dir

SCHEMA = "pert_iname string, best_match string, shared_genes long"


def gene_sets(pairs: DataFrame) -> DataFrame:
    """``(pert_iname, known, genes, n)`` from distinct ``(pert_iname,
    pr_gene_symbol, known)``: ascending gene codes, rare genes first. The codes
    come from one window over the genes that both sides have (bounded by the
    gene universe)."""
    side = pairs.groupBy("pr_gene_symbol").agg(F.sum(F.col("known").cast("long")).alias("k"), F.count(F.lit(1)).alias("c"))
    both = side.where((F.col("k") > 0) & (F.col("k") < F.col("c")))
    codes = both.select("pr_gene_symbol", (F.row_number().over(Window.orderBy("c", "pr_gene_symbol")) - 1).alias("code"))
    sets = pairs.join(codes, "pr_gene_symbol").groupBy("pert_iname", "known").agg(F.sort_array(F.collect_list("code")).alias("genes"))
    return sets.withColumn("n", F.size("genes"))


def _score(unknown, known):
    """The best known partner of each unknown compound in one block."""
    import numpy as np
    import pandas as pd

    none = pd.DataFrame({"pert_iname": pd.Series([], dtype=object), "best_match": pd.Series([], dtype=object),
                         "shared_genes": pd.Series([], dtype="int64")})
    if unknown.empty or known.empty:
        return none
    known = known.sort_values("name")
    codes = np.unique(np.concatenate(known["k_genes"].to_list()))

    def bits(genes):
        out = np.zeros((len(genes), -(-len(codes) // 64)), np.uint64)
        row = np.repeat(np.arange(len(genes)), [len(g) for g in genes])
        gene = np.concatenate(genes)
        at = np.minimum(np.searchsorted(codes, gene), len(codes) - 1)
        held = codes[at] == gene
        np.bitwise_or.at(out, (row[held], at[held] >> 6), np.uint64(1) << (at[held] & 63).astype(np.uint64))
        return out

    mine, block = bits(unknown["genes"].to_list()), bits(known["k_genes"].to_list())
    bound = np.bitwise_count(mine).sum(axis=1)  # the block's genes are all of ``codes``
    names, found = known["name"].to_numpy(), []
    for i in np.flatnonzero(bound >= np.maximum(unknown["best"].to_numpy(), 1)).tolist():
        shared = np.bitwise_count(block & mine[i]).sum(axis=1)
        j = int(shared.argmax())  # the first of equals: the smallest name
        if shared[j]:
            found.append((unknown["pert_iname"].iloc[i], names[j], int(shared[j])))
    return pd.DataFrame(found, columns=none.columns) if found else none


def visits(unknown: DataFrame, sizes: list[tuple[int, int]], block_size: int) -> DataFrame:
    """``unknown`` with ``best`` (0: none yet), one row per block after the
    first whose largest compound has as many genes. ``sizes``: (genes, known
    compounds) in falling order, one row per number of genes."""
    last, upto, rows = 0, 0, []
    for (n, c), (below, _) in zip(sizes, [*sizes[1:], (0, 0)]):
        upto += c
        last = (upto - 1) // block_size
        rows += [(s, last) for s in range(n, below, -1)]
    reach = unknown.sparkSession.createDataFrame(rows, "reach int, last int")  # as many rows as the largest compound has genes
    found = unknown.join(reach, F.greatest("best", F.lit(1)) == F.col("reach")).where("last > 0")
    return found.withColumn("block", F.explode(F.sequence(F.lit(1), F.col("last")))).drop("reach", "last")


def _meet(unknown: DataFrame, known: DataFrame, block_size: int, tasks: int) -> DataFrame:
    load = unknown.groupBy("block").agg(F.count(F.lit(1)).alias("c"))
    load = load.select(F.col("block").alias("at"), F.greatest(F.ceil(F.col("c") / block_size), F.least("c", F.lit(tasks))).cast("int").alias("parts"))
    asked = unknown.join(load, F.col("block") == F.col("at")).withColumn("part", F.pmod(F.xxhash64("pert_iname"), F.col("parts")))
    there = known.join(load, F.col("block") == F.col("at")).withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts").cast("long") - 1)))
    there = there.select(F.col("block").alias("k_block"), F.col("part").alias("k_part"), F.col("pert_iname").alias("name"), F.col("genes").alias("k_genes"))
    return (asked.select("block", "part", "pert_iname", "genes", "best").groupBy("block", "part")
            .cogroup(there.groupBy("k_block", "k_part")).applyInPandas(_score, SCHEMA))


def best_partners(pairs: DataFrame, block_size: int = 1024, tasks: int | None = None) -> DataFrame:
    """``(pert_iname, best_match, shared_genes)`` for every unknown compound
    that shares a gene with a known one; ties go to the smaller name."""
    spark = pairs.sparkSession
    ensure_checkpoint_dir(spark)
    tasks = tasks or spark.sparkContext.defaultParallelism
    sets = gene_sets(pairs).checkpoint()
    sizes = [(r["n"], r["c"]) for r in sets.where("known").groupBy("n").agg(F.count(F.lit(1)).alias("c")).orderBy(F.desc("n")).collect()]
    if not sizes:  # at most one row per number of genes
        return literal_rows(spark, [], SCHEMA)
    # A known compound's place among all, by falling size: that of its size's first one and a hash within the size.
    first, upto = [], 0
    for n, c in sizes:
        first.append((n, upto, c))
        upto += c
    place = spark.createDataFrame(first, "of int, first int, count int")
    known = sets.where("known").join(place, F.col("n") == F.col("of")).withColumn(
        "block", F.floor((F.col("first") + F.pmod(F.xxhash64("pert_iname"), F.col("count"))) / block_size).cast("int"))
    unknown = sets.where("not known").select("pert_iname", "genes", "n")
    near = _meet(unknown.withColumns({"best": F.lit(0), "block": F.lit(0)}), known, block_size, tasks)
    if upto <= block_size:
        return near
    near = near.checkpoint()
    reached = near.select(F.col("pert_iname").alias("who"), "shared_genes")
    rest = unknown.join(reached, F.col("pert_iname") == F.col("who"), "left").withColumn("best", F.coalesce("shared_genes", F.lit(0)).cast("int"))
    far = _meet(visits(rest.select("pert_iname", "genes", "best"), sizes, block_size), known, block_size, tasks)
    order = Window.partitionBy("pert_iname").orderBy(F.col("shared_genes").desc(), "best_match")
    return near.union(far).withColumn("__rn", F.row_number().over(order)).where(F.col("__rn") == 1).drop("__rn")
