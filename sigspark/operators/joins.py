"""Join operators (inventory C1–C12).

Broadcast policy: no operator forces a broadcast of a table whose size
grows with the data. Dimension joins go through ``sides.joined``: a side of
small files is left to Spark, which may broadcast it, a larger one is joined by
shuffle, with AQE splitting skewed partitions. Explicit ``broadcast`` hints are used only for sides whose size
is bounded by construction (a top-k list, a one-row aggregate, a fixed
lookup table).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigspark.errors import ValidationError, require_columns
from sigspark.operators.reshape import dedupe
from sigspark.operators.sides import joined
from sigspark.operators.stats import with_scalars

COMPOUND_COLUMNS = ("pert_iname", "moa", "target", "canonical_smiles", "pubchem_cid")


def fact_dim_join(compound_metadata: DataFrame, signatures: DataFrame) -> DataFrame:
    """``compound_metadata JOIN genetic_signatures USING (pert_iname)``."""
    cm = compound_metadata
    gs_cols = [c for c in signatures.columns if c != "pert_iname"]
    return joined(cm, signatures, "pert_iname").select(*cm.columns, *gs_cols)


def attach_gene_symbol(df: DataFrame, gene_info: DataFrame) -> DataFrame:
    """Left join on ``gene_id = pr_gene_id``, then drop both ids."""
    genes = gene_info.select(F.col("pr_gene_id").alias("gene_id"), "pr_gene_symbol")
    return joined(df, genes, "gene_id", "left").drop("gene_id")


def attach_compound(df: DataFrame, sig_info: DataFrame) -> DataFrame:
    """Left join on ``sig_id`` to bring the compound name."""
    return joined(df, sig_info.select("sig_id", "pert_iname"), "sig_id", "left")


def combine_metadata(pert_info: DataFrame, repurposing: DataFrame) -> DataFrame:
    """C4: structure (pert info) ⟕ mechanism list on ``pert_iname``."""
    return (joined(pert_info, repurposing.select("pert_iname", "moa", "target"), "pert_iname", "left")
            .select("pert_iname", "moa", "target", "canonical_smiles", "pubchem_cid"))


def build_compound_metadata(combined: DataFrame, expression: DataFrame,
                            order_by: Sequence[str] = ("moa", "target", "canonical_smiles", "pubchem_cid")) -> DataFrame:
    """Metadata of compounds present in the expression table, one row each.

    The expression side has one row per cell; its names are made distinct
    map-side first, so a compound with a third of the matrix is one row per
    task in the shuffle and one row in the join."""
    present = joined(combined, expression.select("pert_iname").distinct(), "pert_iname", "left_semi")
    return dedupe(present, ["pert_iname"], list(order_by), keep="first")


def create_compound_metadata(pert_info: DataFrame, order_by: Sequence[str] | None = None) -> DataFrame:
    """Keep whichever of the five known columns exist; ``pert_iname`` is required."""
    require_columns(pert_info, ["pert_iname"], "perturbagen info")
    cols = [c for c in COMPOUND_COLUMNS if c in pert_info.columns]
    narrowed = pert_info.select(*cols)
    others = [c for c in cols if c != "pert_iname"]
    return dedupe(narrowed, ["pert_iname"], list(order_by) if order_by else others or ["pert_iname"], keep="first")


def orphaned_signatures(signatures: DataFrame, compound_metadata: DataFrame, null_aware: bool = True) -> DataFrame:
    """Signature rows whose compound is not in the metadata.

    ``null_aware=True`` keeps SQL ``x NOT IN (keys)`` semantics exactly: an
    empty key list keeps every row; a null among the keys keeps none; a null
    ``x`` is dropped otherwise. It is computed as an ordinary ``left_anti``
    equi-join plus a one-row (count, null count) flag, because Spark's own
    null-aware anti join exists only as a broadcast hash join and otherwise
    falls back to a nested-loop join. ``False`` is the plain ``left_anti``
    for keys proven non-null.
    """
    keys = compound_metadata.select("pert_iname")
    if not null_aware:
        return joined(signatures, keys, "pert_iname", "left_anti")
    anti = joined(signatures, keys.where(F.col("pert_iname").isNotNull()), "pert_iname", "left_anti")
    flags = keys.agg(F.count(F.lit(1)).alias("__keys"), F.sum(F.col("pert_iname").isNull().cast("long")).alias("__nulls"))
    keep = (F.col("__keys") == 0) | ((F.coalesce(F.col("__nulls"), F.lit(0)) == 0) & F.col("pert_iname").isNotNull())
    return with_scalars(anti, flags).where(keep).select(*signatures.columns)


def merge(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner",
          suffixes: tuple[str, str] = ("_x", "_y")) -> DataFrame:
    """C11: pandas-style merge: null keys match each other, shared columns get suffixes.

    The null-safe equality (``<=>``) is still planned as an equi-join. An outer
    merge is the left merge plus the right rows whose key is not on the left
    (an anti join on the left's distinct keys): AQE splits a hot key in both
    parts, which it cannot do in a full outer join.
    """
    on = list(on)
    require_columns(left, on, "left merge input")
    require_columns(right, on, "right merge input")
    if how not in ("inner", "left", "right", "outer"):
        raise ValidationError(f"unsupported merge type {how!r}")
    shared = (set(left.columns) & set(right.columns)) - set(on)
    lsel = [F.col(c).alias(f"{c}{suffixes[0]}" if c in shared else c) for c in left.columns]
    rsel = [F.col(c).alias(f"__rk_{c}") for c in on] + [
        F.col(c).alias(f"{c}{suffixes[1]}" if c in shared else c) for c in right.columns if c not in on]
    lhs, rhs = left.select(*lsel), right.select(*rsel)
    if how == "outer":
        keys = left.select(*[F.col(c).alias(f"__lk_{c}") for c in on]).distinct()
        absent = reduce(lambda a, b: a & b, [F.col(f"__rk_{c}").eqNullSafe(F.col(f"__lk_{c}")) for c in on])
        rest = joined(rhs, keys, absent, "left_anti").select(*[F.col(f"__rk_{c}").alias(c) for c in on],
                                                          *[c for c in rhs.columns if not c.startswith("__rk_")])
        return merge(left, right, on, "left", suffixes).unionByName(rest, allowMissingColumns=True)
    cond = reduce(lambda a, b: a & b, [lhs[c].eqNullSafe(rhs[f"__rk_{c}"]) for c in on])
    both = joined(lhs, rhs, cond, how)
    out = []
    for c in lhs.columns:
        if c in on:
            key = F.coalesce(lhs[c], rhs[f"__rk_{c}"]) if how == "right" else lhs[c]
            out.append(key.alias(c))
        else:
            out.append(lhs[c])
    out += [rhs[c] for c in rhs.columns if not c.startswith("__rk_")]
    return both.select(*out)
