"""The phase-1 job (inventory K1); the other phases are in ``phases``."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigspark import config
from sigspark.operators.joins import build_compound_metadata, combine_metadata
from sigspark.operators.reshape import dedupe, filter_by_z_score, landmark_genes, present, significance_flag, target_signatures
from sigspark.operators.sides import joined


@dataclass
class Phase1:
    expression: DataFrame
    genetic_signatures: DataFrame
    compound_metadata: DataFrame


def expression_table(gene_info: DataFrame, sig_info: DataFrame, matrix_long: DataFrame) -> DataFrame:
    """Landmark genes × target treatment signatures, long, with names attached.

    The reference restricts the matrix to the wanted ids (B4/B5) and then
    attaches symbols and compound names with left joins (C2/C3). Since the
    restriction keeps only ids present in those dimensions, each pair is one
    inner join here: the matrix — the only large input — is joined twice
    instead of four times. The gene list is bounded by the gene universe;
    the signature list is shuffle-joined unless its files are small.
    """
    cells, genes, sigs = _wanted(gene_info, sig_info, matrix_long)
    named = joined(joined(cells, genes, "gene_id"), sigs, "sig_id")
    return named.select("pert_iname", "sig_id", "pr_gene_symbol", "z_score")


def _wanted(gene_info: DataFrame, sig_info: DataFrame, matrix_long: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    genes = landmark_genes(gene_info).select(F.col("pr_gene_id").alias("gene_id"), "pr_gene_symbol")
    sigs = (target_signatures(sig_info).where(F.col("pert_type") == config.TREATMENT_TYPE)
            .select("sig_id", "pert_iname"))
    return matrix_long.where(present(matrix_long, "z_score")), genes, sigs


def expression_names(gene_info: DataFrame, sig_info: DataFrame, matrix_long: DataFrame) -> DataFrame:
    """The compounds of the expression table. The cells' signatures are made
    distinct before they are named, so the join with the signature list reads a
    row per signature and task, and not one per cell."""
    cells, genes, sigs = _wanted(gene_info, sig_info, matrix_long)
    held = joined(cells, genes.select("gene_id"), "gene_id", "left_semi").select("sig_id").distinct()
    return joined(sigs, held, "sig_id", "left_semi").select("pert_iname").distinct()


def build_signatures(inputs: dict[str, DataFrame], z_threshold: float = config.Z_THRESHOLD) -> Phase1:
    """K1: inputs → expression → significant signatures + compound metadata.

    Lazy: the |Z| filter is pushed below the name joins by Catalyst, the id
    lists are semi joins, and the two outputs are written by the caller.
    """
    expression = expression_table(inputs["gene_info"], inputs["sig_info"], inputs["matrix_long"])
    signatures = (filter_by_z_score(expression, "z_score", z_threshold)
                  .withColumn("is_significant", significance_flag("z_score", z_threshold)))
    # The first of a name's combined rows is made of the first row of each side, so names
    # that repeat on both sides need not be combined in all pairs.
    structure = dedupe(inputs["pert_info"], ["pert_iname"], ["canonical_smiles", "pubchem_cid"])
    mechanism = dedupe(inputs["repurposing"], ["pert_iname"], ["moa", "target"])
    names = expression_names(inputs["gene_info"], inputs["sig_info"], inputs["matrix_long"])
    metadata = build_compound_metadata(combine_metadata(structure, mechanism), names)
    return Phase1(expression, signatures, metadata)
