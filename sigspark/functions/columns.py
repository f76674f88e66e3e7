"""Column expressions: categories, labels, rules and formats.

All are built-in Spark expressions (``when`` chains, map literals,
``format_string``), so they stay inside whole-stage codegen; none is a
Python UDF.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from sigspark import config


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def compound_category(moa: Column | str = "moa") -> Column:
    """Null / '' / 'None' → novel; then 'inhibitor', then 'agonist' (so
    'antagonist' is an activator, as in the reference), else complex."""
    m = _col(moa)
    low = F.lower(m)
    return (F.when(m.isNull() | (m == "") | (m == "None"), config.CATEGORY_NOVEL)
            .when(low.contains("inhibitor"), config.CATEGORY_SUPPRESSOR)
            .when(low.contains("agonist"), config.CATEGORY_ACTIVATOR)
            .otherwise(config.CATEGORY_COMPLEX))


def gene_function(symbol: Column | str = "pr_gene_symbol") -> Column:
    """Ten-entry lookup as a map literal (no join), default label."""
    lookup = F.create_map(*[F.lit(x) for x in chain.from_iterable(config.GENE_FUNCTIONS.items())])
    return F.coalesce(F.element_at(lookup, _col(symbol)), F.lit(config.GENE_FUNCTION_DEFAULT))


def profile_rule(max_response: Column | str = "max_response", gene_count: Column | str = "biomarker_count",
                 min_potency: float = config.MIN_POTENCY, max_genes: int = config.MAX_AFFECTED_GENES,
                 potency_threshold: float = config.HIGH_CONFIDENCE_Z) -> Column:
    """H1: Precision_Lead / Broad_Spectrum / Moderate_Impact / Low_Activity / Unknown."""
    p, g = _col(max_response), _col(gene_count)
    hi, mid = F.lit(float(min_potency)), F.lit(float(potency_threshold))
    return (F.when((p >= hi) & (g <= max_genes), config.PROFILE_PRECISION)
            .when((p >= hi) & (g > max_genes), config.PROFILE_BROAD)
            .when((p >= mid) & (p < hi), config.PROFILE_MODERATE)
            .when(p < mid, config.PROFILE_LOW)
            .otherwise(config.PROFILE_UNKNOWN))


def clinical_triage(genes_6h: Column | str = "Affected_Genes_6h", delta: Column | str = "Gene_Delta",
                    cascade_delta: int = config.CASCADE_DELTA, rapid_genes: int = config.RAPID_GENES_6H) -> Column:
    """A null delta (a missing time point) falls through to Sustained Shock."""
    g6, d = _col(genes_6h), _col(delta)
    return (F.when(d >= cascade_delta, config.TRIAGE_CASCADE)
            .when((g6 > rapid_genes) & (d <= 0), config.TRIAGE_RAPID)
            .when((d > 0) & (d < cascade_delta), config.TRIAGE_GRADUAL)
            .otherwise(config.TRIAGE_SUSTAINED))


def research_maturity(count: Column | str = "pubmed_papers",
                      established_above: int = config.MATURITY_ESTABLISHED_ABOVE) -> Column:
    """> 100 established, ≥ 1 emerging, 0 novel IP, null (failed lookup) error."""
    c = _col(count)
    return (F.when(c.isNull(), config.MATURITY_ERROR)
            .when(c > established_above, config.MATURITY_ESTABLISHED)
            .when(c >= 1, config.MATURITY_EMERGING)
            .otherwise(config.MATURITY_NOVEL))


def novelty_status(count: Column | str = "publication_count", threshold: int = config.NOVELTY_THRESHOLD) -> Column:
    """< threshold novel, else established; a failed lookup (-1 / null) is 'error'."""
    c = _col(count)
    return (F.when(c.isNull() | (c < 0), config.NOVELTY_ERROR).when(c < threshold, config.NOVELTY_NOVEL)
            .otherwise(config.NOVELTY_ESTABLISHED))


def risk_level(count: Column | str = "publication_count", low_above: int = config.RISK_LOW_ABOVE,
               medium_above: int = config.RISK_MEDIUM_ABOVE) -> Column:
    """> 50 LOW, > 10 MEDIUM, else HIGH."""
    c = _col(count)
    return F.when(c > low_above, config.RISK_LOW).when(c > medium_above, config.RISK_MEDIUM).otherwise(config.RISK_HIGH)


def format_scientific(value: Column | str, decimals: int = 2) -> Column:
    """I1: '{:.Ne}' style, e.g. 1.23e+05 (JVM rounds decimal ties half-up)."""
    return F.format_string(f"%.{int(decimals)}e", _col(value))


def format_percentage(value: Column | str, decimals: int = 1) -> Column:
    """Share in 0..1 → 'xx.x%'."""
    return F.format_string(f"%.{int(decimals)}f%%", _col(value) * F.lit(100.0))
