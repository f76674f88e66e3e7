"""Test-data binding: the driver's TPC-H-style tables viewed as assay inputs.

The driver tables hold no assay data, so the binding in FIXTURES.md §3
defines the five reference inputs (gene info, signature info, perturbagen
info, mechanism list and the long Z matrix) as SQL over ``lineitem``,
``part`` and ``supplier``. The same SQL text is the oracle's base, so it is
kept verbatim here and run through ``spark.sql`` with DataFrame arguments
(no global temp views, so several data folders can live in one session).

compound = supplier, gene = part brand/type, signature =
supplier : line status : order mod 5, Z = heavy-tailed function of quantity.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sigspark.operators.sides import joined, unsent

COMPOUND_KEY_SQL = """
select s_suppkey, s_nationkey,
  case when s_suppkey % 30 = 1 then concat('brd-x', lpad(cast(s_suppkey as varchar(20)), 6, '0'))
       when s_suppkey % 3 = 0 then concat('BRD-K', lpad(cast(s_suppkey as varchar(20)), 8, '0'))
       else s_name end as pert_iname
from {supplier}
"""

ASSAY_SQL = """
select k.pert_iname, l_suppkey, l_linestatus, l_orderkey % 5 as plate,
  concat(cast(l_suppkey as varchar(20)), ':', l_linestatus, ':', cast(l_orderkey % 5 as varchar(20))) as sig_id,
  concat('g:', p_brand, '/', p_type) as gene_id,
  cast(10 as double) * (cast(2 + l_suppkey % 9 as double) / cast(10 as double))
    * (case when l_suppkey % 4 = 0 and p_size > 15 then cast(0.1 as double) else cast(1 as double) end)
    * u*u*u*u*u*u*u*u*u as z
from (select *, (l_quantity - cast(25.5 as double)) / cast(24.5 as double) as u from {lineitem}) x
join {part} on p_partkey = l_partkey
join {compound_key} k on k.s_suppkey = l_suppkey
"""

SIG_INFO_SQL = """
select distinct sig_id, pert_iname,
  case when l_suppkey % 10 = 9 then 'trt_sh' else 'trt_cp' end as pert_type,
  case when plate = 4 then 'PC3' else 'MCF7' end as cell_id,
  case when plate = 3 then cast(3 as double) else cast(10 as double) end as pert_dose,
  case when plate = 2 then 'µm' else 'µM' end as pert_dose_unit,
  case when l_linestatus = 'F' then '6 h' else '24 h' end as pert_itime
from {assay}
"""

GENE_INFO_SQL = """
select distinct concat('g:', p_brand, '/', p_type) as pr_gene_id,
  concat(p_brand, '/', p_type) as pr_gene_symbol,
  case when p_type = 'ECONOMY' then 0 else 1 end as pr_is_lm
from {part}
"""

PERT_INFO_SQL = """
select pert_iname, concat('C', cast(s_nationkey as varchar(20)), 'O') as canonical_smiles,
  concat('CID', cast(s_suppkey as varchar(20))) as pubchem_cid
from {compound_key} where s_suppkey % 37 <> 5
"""

REPURPOSING_SQL = """
select pert_iname,
  case s_nationkey % 5 when 1 then 'HDAC inhibitor' when 2 then 'proteasome inhibitor'
    when 3 then 'adrenergic agonist' else 'ion channel blocker' end as moa,
  concat('T', cast(s_nationkey as varchar(20))) as target
from {compound_key} where s_nationkey % 5 <> 0
"""

MATRIX_LONG_SQL = """
select gene_id, sig_id, case when max(z) >= -min(z) then max(z) else min(z) end as z_score
from {assay} group by gene_id, sig_id
"""

# The literature corpus: the documents, and one note per order that names the
# compounds reported from it. A compound with key k is reported from every
# (1 + k*k % 997)-th of its orders, so counts range from none to hundreds.
NOTES_SQL = """
select -1 - l_orderkey as doc_id, concat('Assay note ', cast(l_orderkey as varchar(20)), ': ', n.pert_iname, ' was tested.') as text
from (select l_orderkey, max(k.pert_iname) as pert_iname
      from {lineitem} join {compound_key} k on k.s_suppkey = l_suppkey
      where l_orderkey % (1 + l_suppkey * l_suppkey % 997) = 0 group by l_orderkey) n
"""

# Result pages: the landed pages with the fields of a search result, of one
# article, or neither, by page number.
RESULT_PAGES_SQL = """
select page_id, case page_id % 3
  when 0 then concat(html, '<div class="results-amount"><span class="value">', case when page_id % 2 = 0 then '1,' else '' end,
                     cast(100 + page_id % 900 as varchar(20)), '</span> results</div>')
  when 1 then concat('<div class="article-page"><h1 class="heading-title"> Study <i>no. ', cast(page_id as varchar(20)),
                     '</i> &amp; notes </h1><span class="cit">', cast(4000 + page_id as varchar(20)), ' <b>',
                     cast(1980 + page_id % 40 as varchar(20)), '</b> Jan;</span></div>', html)
  else html end as html
from {pages}
"""

# Literals of the binding (FIXTURES.md §3) — fixed values.
REFERENCE_COMPOUND = "Supplier#000000007"
MARKER_GENES = ("Brand#19/MEDIUM", "Brand#18/STANDARD")
LITERATURE_TERMS = ("retion", "achach", "aebccd", "zzzzzz", "Supplier#000000007", "brd-k00000003", "Assay note", "was tested", "éaux")

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
                 "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, text)`` of the literature corpus."""
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    compound_key = spark.sql(COMPOUND_KEY_SQL, supplier=read_table(spark, sf_dir, "supplier"))
    lineitem = read_table(spark, sf_dir, "lineitem")
    return documents.unionByName(spark.sql(NOTES_SQL, lineitem=lineitem, compound_key=unsent(compound_key)))


def result_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(RESULT_PAGES_SQL, pages=read_table(spark, sf_dir, "pages"))


def _readouts(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """The lineitem rows that differ in what a row of ``sig_info`` is made of
    (supplier, line status, plate), each with a part that exists: enough for its
    assay, whose joins then read a row per signature and not one per cell."""
    measured = joined(lineitem, part.select(F.col("p_partkey").alias("l_partkey")), "l_partkey", "left_semi")
    return measured.groupBy("l_suppkey", "l_linestatus", (F.col("l_orderkey") % 5).alias("l_orderkey")).agg(
        F.min("l_partkey").alias("l_partkey"), F.min("l_quantity").alias("l_quantity"))


def bind_inputs(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Lazy DataFrames for the five reference inputs over the driver tables."""
    supplier = read_table(spark, sf_dir, "supplier")
    part = read_table(spark, sf_dir, "part")
    lineitem = read_table(spark, sf_dir, "lineitem")
    compound_key = spark.sql(COMPOUND_KEY_SQL, supplier=supplier)
    sides = {"part": unsent(part), "compound_key": unsent(compound_key)}
    assay = spark.sql(ASSAY_SQL, lineitem=lineitem, **sides)
    readouts = spark.sql(ASSAY_SQL, lineitem=_readouts(lineitem, part), **sides)
    return {
        "gene_info": spark.sql(GENE_INFO_SQL, part=part),
        "sig_info": spark.sql(SIG_INFO_SQL, assay=readouts),
        "pert_info": spark.sql(PERT_INFO_SQL, compound_key=compound_key),
        "repurposing": spark.sql(REPURPOSING_SQL, compound_key=compound_key),
        "matrix_long": spark.sql(MATRIX_LONG_SQL, assay=assay),
    }
