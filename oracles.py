"""DuckDB oracle SQL, one statement per registered query.

Each statement starts from the driver's pre-registered tables and rebuilds
the binding views of FIXTURES.md §3 as CTEs, then answers the question the
plain-SQL way (join first, then group), independently of the Spark plans.
Column names equal the Spark outputs; averages are rounded to 6 decimals
and top-k orders carry the same name tie-breaker.
"""

from __future__ import annotations

from sigspark.config import GENE_FUNCTIONS
from sigspark.sources.binding import LITERATURE_TERMS, MARKER_GENES, REFERENCE_COMPOUND

_BASE = {
    "compound_key": """
select s_suppkey, s_nationkey,
  case when s_suppkey % 30 = 1 then concat('brd-x', lpad(cast(s_suppkey as varchar(20)), 6, '0'))
       when s_suppkey % 3 = 0 then concat('BRD-K', lpad(cast(s_suppkey as varchar(20)), 8, '0'))
       else s_name end as pert_iname
from supplier""",
    "assay": """
select k.pert_iname, l_suppkey, l_linestatus, l_orderkey % 5 as plate,
  concat(cast(l_suppkey as varchar(20)), ':', l_linestatus, ':', cast(l_orderkey % 5 as varchar(20))) as sig_id,
  concat('g:', p_brand, '/', p_type) as gene_id,
  cast(10 as double) * (cast(2 + l_suppkey % 9 as double) / cast(10 as double))
    * (case when l_suppkey % 4 = 0 and p_size > 15 then cast(0.1 as double) else cast(1 as double) end)
    * u*u*u*u*u*u*u*u*u as z
from (select *, (l_quantity - cast(25.5 as double)) / cast(24.5 as double) as u from lineitem) x
join part on p_partkey = l_partkey
join compound_key k on k.s_suppkey = l_suppkey""",
    "sig_info": """
select distinct sig_id, pert_iname,
  case when l_suppkey % 10 = 9 then 'trt_sh' else 'trt_cp' end as pert_type,
  case when plate = 4 then 'PC3' else 'MCF7' end as cell_id,
  case when plate = 3 then cast(3 as double) else cast(10 as double) end as pert_dose,
  case when plate = 2 then 'µm' else 'µM' end as pert_dose_unit,
  case when l_linestatus = 'F' then '6 h' else '24 h' end as pert_itime
from assay""",
    "gene_info": """
select distinct concat('g:', p_brand, '/', p_type) as pr_gene_id,
  concat(p_brand, '/', p_type) as pr_gene_symbol,
  case when p_type = 'ECONOMY' then 0 else 1 end as pr_is_lm
from part""",
    "pert_info": """
select pert_iname, concat('C', cast(s_nationkey as varchar(20)), 'O') as canonical_smiles,
  concat('CID', cast(s_suppkey as varchar(20))) as pubchem_cid
from compound_key where s_suppkey % 37 <> 5""",
    "repurposing": """
select pert_iname,
  case s_nationkey % 5 when 1 then 'HDAC inhibitor' when 2 then 'proteasome inhibitor'
    when 3 then 'adrenergic agonist' else 'ion channel blocker' end as moa,
  concat('T', cast(s_nationkey as varchar(20))) as target
from compound_key where s_nationkey % 5 <> 0""",
    "matrix_long": """
select gene_id, sig_id, case when max(z) >= -min(z) then max(z) else min(z) end as z_score
from assay group by gene_id, sig_id""",
    "expression": """
select si.pert_iname, m.sig_id, g.pr_gene_symbol, m.z_score
from matrix_long m
join sig_info si on si.sig_id = m.sig_id
join gene_info g on g.pr_gene_id = m.gene_id
where g.pr_is_lm = 1 and si.cell_id = 'MCF7' and si.pert_dose = 10
  and si.pert_dose_unit in ('µm', 'µM') and si.pert_type = 'trt_cp'""",
    "genetic_signatures": """
select pert_iname, sig_id, pr_gene_symbol, z_score, 1 as is_significant
from expression where abs(z_score) >= 2.0""",
    "compound_metadata": """
select p.pert_iname, r.moa, r.target, p.canonical_smiles, p.pubchem_cid
from pert_info p left join repurposing r on r.pert_iname = p.pert_iname
where p.pert_iname in (select pert_iname from expression)""",
}

REF = REFERENCE_COMPOUND
G1, G2 = MARKER_GENES


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def q(body: str, **ctes: str) -> str:
    """Base binding CTEs, then query-specific CTEs, then ``body``."""
    parts = [f"{name} as ({sql.strip()})" for name, sql in {**_BASE, **ctes}.items()]
    return "with " + ",\n".join(parts) + "\n" + body.strip()


J = "compound_metadata m join genetic_signatures s on m.pert_iname = s.pert_iname"

_LEADS_ALL = f"""
select m.pert_iname, m.moa, m.canonical_smiles, m.pubchem_cid,
       max(abs(s.z_score)) as max_potency, count(distinct s.pr_gene_symbol) as total_gene_hits
from {J}
group by m.pert_iname, m.moa, m.canonical_smiles, m.pubchem_cid
having count(distinct s.pr_gene_symbol) <= 50 and max(abs(s.z_score)) >= 8.0"""

_LEADS_TOP = "select * from leads_all order by max_potency desc, pert_iname asc limit 10"

ORACLE: dict[str, str] = {}

ORACLE["precision_leads"] = q("select * from leads_top", leads_all=_LEADS_ALL, leads_top=_LEADS_TOP)

_TOP7 = """
select s.pr_gene_symbol from genetic_signatures s join leads_top t on s.pert_iname = t.pert_iname
where abs(s.z_score) >= 2.0 group by s.pr_gene_symbol order by count(*) desc, s.pr_gene_symbol limit 7"""
_TOP20 = """
select pr_gene_symbol from genetic_signatures where abs(z_score) >= 2.0
group by pr_gene_symbol order by count(*) desc, pr_gene_symbol limit 20"""
_LEADS = {"leads_all": _LEADS_ALL, "leads_top": _LEADS_TOP}


def _by_rank(top: str, n: int) -> str:
    """Mean Z per lead, one column per rank of the gene list ``top`` (which ends in its order and limit)."""
    values = ", ".join(f"max(case when rn = {i} then v end) as gene_{i}" for i in range(1, n + 1))
    names = ", ".join(f"(select pr_gene_symbol from g where rn = {i}) as gene_{i}_symbol" for i in range(1, n + 1))
    ranked = top.replace("pr_gene_symbol from", "pr_gene_symbol, row_number() over (order by count(*) desc, {}pr_gene_symbol) as rn from".format(
        "s." if "s.pr_gene_symbol from" in top else ""), 1)
    return q(f"select pert_iname, {values}, {names} from c group by pert_iname", **_LEADS, g=ranked, c=f"""
select m.pert_iname, g.rn, round(avg(s.z_score), 6) as v from {J}
join leads_top t on t.pert_iname = m.pert_iname join g on g.pr_gene_symbol = s.pr_gene_symbol group by m.pert_iname, g.rn""")


_DISEASE = f"select * from (values ({_lit(G1)}, 1), ({_lit(G2)}, -1)) t(pr_gene_symbol, direction)"
_QC = f"""
select m.pert_iname, m.moa, s.pr_gene_symbol, round(avg(s.z_score), 6) as avg_z from {J}
where s.pr_gene_symbol in ({_lit(G1)}, {_lit(G2)}) group by m.pert_iname, m.moa, s.pr_gene_symbol
having avg(s.z_score) > 4.0"""

ORACLE.update({
    "strongest_hits": q(f"""
select m.pert_iname, m.moa, s.pr_gene_symbol, s.z_score from {J}
order by s.z_score desc, m.pert_iname, s.pr_gene_symbol, s.sig_id limit 5"""),
    "single_target_up": q(f"""
select m.pert_iname, s.z_score from {J} where s.pr_gene_symbol = {_lit(G1)} and s.z_score > 2.0
order by s.z_score desc, m.pert_iname, s.sig_id limit 10"""),
    "reversal_signature": q(f"""
select pert_iname, avg_impact from (
  select m.pert_iname, round(avg(s.z_score), 6) as avg_impact from {J}
  where s.pr_gene_symbol in ({_lit(G1)}, {_lit(G2)}) and s.z_score > 2.0
  group by m.pert_iname having count(distinct s.pr_gene_symbol) = 2) x
order by avg_impact desc, pert_iname limit 10"""),
    "reversal_general": q(f"""
select m.pert_iname, count(distinct s.pr_gene_symbol) as genes_reversed,
       round(avg(-d.direction * s.z_score), 6) as reversal_score
from {J} join disease d on d.pr_gene_symbol = s.pr_gene_symbol
where -d.direction * s.z_score > 2.0
group by m.pert_iname
having count(distinct s.pr_gene_symbol) = (select count(distinct pr_gene_symbol) from disease)""",
                          disease=_DISEASE),
    "moa_mimics": q(f"""
select m.pert_iname, m.moa, count(*) as matching_gene_count from {J}
where s.pr_gene_symbol in (select pr_gene_symbol from genetic_signatures where pert_iname = {_lit(REF)} and z_score > 3.0)
  and s.z_score > 3.0 and m.pert_iname != {_lit(REF)}
group by m.pert_iname, m.moa order by matching_gene_count desc, m.pert_iname limit 10"""),
    "toxicity_extreme_hits": q(f"""
select m.pert_iname, count(*) as extreme_hit_count from {J} where abs(s.z_score) > 4.0
group by m.pert_iname order by extreme_hit_count desc, m.pert_iname limit 20"""),
    "safety_profile": q(f"""
select s.pr_gene_symbol, s.z_score from {J} where m.pert_iname = {_lit(REF)} and abs(s.z_score) >= 2.0
order by s.z_score desc"""),
    "risk_filter": q(f"""
select m.pert_iname, m.moa, count(distinct case when abs(s.z_score) > 4.0 then s.pr_gene_symbol end) as extreme_genes
from {J} group by m.pert_iname, m.moa
having count(distinct case when abs(s.z_score) > 4.0 then s.pr_gene_symbol end) <= 30"""),
    "risk_filter_genes": q(f"""
select m.pert_iname, m.moa, count(distinct case when abs(s.z_score) > 4.0 then s.pr_gene_symbol end) as extreme_genes
from {J}
where m.pert_iname not in (select pert_iname from genetic_signatures
                           where abs(z_score) >= 2.0 and pr_gene_symbol in ({_lit(G2)}))
group by m.pert_iname, m.moa
having count(distinct case when abs(s.z_score) > 4.0 then s.pr_gene_symbol end) <= 30"""),
    "potency_benchmark": q(f"""
select m.pert_iname, m.moa, max(abs(s.z_score)) as max_potency from {J}
group by m.pert_iname, m.moa order by max_potency desc, m.pert_iname limit 10"""),
    "master_regulators": q("""
select pr_gene_symbol, count(*) as frequency from genetic_signatures where abs(z_score) > 2.0
group by pr_gene_symbol order by frequency desc, pr_gene_symbol limit 15"""),
    "master_regulators_by_freq": q("""
select pr_gene_symbol, count(*) as frequency from genetic_signatures where abs(z_score) >= 2.0
group by pr_gene_symbol having count(*) > 15"""),
    "repurposing_efficiency": q(f"""
select m.pert_iname, m.moa, count(distinct s.pr_gene_symbol) as genes_regulated from {J}
where m.pert_iname not ilike 'BRD-%' and abs(s.z_score) > 3.0
group by m.pert_iname, m.moa order by genes_regulated desc, m.pert_iname limit 10"""),
    "drug_type_counts": q(f"""
select case when m.pert_iname ilike 'BRD-%' then 'Unknown (BRD Compound)' else 'Known/Approved Drug' end as drug_type,
       count(*) as hit_count
from {J} group by 1"""),
    "precision_vs_power": q(f"""
select m.pert_iname, max(abs(s.z_score)) as max_potency, count(distinct s.pr_gene_symbol) as affected_genes
from {J} group by m.pert_iname"""),
    "ideal_zone": q(f"""
select m.pert_iname, max(abs(s.z_score)) as max_potency, count(distinct s.pr_gene_symbol) as affected_genes,
       count(distinct s.pr_gene_symbol) between 0 and 50 as in_ideal_zone
from {J} group by m.pert_iname"""),
    "class_validation": q("select * from qc order by pert_iname", qc=_QC),
    "class_distribution": q(f"""
select qc.pert_iname, qc.moa, qc.pr_gene_symbol, qc.avg_z, qc.pert_iname in ({_lit(REF)}) as is_member,
       g.gene_n, g.gene_q1, g.gene_median, g.gene_q3
from qc join (select pr_gene_symbol, count(*) as gene_n,
                     round(quantile_cont(avg_z, 0.25), 6) as gene_q1,
                     round(quantile_cont(avg_z, 0.5), 6) as gene_median,
                     round(quantile_cont(avg_z, 0.75), 6) as gene_q3
              from qc group by pr_gene_symbol) g on g.pr_gene_symbol = qc.pr_gene_symbol""", qc=_QC),
    "lead_gene_detail": q(f"""
select m.pert_iname, m.moa, s.pr_gene_symbol, s.z_score from {J}
join leads_top t on t.pert_iname = m.pert_iname where abs(s.z_score) >= 2.0""", **_LEADS),
    "lead_fingerprint": q(f"""
select m.pert_iname, s.pr_gene_symbol, round(avg(s.z_score), 6) as mean_z from {J}
join leads_top t on t.pert_iname = m.pert_iname join top20 g on g.pr_gene_symbol = s.pr_gene_symbol
group by m.pert_iname, s.pr_gene_symbol""", **_LEADS, top20=_TOP20),
    "final_matrix": q(f"""
select m.pert_iname, m.moa, s.pr_gene_symbol, s.z_score from {J}
join leads_top t on m.pert_iname = t.pert_iname join top7 g on s.pr_gene_symbol = g.pr_gene_symbol""",
                      **_LEADS, top7=_TOP7),
    "final_matrix_mean": q(f"""
select m.pert_iname, m.moa, s.pr_gene_symbol, round(avg(s.z_score), 6) as mean_z from {J}
join leads_top t on m.pert_iname = t.pert_iname join top7 g on s.pr_gene_symbol = g.pr_gene_symbol
group by m.pert_iname, m.moa, s.pr_gene_symbol""", **_LEADS, top7=_TOP7),
    "lead_fingerprint_pivot": _by_rank(_TOP20, 20),
    "final_matrix_pivot": _by_rank(_TOP7, 7),
    "compound_category": q("""
select pert_iname, moa,
  case when moa is null or moa = '' or moa = 'None' then 'Novel Mechanism'
       when lower(moa) like '%inhibitor%' then 'Targeted Suppressor'
       when lower(moa) like '%agonist%' then 'Pathway Activator'
       else 'Complex Regulator' end as category
from compound_metadata"""),
    "gene_function_label": q("""
select g.pr_gene_symbol, coalesce(lk.fn, 'Targeted Regulation') as gene_function,
       coalesce(lk.fn, 'Targeted Regulation') || chr(10) || '(' || g.pr_gene_symbol || ')' as gene_label
from (select distinct pr_gene_symbol from genetic_signatures) g left join lk on lk.sym = g.pr_gene_symbol""",
                             lk="select * from (values " + ", ".join(
                                 f"({_lit(k)}, {_lit(v)})" for k, v in GENE_FUNCTIONS.items()) + ") t(sym, fn)"),
})

# ----------------------------------------------------------------------------- shared CTEs
_TARGET = "cell_id = 'MCF7' and pert_dose = 10 and pert_dose_unit in ('µm', 'µM')"
_EXPR_FLAG = """
select pert_iname, sig_id, pr_gene_symbol, z_score,
       case when z_score >= 2.0 or z_score <= -2.0 then 1 else 0 end as is_significant
from expression"""
_TM = """
select s.pert_iname, si.pert_itime, max(abs(s.z_score)) as max_potency,
       count(distinct s.pr_gene_symbol) as affected_genes
from genetic_signatures s join sig_info si on si.sig_id = s.sig_id and si.pert_iname = s.pert_iname
where abs(s.z_score) >= 2.0 and si.pert_itime in ('6 h', '24 h')
group by s.pert_iname, si.pert_itime"""
_TP = """
select pert_iname, Max_Potency_6h, Max_Potency_24h, Affected_Genes_6h, Affected_Genes_24h,
       Affected_Genes_24h - Affected_Genes_6h as Gene_Delta
from (select pert_iname,
        max(case when replace(pert_itime, ' ', '') = '6h' then max_potency end) as Max_Potency_6h,
        max(case when replace(pert_itime, ' ', '') = '24h' then max_potency end) as Max_Potency_24h,
        max(case when replace(pert_itime, ' ', '') = '6h' then affected_genes end) as Affected_Genes_6h,
        max(case when replace(pert_itime, ' ', '') = '24h' then affected_genes end) as Affected_Genes_24h
      from tm group by pert_iname) x"""
_TIME = {"tm": _TM, "tp": _TP}
_E7 = f"""
select m.pert_iname, max(abs(s.z_score)) as max_potency, count(distinct s.pr_gene_symbol) as affected_genes
from {J} group by m.pert_iname"""
_FEATURES = f"""
select m.pert_iname, count(distinct s.pr_gene_symbol) as biomarker_count,
       round(avg(abs(s.z_score)), 6) as avg_response, max(abs(s.z_score)) as max_response,
       round(stddev_samp(s.z_score), 6) as response_variability
from {J} where s.is_significant = 1 group by m.pert_iname"""


def _profile(p: str, g: str) -> str:
    return (f"case when {p} >= 8.0 and {g} <= 50 then 'Precision_Lead' "
            f"when {p} >= 8.0 and {g} > 50 then 'Broad_Spectrum' "
            f"when {p} >= 3.0 and {p} < 8.0 then 'Moderate_Impact' "
            f"when {p} < 3.0 then 'Low_Activity' else 'Unknown' end")


def _triage(delta: int) -> str:
    return (f"case when Gene_Delta >= {delta} then 'Cascade Inducer (Chronic/Systemic)' "
            "when Affected_Genes_6h > 25 and Gene_Delta <= 0 then 'Rapid Responder (Acute/Targeted)' "
            f"when Gene_Delta > 0 and Gene_Delta < {delta} then 'Gradual Modulator (Steady State)' "
            "else 'Sustained Shock (Stable Profile)' end")


def _maturity(c: str) -> str:
    return (f"case when {c} is null then 'Error' when {c} > 100 then 'Highly Established' "
            f"when {c} >= 1 then 'Emerging' else 'Novel IP (Unpatented)' end")


_NOVELTY = ("case when publication_count is null or publication_count < 0 then 'error' "
            "when publication_count < 5 then 'novel' else 'established' end")
_RISK = "case when publication_count > 50 then 'LOW' when publication_count > 10 then 'MEDIUM' else 'HIGH' end"
_CORPUS = """
select doc_id, text from documents
union all
select -1 - l_orderkey, concat('Assay note ', cast(l_orderkey as varchar(20)), ': ', max(k.pert_iname), ' was tested.')
from lineitem join compound_key k on k.s_suppkey = l_suppkey
where l_orderkey % (1 + l_suppkey * l_suppkey % 997) = 0 group by l_orderkey"""
_WORDS = "unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+(?:-[\\p{L}\\p{N}]+)*'))"
_TOK = f"select distinct doc_id, {_WORDS} as w from corpus"
_BC = {
    "bterms": f"select distinct {_WORDS} as term from benchmark",
    "corpus": _CORPUS,
    "tok": _TOK,
    "bc": """select t.term, count(tok.doc_id) as publication_count
             from bterms t left join tok on tok.w = t.term group by t.term""",
}


def _norm_name(c: str) -> str:
    return f"' ' || trim(regexp_replace(lower({c}), '[^\\p{{L}}\\p{{N}}-]+', ' ', 'g')) || ' '"


def _papers(names: str, col: str) -> dict[str, str]:
    """Documents that hold a name as a run of whole words: both sides lower-cased, other characters as one blank."""
    norm = _norm_name
    return {"corpus": _CORPUS, "lit_names": names, "flat": f"select doc_id, {norm('text')} as t from corpus",
            "lit": f"""select n.{col}, count(f.doc_id) as papers from (select distinct {col} from lit_names) n
                       left join flat f on contains(f.t, {norm('n.' + col)}) group by n.{col}"""}


_LEAD_B = {
    **_LEADS,
    "lead_b": f"""
select pert_iname, moa, cast(null as varchar) as canonical_smiles, cast(null as varchar) as pubchem_cid,
       cast(null as double) as max_potency, cast(null as bigint) as total_gene_hits
from compound_metadata where pert_iname = {_lit(REF)}
union all
select pert_iname, moa, canonical_smiles, pubchem_cid, max_potency, total_gene_hits from leads_top""",
}
_EXEC = {
    **_LEAD_B,
    **_papers("select pert_iname from lead_b", "pert_iname"),
}
_EXEC_BODY = f"""
select b.*, lit.papers as pubmed_papers, {_maturity('lit.papers')} as research_maturity
from lead_b b left join lit on lit.pert_iname = b.pert_iname"""
_MERGE = {
    **_LEADS,
    "lc": "select pert_iname, moa, max_potency, total_gene_hits from leads_all",
    "e7": _E7,
    "pm": """select m.moa, count(*) as n_compounds, max(p.max_potency) as max_potency
             from e7 p join compound_metadata m on m.pert_iname = p.pert_iname group by m.moa""",
}


def _merge(how: str) -> str:
    key = "coalesce(l.moa, r.moa)" if how in ("right", "full") else "l.moa"
    join = {"inner": "join", "left": "left join", "right": "right join", "full": "full join"}[how]
    return q(f"""
select l.pert_iname, {key} as moa, l.max_potency as max_potency_x, l.total_gene_hits,
       r.n_compounds, r.max_potency as max_potency_y
from lc l {join} pm r on l.moa is not distinct from r.moa""", **_MERGE)


def _quality(table: str, cols: list[str]) -> str:
    nulls = " + ".join(f"sum(case when {c} is null then 1 else 0 end)" for c in cols)
    shares = ", ".join(f"sum(case when {c} is null then 1 else 0 end) * 1.0 / count(*)" for c in cols)
    return q(f"""
select n_rows, {len(cols)} as n_columns, total_nulls, duplicates, round(duplicates * 1.0 / n_rows, 6) as duplicate_ratio,
       worst > 0.1 as warn_nulls, duplicates * 1.0 / n_rows > 0.05 as warn_duplicates
from (select count(*) as n_rows, cast({nulls} as bigint) as total_nulls,
             count(*) - (select count(*) from (select distinct {', '.join(cols)} from {table}) d) as duplicates,
             greatest({shares}) as worst
      from {table}) x""")


_RESULT_PAGES = """
select page_id, case page_id % 3
  when 0 then concat(html, '<div class="results-amount"><span class="value">', case when page_id % 2 = 0 then '1,' else '' end,
                     cast(100 + page_id % 900 as varchar(20)), '</span> results</div>')
  when 1 then concat('<div class="article-page"><h1 class="heading-title"> Study <i>no. ', cast(page_id as varchar(20)),
                     '</i> &amp; notes </h1><span class="cit">', cast(4000 + page_id as varchar(20)), ' <b>',
                     cast(1980 + page_id % 40 as varchar(20)), '</b> Jan;</span></div>', html)
  else html end as html
from pages"""


def _element(tag: str, attrs: str = "") -> str:
    """Text of the first such element: tags out, references decoded, blanks as one."""
    inner = f"regexp_replace(regexp_extract(html, '(?s)<{tag}{attrs}[^>]*>(.*?)</{tag}>', 1), '<[^>]*>', '', 'g')"
    for name, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&amp;", "&")):
        inner = f"replace({inner}, '{name}', '{char}')"
    return f"trim(regexp_replace({inner}, '\\s+', ' ', 'g'))"


_PAGE_COUNT = f"""try_cast(replace(nullif({_element('span', '[^>]*class="value"')}, ''), ',', '') as bigint)"""
_LI_COLS = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice"
_LI_ORDER = "l_partkey, l_suppkey, l_shipdate, l_quantity, l_extendedprice"
_CM_COLS = ["pert_iname", "moa", "target", "canonical_smiles", "pubchem_cid"]
_REVERSAL = f"""
select m.pert_iname from {J} join disease d on d.pr_gene_symbol = s.pr_gene_symbol
where -d.direction * s.z_score > 2.0 group by m.pert_iname
having count(distinct s.pr_gene_symbol) = (select count(distinct pr_gene_symbol) from disease)"""

ORACLE.update({
    # A
    "read_matrix_tsv": q("select gene_id, sig_id, z_score from matrix_long"),
    "read_matrix_parquet": q("select gene_id, sig_id, z_score from matrix_long"),
    "read_metadata_tsv": q("select * from sig_info"),
    "read_commented_tsv": q("select * from repurposing"),
    "read_pruned": q("select sig_id, pert_iname, pert_itime from sig_info"),
    "save_tables": q("""
select 'compound_metadata' as table_name, count(*) as n_rows from compound_metadata
union all select 'genetic_signatures', count(*) from genetic_signatures"""),
    "export_reports": q("select * from leads_top", **_LEADS),
    "export_gene_hits": ORACLE["lead_gene_detail"],
    "append_new_compounds": q("select * from compound_metadata"),
    "append_new_signatures": q(_EXPR_FLAG),
    "stream_append_signatures": q(_EXPR_FLAG),
    # B
    "landmark_genes": q("select pr_gene_id, pr_gene_symbol from gene_info where pr_is_lm = 1"),
    "target_signatures": q(f"select * from sig_info where {_TARGET}"),
    "treatment_only": q("select * from matrix_long where sig_id in (select sig_id from sig_info where pert_type = 'trt_cp')"),
    "valid_ids": q(f"""
select 'gene' as axis, id from (select pr_gene_id as id from gene_info where pr_is_lm = 1
                                intersect select gene_id from matrix_long) g
union all
select 'signature', id from (select sig_id as id from sig_info where {_TARGET}
                             intersect select sig_id from matrix_long) s"""),
    "extract_submatrix": q(f"""
select * from matrix_long
where gene_id in (select pr_gene_id from gene_info where pr_is_lm = 1)
  and sig_id in (select sig_id from sig_info where {_TARGET} and pert_type = 'trt_cp')"""),
    "melt_wide_to_long": q("""
select pert_iname, 'Max_Potency_6h' as time_point, Max_Potency_6h as max_potency from tp
union all select pert_iname, 'Max_Potency_24h', Max_Potency_24h from tp""", **_TIME),
    "stack_matrix": q("""
select * from (select pert_iname, 'Max_Potency_6h' as time_point, Max_Potency_6h as max_potency from tp
               union all select pert_iname, 'Max_Potency_24h', Max_Potency_24h from tp) x
where max_potency is not null""", **_TIME),
    "filter_by_z_score": q("select * from expression where abs(z_score) >= 2.0"),
    "significance_flag": q(_EXPR_FLAG),
    "z_tier": q("""
select pert_iname, sig_id, pr_gene_symbol,
  case when abs(z_score) > 4.0 then 'extreme' when abs(z_score) > 3.0 then 'high_confidence'
       when abs(z_score) > 2.0 then 'significant' else 'not_significant' end as z_tier,
  case when z_score > 0 then 'up' when z_score < 0 then 'down' else 'none' end as direction
from expression"""),
    "dedup_first": q(f"""
select {_LI_COLS} from (select *, row_number() over (partition by l_orderkey, l_linenumber order by {_LI_ORDER}) as rn
                        from lineitem) x where rn = 1"""),
    "dedup_last": q(f"""
select {_LI_COLS} from (select *, row_number() over (partition by l_orderkey, l_linenumber
                        order by l_partkey desc, l_suppkey desc, l_shipdate desc, l_quantity desc,
                                 l_extendedprice desc) as rn from lineitem) x where rn = 1"""),
    "dedup_none": q(f"""
select {_LI_COLS} from (select *, count(*) over (partition by l_orderkey, l_linenumber) as n from lineitem) x
where n = 1"""),
    "safe_cast": q("""
select event_id, coalesce(cast(regexp_extract(props, '"k": (-?[0-9]+)', 1) as integer), 0) as k from events"""),
    "coerce_numeric": q("""
select page_id, string_split(url, '/')[-1] as segment, try_cast(string_split(url, '/')[-1] as double) as value
from pages"""),
    "preview_rows": q("select * from genetic_signatures order by pert_iname, sig_id, pr_gene_symbol limit 20"),
    "masked_fingerprint": q("""
select pert_iname, pr_gene_symbol, case when abs(round(avg(z_score), 6)) >= 2.0 then round(avg(z_score), 6) end as mean_z
from expression group by pert_iname, pr_gene_symbol"""),
    "report_index": q("select *, row_number() over (order by pert_iname) - 1 as report_index from e7", e7=_E7),
    # C
    "fact_dim_join": q(f"select m.*, s.sig_id, s.pr_gene_symbol, s.z_score, s.is_significant from {J}"),
    "attach_gene_symbol": q("""
select m.sig_id, m.z_score, g.pr_gene_symbol from matrix_long m left join gene_info g on g.pr_gene_id = m.gene_id"""),
    "attach_compound": q("select m.*, si.pert_iname from matrix_long m left join sig_info si on si.sig_id = m.sig_id"),
    "combine_metadata": q("""
select p.pert_iname, r.moa, r.target, p.canonical_smiles, p.pubchem_cid
from pert_info p left join repurposing r on r.pert_iname = p.pert_iname"""),
    "build_compound_metadata": q("select * from compound_metadata"),
    "create_compound_metadata": q("select pert_iname, canonical_smiles, pubchem_cid from pert_info"),
    "orphaned_signatures": q("""
select * from genetic_signatures where pert_iname not in (select pert_iname from compound_metadata)"""),
    "merge_inner": _merge("inner"),
    "merge_left": _merge("left"),
    "merge_right": _merge("right"),
    "merge_outer": _merge("full"),
    "lead_literature_report": q("""
select t.*, lit.papers as pubmed_papers from leads_top t left join lit on lit.pert_iname = t.pert_iname""",
                                **_LEADS, **_papers("select pert_iname from leads_top", "pert_iname")),
    # D
    "gene_statistics": q("""
select pr_gene_symbol, count(distinct pert_iname) as compound_count, round(avg(abs(z_score)), 6) as avg_abs_z_score,
       max(abs(z_score)) as max_abs_z_score, min(abs(z_score)) as min_abs_z_score, count(*) as total_occurrences
from genetic_signatures where is_significant = 1 group by pr_gene_symbol"""),
    "compound_profile_summary": q("""
select m.*, cast(coalesce(x.sig, 0) as bigint) as significant_hits, cast(coalesce(x.n, 0) as bigint) as total_affected_genes
from compound_metadata m left join (
  select pert_iname, sum(case when is_significant = 1 then 1 else 0 end) as sig, count(*) as n
  from genetic_signatures group by pert_iname) x on x.pert_iname = m.pert_iname"""),
    "compound_profile_detail": q(f"select * from genetic_signatures where pert_iname = {_lit(REF)}"),
    "integrity_report": q("""
select compound_count, signature_count, significant_count, orphaned_signatures,
       round(case when signature_count > 0 then cast(significant_count as double) * 100.0 / signature_count
                  else 0 end, 6) as significant_percentage
from (select (select count(*) from compound_metadata) as compound_count,
             (select count(*) from genetic_signatures) as signature_count,
             (select count(*) from genetic_signatures where is_significant = 1) as significant_count,
             (select count(*) from genetic_signatures
              where pert_iname not in (select pert_iname from compound_metadata)) as orphaned_signatures) x"""),
    "quality_report": _quality("compound_metadata", _CM_COLS),
    "quality_report_lineitem": _quality("lineitem", ["l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus"]),
    "null_profile": q(" union all ".join(
        f"select '{c}' as \"column\", cast(sum(case when {c} is null then 1 else 0 end) as bigint) as null_count, "
        f"round(sum(case when {c} is null then 1 else 0 end) * 100.0 / count(*), 2) as null_pct "
        f"from compound_metadata" for c in _CM_COLS)),
    "quality_gates": q("""
select round(worst, 6) as max_null_share, round(dups * 1.0 / n, 6) as duplicate_share, round(z_mean, 6) as z_mean,
       round(z_sd, 6) as z_sd, orphaned_signatures, worst < 0.1 as nulls_ok, dups * 1.0 / n < 0.05 as duplicates_ok,
       abs(z_mean) <= 0.5 as mean_ok, z_sd between 0.5 and 2.0 as sd_ok, orphaned_signatures = 0 as no_orphans
from (select count(*) as n, avg(z_score) as z_mean, stddev_samp(z_score) as z_sd,
             greatest(sum(case when pert_iname is null then 1 else 0 end) * 1.0 / count(*),
                      sum(case when sig_id is null then 1 else 0 end) * 1.0 / count(*),
                      sum(case when pr_gene_symbol is null then 1 else 0 end) * 1.0 / count(*), 0.0) as worst,
             count(*) - (select count(*) from (select distinct pert_iname, sig_id, pr_gene_symbol from expression) d) as dups,
             (select count(*) from genetic_signatures
              where pert_iname not in (select pert_iname from compound_metadata)) as orphaned_signatures
      from expression) x"""),
    "data_summary": q(f"""
select n as rows, 5 as columns, nulls as null_count,
       round(case when n > 0 then nulls * 100.0 / (n * 5) end, 6) as null_percentage,
       n - (select count(*) from (select distinct * from compound_metadata) d) as duplicates, 'string:5' as dtypes
from (select count(*) as n, cast({' + '.join(f'sum(case when {c} is null then 1 else 0 end)' for c in _CM_COLS)} as bigint) as nulls
      from compound_metadata) x"""),
    "column_statistics": q("""
select count(value) as count, round(avg(value), 6) as mean, round(quantile_cont(value, 0.5), 6) as median,
       round(stddev_samp(value), 6) as std, min(value) as min, max(value) as max,
       round(quantile_cont(value, 0.25), 6) as q1, round(quantile_cont(value, 0.75), 6) as q3,
       round(skewness(value), 6) as skewness, round(kurtosis(value), 6) as kurtosis
from events where value is not null"""),
    "time_point_distribution": q("select pert_itime, count(*) as total_experiments from sig_info group by pert_itime"),
    "profile_distribution": q(f"""
select {_profile('max_response', 'biomarker_count')} as clinical_profile, count(*) as n_compounds
from f group by 1""", f=_FEATURES),
    "extra_time_points": q("""
select distinct case when pert_itime = '6 h' then '3 h' else '48 h' end as pert_itime from sig_info
where cast(string_split(sig_id, ':')[1] as bigint) % 50 = 7"""),
    "outliers_iqr": q("""
select event_id, value, coalesce(value < q1 - 1.5 * (q3 - q1) or value > q3 + 1.5 * (q3 - q1), false) as is_outlier
from events, (select quantile_cont(value, 0.25) as q1, quantile_cont(value, 0.75) as q3 from events) s"""),
    "outliers_zscore": q("""
select event_id, value, coalesce(case when sd > 0 then abs(value - mu) / sd > 1.5 end, false) as is_outlier
from events, (select avg(value) as mu, stddev_pop(value) as sd from events) s"""),
    "normalize_standard": q("""
select g.*, round(case when b <> 0 then (z_score - a) / b end, 6) as z_score_normalized
from genetic_signatures g, (select avg(z_score) as a, stddev_pop(z_score) as b from genetic_signatures) s"""),
    "normalize_minmax": q("""
select g.*, round(case when mx <> mn then (z_score - mn) / (mx - mn) end, 6) as z_score_normalized
from genetic_signatures g, (select min(z_score) as mn, max(z_score) as mx from genetic_signatures) s"""),
    "normalize_robust": q("""
select g.*, round(case when q3 <> q1 then (z_score - med) / (q3 - q1) end, 6) as z_score_normalized
from genetic_signatures g, (select quantile_cont(z_score, 0.25) as q1, quantile_cont(z_score, 0.5) as med,
                                   quantile_cont(z_score, 0.75) as q3 from genetic_signatures) s"""),
    "drug_type_share": q(f"""
select drug_type, hit_count, round(cast(hit_count as double) * 100.0 / sum(hit_count) over (), 6) as share_pct
from (select case when m.pert_iname ilike 'BRD-%' then 'Unknown (BRD Compound)' else 'Known/Approved Drug' end
             as drug_type, count(*) as hit_count from {J} group by 1) x"""),
    "validate_frame": q("select count(*) >= 1 as valid from (select 1 from genetic_signatures limit 1) x"),
    "consensus_signature": q("""
select pert_iname, pr_gene_symbol, round(avg(z_score), 6) as mean_z, count(*) as n_replicates
from genetic_signatures group by pert_iname, pr_gene_symbol"""),
    # E
    "moa_transfer": q("""
select r.pert_iname, r.best_match, r.shared_genes, m.moa as predicted_moa
from (select *, row_number() over (partition by pert_iname order by shared_genes desc, best_match) as rn from sc) r
left join compound_metadata m on m.pert_iname = r.best_match where rn = 1""",
                      pairs=f"select distinct s.pert_iname, s.pr_gene_symbol from {J} where s.z_score > 3.0",
                      sc="""select u.pert_iname, k.pert_iname as best_match, count(*) as shared_genes
                            from pairs u join pairs k on u.pr_gene_symbol = k.pr_gene_symbol
                            where u.pert_iname ilike 'BRD-%' and not k.pert_iname ilike 'BRD-%'
                            group by u.pert_iname, k.pert_iname"""),
    "lead_scorecard": q("""
select b.pert_iname, b.mp >= 8.0 as high_potency, b.ag <= 50 as high_specificity,
       (not b.pert_iname ilike 'BRD-%') or (b.moa is not null and b.moa <> '' and b.moa <> 'None') as moa_clarity,
       b.eg <= 30 as limited_extreme, rev.pert_iname is not null as reversal_match,
       coalesce(abs(tp.Gene_Delta) < 15, false) as stable_over_time, coalesce(lit.papers, 0) < 5 as novel_literature,
       cast(b.mp >= 8.0 as integer) + cast(b.ag <= 50 as integer)
       + cast((not b.pert_iname ilike 'BRD-%') or (b.moa is not null and b.moa <> '' and b.moa <> 'None') as integer)
       + cast(b.eg <= 30 as integer) + cast(rev.pert_iname is not null as integer)
       + cast(coalesce(abs(tp.Gene_Delta) < 15, false) as integer) + cast(coalesce(lit.papers, 0) < 5 as integer)
       as criteria_met
from base b left join rev on rev.pert_iname = b.pert_iname left join tp on tp.pert_iname = b.pert_iname
left join lit on lit.pert_iname = b.pert_iname""",
                        disease=_DISEASE, rev=_REVERSAL, **_TIME,
                        **_papers("select pert_iname from compound_metadata", "pert_iname"),
                        base="""select p.*, m.moa from (
                                  select pert_iname, max(abs(z_score)) as mp, count(distinct pr_gene_symbol) as ag,
                                         count(distinct case when abs(z_score) > 4.0 then pr_gene_symbol end) as eg
                                  from genetic_signatures group by pert_iname) p
                                join compound_metadata m on m.pert_iname = p.pert_iname"""),
    # F
    "literature_counts": q("select term, papers as n_docs from lit", **_papers(
        "select * from (values " + ", ".join(f"({_lit(t)})" for t in LITERATURE_TERMS) + ") t(term)", "term")),
    "document_frequency": q("select w as token, count(*) as n_docs from tok group by w", corpus=_CORPUS, tok=_TOK),
    "literature_search": q(f"""
select n.term as compound, count(p.doc_id) as publication_count,
       coalesce(array_to_string(list_transform(list_slice(list_sort(list(p.doc_id) filter (where p.doc_id is not null)),
                                                          1, 10), lambda x: cast(x as varchar)), ','), '') as pmids,
       {_NOVELTY.replace('publication_count', 'count(p.doc_id)')} as status
from names n left join (
  select k.name, tok.doc_id from (select distinct trim(name) as w, name from names) k join tok on tok.w = k.w
  union all
  select k.name, f.doc_id from (select distinct name from names where contains(trim(name), ' ')) k join flat f on contains(f.t, k.name)
) p on p.name = n.name group by n.term""", **_BC, **{k: v for k, v in _papers("select 1", "term").items() if k == "flat"},
        names=f"select term, {_norm_name('term')} as name from (select term from bterms union select pert_iname from compound_metadata union "
              "select * from (values " + ", ".join(f"({_lit(t)})" for t in LITERATURE_TERMS) + ") t(term))"),
    "research_maturity": q(f"select term, publication_count, {_maturity('publication_count')} as research_maturity from bc",
                           **_BC),
    "novelty_status": q(f"select term, publication_count, {_NOVELTY} as novelty_status from bc", **_BC),
    "novelty_report": q(f"select term, publication_count, {_NOVELTY} as novelty_status, {_RISK} as risk_level from bc",
                        **_BC),
    "novelty_summary": q(f"""
select count(*) as total_compounds, cast(sum(case when st = 'novel' then 1 else 0 end) as bigint) as novel_compounds,
       cast(sum(case when st = 'established' then 1 else 0 end) as bigint) as established_compounds,
       cast(sum(case when st = 'error' then 1 else 0 end) as bigint) as error_compounds,
       round(avg(case when publication_count >= 0 then publication_count end), 6) as avg_publications
from (select publication_count, {_NOVELTY} as st from bc) x""", **_BC),
    "leads_with_benchmark": q("select * from lead_b", **_LEAD_B),
    "page_fields": q(f"""
select page_id, coalesce(nullif({_element('h1', "[^>]*heading-title")}, ''), nullif({_element('h1')}, ''), 'N/A') as title,
       coalesce(nullif(regexp_extract({_element('span', '[^>]*class="cit"')}, '[12][0-9]{{3}}\\b', 0), ''), 'N/A') as year,
       {_PAGE_COUNT} as paper_count, contains(html, 'class="article-page"') as single_article
from result_pages""", result_pages=_RESULT_PAGES),
    "page_maturity": q(f"""
select page_id, papers as pubmed_papers, {_maturity('papers')} as research_maturity
from (select page_id, coalesce({_PAGE_COUNT}, case when contains(html, 'class="article-page"') then 1 else 0 end) as papers
      from result_pages) x""", result_pages=_RESULT_PAGES),
    "leads_by_papers": q(_EXEC_BODY, **_EXEC),
    "executive_report": q(_EXEC_BODY, **_EXEC),
    # G
    "response_features": q("select * from f", f=_FEATURES),
    "time_metrics": q("select tm.* from tm join leads_top t on t.pert_iname = tm.pert_iname", **_TIME, **_LEADS),
    "time_pivot_delta": q("select * from tp", **_TIME),
    "clinical_triage": q(f"select *, {_triage(15)} as Clinical_Profile from tp", **_TIME),
    "clinical_triage_delta10": q(f"select *, {_triage(10)} as Clinical_Profile from tp", **_TIME),
    "late_new_hits": q("""
select distinct pert_iname, pr_gene_symbol from r where pert_itime = '24 h'
except select pert_iname, pr_gene_symbol from r where pert_itime = '6 h'""", r="""
select s.pert_iname, s.pr_gene_symbol, si.pert_itime from genetic_signatures s
join sig_info si on si.sig_id = s.sig_id and si.pert_iname = s.pert_iname where abs(s.z_score) >= 2.0"""),
    "large_shift": q("""
select pert_iname, Gene_Delta, coalesce(abs(Gene_Delta) >= 15, false) as large_shift,
       case when Gene_Delta > 0 then 'expansion' when Gene_Delta < 0 then 'contraction'
            when Gene_Delta = 0 then 'none' end as shift_direction
from tp""", **_TIME),
    "leads_per_time": q("""
select pert_itime, time_rank, pert_iname, max_potency, total_gene_hits
from (select *, row_number() over (partition by pert_itime order by max_potency desc, pert_iname) as time_rank from pt) x
where time_rank <= 10""", pt="""
select si.pert_itime, s.pert_iname, max(abs(s.z_score)) as max_potency, count(distinct s.pr_gene_symbol) as total_gene_hits
from genetic_signatures s join sig_info si on si.sig_id = s.sig_id and si.pert_iname = s.pert_iname
where s.pert_iname in (select pert_iname from compound_metadata)
group by si.pert_itime, s.pert_iname
having count(distinct s.pr_gene_symbol) <= 50 and max(abs(s.z_score)) >= 8.0"""),
    # H
    "profile_rules": q(f"select *, {_profile('max_response', 'biomarker_count')} as clinical_profile from f", f=_FEATURES),
    "training_labels": q(f"""
select pert_iname, cast(biomarker_count as double) as biomarker_count, coalesce(avg_response, 0.0) as avg_response,
       coalesce(max_response, 0.0) as max_response, coalesce(response_variability, 0.0) as response_variability,
       {_profile('max_response', 'biomarker_count')} as rule_profile
from f""", f=_FEATURES),
    "classification_metrics": q("""
select round(sum(case when t = p then 1 else 0 end) * 1.0 / count(*), 6) as accuracy,
       round((select sum(support * prec) from m) / count(*), 6) as precision_weighted,
       round((select sum(support * rec) from m) / count(*), 6) as recall_weighted,
       round((select sum(support * f1) from m) / count(*), 6) as f1_weighted
from pairs""", f=_FEATURES,
                                truth=f"select pert_iname, {_profile('max_response', 'biomarker_count')} as t from f",
                                early_rows="""select s.* from genetic_signatures s join sig_info si
                                              on si.sig_id = s.sig_id and si.pert_iname = s.pert_iname
                                              where si.pert_itime = '6 h'""",
                                early="""select pert_iname, count(distinct pr_gene_symbol) as g, max(abs(z_score)) as mx
                                         from early_rows group by pert_iname""",
                                pairs=f"""select tr.t, case when coalesce(e.g, 0) = 0 then 'Unknown'
                                                  else {_profile('coalesce(e.mx, 0.0)', 'coalesce(e.g, 0)')} end as p
                                          from truth tr left join early e on e.pert_iname = tr.pert_iname""",
                                lab="select t as label from pairs union select p from pairs",
                                per="""select l.label,
                                         cast((select count(*) from pairs where t = l.label) as double) as support,
                                         cast((select count(*) from pairs where p = l.label) as double) as predicted,
                                         cast((select count(*) from pairs where t = l.label and p = l.label) as double) as tp
                                       from lab l""",
                                m="""select support, prec, rec,
                                       case when prec + rec > 0 then 2 * prec * rec / (prec + rec) else 0.0 end as f1
                                     from (select support,
                                             case when predicted > 0 then tp / predicted else 0.0 end as prec,
                                             case when support > 0 then tp / support else 0.0 end as rec from per) x"""),
    "predict_response": q(f"""
select pert_iname, biomarker_count, avg_response, max_response, response_variability,
       case when biomarker_count = 0 then 'Unknown' else {_profile('max_response', 'biomarker_count')} end
       as predicted_profile
from (select n.pert_iname, coalesce(x.g, 0) as biomarker_count, coalesce(x.a, 0.0) as avg_response,
             coalesce(x.mx, 0.0) as max_response, coalesce(x.sd, 0.0) as response_variability
      from (select distinct pert_iname from compound_metadata) n
      left join (select pert_iname, count(distinct pr_gene_symbol) as g, round(avg(abs(z_score)), 6) as a,
                        max(abs(z_score)) as mx, round(stddev_samp(z_score), 6) as sd
                 from genetic_signatures group by pert_iname) x on x.pert_iname = n.pert_iname) y"""),
    "profile_report": q(f"""
select *, {_profile('max_response', 'biomarker_count')} as clinical_profile,
       row_number() over (order by pert_iname) - 1 as temporal_index
from f""", f=_FEATURES),
    # I
    "format_scientific": q("select event_id, printf('%.6e', value) as value_sci from events"),
    "format_percentage": q("select event_id, printf('%.3f%%', value / 1000.0 * 100.0) as value_pct from events"),
    "batch_map": q("select pert_iname, sig_id, pr_gene_symbol, abs(z_score) as abs_z from genetic_signatures"),
    # J
    "ad_hoc_sql": q("""
select s.pert_iname, m.moa, count(*) as strong_hits from genetic_signatures s
join compound_metadata m on m.pert_iname = s.pert_iname where abs(s.z_score) >= 3.0 group by s.pert_iname, m.moa"""),
    # K
    "build_signatures": q("select * from genetic_signatures"),
})


def _counts(phases: dict[str, list[tuple[str, str]]]) -> str:
    """Row counts of other statements (by key, or as text), by phase and output."""
    return " union all ".join(
        f"select '{phase}' as phase, '{output}' as output, (select count(*) from ({ORACLE.get(key, key)}) x) as rows, 'ok' as status"
        for phase, outputs in phases.items() for output, key in outputs)


_ASKED = ("reversal_signature", "moa_mimics", "toxicity_extreme_hits", "potency_benchmark", "master_regulators",
          "repurposing_efficiency", "precision_vs_power", "class_validation", "precision_leads", "final_matrix")
ORACLE["pipeline_summary"] = _counts({
    "phase1_extract": [("genetic_signatures", "build_signatures"), ("compound_metadata", "build_compound_metadata")],
    "phase2_store": [("stored_compounds", "build_compound_metadata"), ("stored_signatures", "build_signatures"),
                     ("integrity_report", "integrity_report")],
    "phase3_questions": [*((k, k) for k in _ASKED), ("lead_summary", "precision_leads"), ("lead_gene_hits", "lead_gene_detail")],
    "phase4_literature": [("executive_report", "executive_report"), ("novelty_report", f"select distinct pert_iname from ({ORACLE['executive_report']}) y")],
    "phase5_profiles": [("features", "response_features"), ("profile_report", "profile_report")],
})
