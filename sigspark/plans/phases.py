"""The phase jobs and the full run (inventory K2–K6).

Every phase writes its outputs under the run's folder and returns them as read
back. A finished phase publishes a manifest last: where its outputs lie, their
schemas and row counts. Folder and manifest are named by a key over the input
files, the code, the phase's settings and the keys of the phases before it, so a
rerun reads finished phases back without a job, goes on at the one that failed,
and repeats exactly what another input, setting or code could change.
"""

from __future__ import annotations

import hashlib
import inspect
import json
import sys
import time
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sigspark import config
from sigspark.functions import columns
from sigspark.functions.literals import literal_rows
from sigspark.operators import joins, quality, reshape, stats
from sigspark.operators.quality import integrity_report
from sigspark.plans import jobs
from sigspark.plans import literature as Lit
from sigspark.plans import profiles as H
from sigspark.plans import questions as E
from sigspark.plans import temporal as G
from sigspark.sources import keyed, store as stored_files
from sigspark.sources import sinks as S
from sigspark.sources.readers import require_inputs
from sigspark.sources.store import write_phase1

SUMMARY_SCHEMA = T.StructType([
    T.StructField("phase", T.StringType(), False),
    T.StructField("output", T.StringType(), False),
    T.StructField("rows", T.LongType(), True),
    T.StructField("status", T.StringType(), False),
])

RUN_SCHEMA = T.StructType([*SUMMARY_SCHEMA.fields, T.StructField("seconds", T.DoubleType(), False),
                           T.StructField("resumed", T.BooleanType(), False)])
_MANIFEST = "output string, rows long, kind string, path string, schema string"

Outputs = dict[str, DataFrame]

# Whose text is part of a phase's key, beside this module and the settings.
_CODE = {
    "phase1_extract": (jobs, joins, reshape, stored_files),
    "phase2_store": (S, keyed, quality, stats),
    "phase3_questions": (E, S, columns, stats),
    "phase4_literature": (Lit,),
    "phase5_profiles": (G, H, stats),
}
# Outputs that are not Parquet folders of their own name.
_KINDS = {"stored_compounds": ("stored", "compounds"), "stored_signatures": ("stored", "signatures"),
          "lead_summary": ("csv", "exports/lead_summary"), "lead_gene_hits": ("csv", "exports/lead_gene_hits")}


def _saved(outputs: Outputs, root: str) -> Outputs:
    """Write each output and read it back; an empty result is a result."""
    back = {}
    for name, df in outputs.items():
        df.write.mode("overwrite").parquet(f"{root}/{name}")
        back[name] = df.sparkSession.read.schema(df.schema).parquet(f"{root}/{name}")
    return back


def extract(spark: SparkSession, inputs: Outputs, root: str, paths: Sequence[str] = ()) -> Outputs:
    """K1 with A5: missing inputs fail the run before anything is planned."""
    require_inputs(spark, paths)
    return write_phase1(spark, inputs, root)


def store(spark: SparkSession, cm: DataFrame, gs: DataFrame, root: str) -> Outputs:
    """K2: append compounds and signatures to the stored tables, then report on the stored tables' integrity."""
    S.append_new_compounds(cm, f"{root}/compounds")
    S.append_new_signatures(gs, f"{root}/signatures")
    compounds, signatures = S.stored_table(spark, f"{root}/compounds"), S.stored_table(spark, f"{root}/signatures")
    return {"stored_compounds": compounds, "stored_signatures": signatures,
            **_saved({"integrity_report": integrity_report(compounds, signatures)}, root)}


def answer(spark: SparkSession, cm: DataFrame, gs: DataFrame, root: str, reference: str = config.REFERENCE_COMPOUND,
           markers: Sequence[str] = config.REVERSAL_GENES) -> Outputs:
    """K3: the ten business questions, saved, and the two report exports."""
    out = _saved({
        "reversal_signature": E.reversal_signature(cm, gs, genes=markers),
        "moa_mimics": E.moa_mimics(cm, gs, reference=reference),
        "toxicity_extreme_hits": E.toxicity_extreme_hits(cm, gs),
        "potency_benchmark": E.potency_benchmark(cm, gs),
        "master_regulators": E.master_regulators(gs),
        "repurposing_efficiency": E.repurposing_efficiency(cm, gs),
        "precision_vs_power": E.precision_vs_power(cm, gs),
        "class_validation": E.class_validation(cm, gs, genes=markers),
        "precision_leads": E.precision_leads(cm, gs),
        "final_matrix": E.final_matrix(cm, gs),
    }, root)
    leads = out["precision_leads"]
    paths = S.export_reports(leads, E.lead_gene_detail(cm, gs, leads), f"{root}/exports")
    return {**out, **{name: spark.read.option("header", True).csv(path) for name, path in paths.items()}}


def review(cm: DataFrame, leads: DataFrame, index: DataFrame, postings: DataFrame, root: str,
           reference: str = config.REFERENCE_COMPOUND) -> Outputs:
    """K4: literature counts of the leads and the reference compound, the
    executive report and the novelty report."""
    benchmark = cm.where(F.col("pert_iname") == reference).select("pert_iname", "moa")
    rows = Lit.leads_with_benchmark(leads, benchmark)
    papers = _saved({"literature": Lit.compound_literature(index, rows.select("pert_iname"), postings)}, root)["literature"]
    counts = papers.select("pert_iname", F.col("pubmed_papers").alias("publication_count"))
    return _saved({"executive_report": Lit.executive_report(rows, papers), "novelty_report": Lit.novelty_report(counts)}, root)


def profile(cm: DataFrame, gs: DataFrame, root: str, use_ml: bool = True) -> Outputs:
    """K5: response features, profiles, and the profile report."""
    features = _saved({"features": G.response_features(cm, gs)}, root)["features"]
    return {"features": features, **_saved({"profile_report": H.profile_report(H.classify_clinical_profiles(features, use_ml))}, root)}


def _inputs_key(spark: SparkSession, paths: Sequence[str]) -> str:
    """Name, size and time of every input file (file metadata only), summed up per input."""
    key = hashlib.sha1()
    for path in paths:
        meta = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).agg(
            F.count(F.lit(1)), F.sum("length"), F.sum(F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)"))).first()
        key.update(f"|{path}:{':'.join(map(str, meta))}".encode())
    return key.hexdigest()


def _phase_key(phase: str, *parts: object) -> str:
    text = [inspect.getsource(m) for m in (sys.modules[__name__], config, *_CODE[phase])]
    return hashlib.sha1("|".join([phase, *map(repr, parts), *text]).encode()).hexdigest()[:16]


def _publish(spark: SparkSession, path: str, folder: str, outputs: Outputs) -> dict[str, int]:
    rows, counts = [], {}
    for name, df in outputs.items():
        kind, where = _KINDS.get(name, ("parquet", name))
        counts[name] = df.count()
        rows.append((name, counts[name], kind, f"{folder}/{where}", df.schema.json()))
    literal_rows(spark, rows, _MANIFEST).coalesce(1).write.mode("overwrite").parquet(path)
    return counts


def _restore(spark: SparkSession, path: str) -> tuple[Outputs, dict[str, int]] | None:
    """Outputs and row counts of a finished phase; None if it did not finish or its files are gone."""
    try:
        rows = spark.read.parquet(path).collect()
        outputs: Outputs = {}
        for r in rows:
            if r["kind"] == "stored":
                outputs[r["output"]] = S.stored_table(spark, r["path"])
            else:
                reader = spark.read.schema(T.StructType.fromJson(json.loads(r["schema"])))
                outputs[r["output"]] = reader.option("header", True).csv(r["path"]) if r["kind"] == "csv" else reader.parquet(r["path"])
    except AnalysisException:
        return None
    if any(df is None for df in outputs.values()):
        return None
    return outputs, {r["output"]: r["rows"] for r in rows}


def full_run(spark: SparkSession, inputs: Outputs, paths: Sequence[str], index: DataFrame, postings: DataFrame, root: str,
             reference: str, markers: Sequence[str]) -> DataFrame:
    """K6: all phases in order; rows (phase, output, rows, status).

    A phase that fails is reported and the phases that need it are not run; a
    later run with the same ``root`` goes on there. ``root/run_summary`` holds the
    same rows with the seconds of each phase and whether it was read back. The
    row counts are all that reaches the driver."""
    rows: list[tuple] = []
    done: Outputs = {}
    keys: dict[str, str] = {}  # of finished outputs: the key of their phase
    try:
        source = _inputs_key(spark, paths)
    except Exception:
        source = ""  # phase 1 says what is missing

    def run(phase: str, needs: Sequence[str], settings: Sequence[object], job: Callable[[str], Outputs]) -> None:
        if any(n not in done for n in needs):
            rows.append((phase, "", None, "skipped", 0.0, False))
            return
        start = time.monotonic()
        key = _phase_key(phase, source, [keys[n] for n in needs], *settings)
        folder, manifest = f"{root}/{phase}-{key}", f"{root}/_done/{phase}-{key}"
        finished = _restore(spark, manifest) if source else None
        try:
            if finished is None:
                outputs = job(folder)
                counts = _publish(spark, manifest, folder, outputs)
            else:
                outputs, counts = finished
        except Exception as exc:
            rows.append((phase, "", None, f"failed: {type(exc).__name__}", round(time.monotonic() - start, 3), False))
            return
        done.update(outputs)
        keys.update(dict.fromkeys(outputs, key))
        seconds = round(time.monotonic() - start, 3)
        rows.extend((phase, name, counts[name], "ok", seconds, finished is not None) for name in outputs)

    tables = ("compound_metadata", "genetic_signatures")
    cm_gs = lambda: (done["compound_metadata"], done["genetic_signatures"])
    run("phase1_extract", (), (), lambda to: extract(spark, inputs, to, paths))
    run("phase2_store", tables, (), lambda to: store(spark, *cm_gs(), to))
    run("phase3_questions", tables, (reference, tuple(markers)), lambda to: answer(spark, *cm_gs(), to, reference, markers))
    run("phase4_literature", ("compound_metadata", "precision_leads"), (reference,),
        lambda to: review(done["compound_metadata"], done["precision_leads"], index, postings, to, reference))
    run("phase5_profiles", tables, (), lambda to: profile(*cm_gs(), to))
    literal_rows(spark, rows, RUN_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{root}/run_summary")
    return literal_rows(spark, [r[:4] for r in rows], SUMMARY_SCHEMA)
