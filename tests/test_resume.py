"""The full run goes on where it failed and repeats only what a change can reach."""

import glob
import os

import pytest

from sigspark.plans import phases
from sigspark.plans import registry as R
from sigspark.sources.store import INPUT_TABLES, corpus_tables

PHASES = ["phase1_extract", "phase2_store", "phase3_questions", "phase4_literature", "phase5_profiles"]


@pytest.fixture()
def job(spark, sf_dir, scratch):
    t, c = R._tables(spark, sf_dir), corpus_tables(spark, sf_dir)
    paths = [f"{sf_dir}/{name}.parquet" for name in ("lineitem", "part", "supplier", "documents")]

    def run(reference=R.REFERENCE_COMPOUND):
        out = phases.full_run(spark, {k: t[k] for k in INPUT_TABLES}, paths, c["document_frequency"], c["postings"], scratch,
                              reference, R.MARKER_GENES).collect()
        summary = spark.read.parquet(f"{scratch}/run_summary").collect()
        assert [tuple(r)[:4] for r in summary] == [tuple(r) for r in out] and all(r.seconds >= 0 for r in summary)
        return out, {r.phase for r in summary if r.resumed}
    return run


def files(scratch, phase):
    return {p: os.stat(p).st_mtime_ns for p in glob.glob(f"{scratch}/{phase}-*/**/*.parquet", recursive=True)}


def test_a_failed_phase_is_resumed_and_changes_repeat_what_they_reach(job, scratch, monkeypatch):
    def lost(*_, **__):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(phases, "review", lost)
        out, resumed = job()
    status = {r.phase: r.status for r in out}
    assert [status[p] for p in PHASES] == ["ok", "ok", "ok", "failed: RuntimeError", "ok"] and not resumed
    before = {p: files(scratch, p) for p in PHASES}

    out, resumed = job()
    assert {r.status for r in out} == {"ok"} and resumed == set(PHASES) - {"phase4_literature"}
    for p in PHASES:
        assert (files(scratch, p) == before[p]) == (p != "phase4_literature"), p

    again, resumed = job()
    assert again == out and resumed == set(PHASES)

    _, resumed = job(reference="another compound")  # phases 3 and 4 depend on it
    assert resumed == {"phase1_extract", "phase2_store", "phase5_profiles"}


def test_another_input_is_another_key(spark, scratch):
    def write(n):
        spark.range(n).write.mode("overwrite").parquet(f"{scratch}/in")
        return phases._inputs_key(spark, [f"{scratch}/in"])

    one = write(5)
    assert one == phases._inputs_key(spark, [f"{scratch}/in"]) and one != write(6)
