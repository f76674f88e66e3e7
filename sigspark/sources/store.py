"""Landed tables: the bound inputs and the phase-1 outputs written as Parquet.

The reference hands phase-1 results to the query phase through files. Here
the same hand-off is a set of Parquet tables under the shared scratch folder
(``spark.checkpoint.dir``): writing them cuts the lineage, so a lost executor
re-reads files instead of recomputing the matrix, and later questions get
column pruning and row-group skipping on ``pert_iname``.

A table set is identified by the data folder and its input files. Each
build writes into its own attempt folder and publishes a manifest of the
table paths last: a half-written set is never read, and two concurrent
builders never overwrite each other.
"""

from __future__ import annotations

import hashlib
import inspect
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sigspark.functions.literals import literal_rows
from sigspark.operators import joins, reshape
from sigspark.plans import jobs, literature
from sigspark.plans.jobs import build_signatures
from sigspark.plans.literature import document_frequency, postings, write_postings
from sigspark.session import scratch_root
from sigspark.sources import binding
from sigspark.sources.binding import bind_inputs, corpus

# Landed tables are found again only by code that would build the same ones.
BUILD_TEXT = "".join(inspect.getsource(m) for m in (binding, joins, reshape, jobs, literature))
INPUT_TABLES = ("gene_info", "sig_info", "pert_info", "repurposing", "matrix_long")
# Inputs that need a join or an aggregation over a growing table are landed
# (written concurrently); the two plain projections of ``supplier`` are
# re-derived on use.
LANDED_INPUTS = ("gene_info", "sig_info", "matrix_long")
OUTPUT_TABLES = ("genetic_signatures", "compound_metadata")
ALL_TABLES = LANDED_INPUTS + OUTPUT_TABLES

# Sort keys inside each written file: min/max statistics then skip row groups
# for per-compound lookups. No range partitioning, so a hot compound cannot
# concentrate a write task.
_CLUSTER = {
    "matrix_long": ("sig_id", "gene_id"),
    "gene_info": ("pr_gene_id",),
    "sig_info": ("sig_id",),
    "genetic_signatures": ("pert_iname", "pr_gene_symbol"),
    "compound_metadata": ("pert_iname",),
}

_MANIFEST_SCHEMA = T.StructType([T.StructField("table", T.StringType()), T.StructField("path", T.StringType()),
                                 T.StructField("attempt", T.StringType())])

_cache: dict[tuple, dict[str, DataFrame]] = {}
_builds: dict[tuple[str, str], str] = {}


def _fingerprint(spark: SparkSession, sf_dir: str, names) -> str:
    """Identity of the input files: path, count, total bytes and newest
    modification time, read as file metadata through the ``binaryFile``
    source (content is pruned), so it works on any Hadoop filesystem."""
    h = hashlib.sha1(f"{BUILD_TEXT}|{sf_dir}".encode())
    for name in names:
        meta = (spark.read.format("binaryFile").load(f"{sf_dir}/{name}.parquet")
                .agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("bytes"),
                     F.max("modificationTime").cast("string").alias("mtime")).first())
        h.update(f"|{name}:{meta['n']}:{meta['bytes']}:{meta['mtime']}".encode())
    return h.hexdigest()[:16]


def _write(df: DataFrame, path: str, table: str) -> None:
    cluster = _CLUSTER.get(table)
    out = df.sortWithinPartitions(*cluster) if cluster else df
    out.write.mode("overwrite").parquet(path)


def _read_manifest(spark: SparkSession, root: str, tables=ALL_TABLES) -> dict[str, str] | None:
    """Table paths of the first complete build under ``root``, or None.

    Every build writes into its own attempt folder and publishes a manifest
    of its own (``_manifest-<attempt>``) only after all its tables are
    written, so concurrent builders never overwrite each other and a reader
    never sees a half-written set.
    """
    try:
        rows = spark.read.schema(_MANIFEST_SCHEMA).parquet(f"{root}/_manifest-*").collect()
    except AnalysisException:
        return None
    builds: dict[str, dict[str, str]] = {}
    for r in rows:
        builds.setdefault(r["attempt"], {})[r["table"]] = r["path"]
    complete = sorted(a for a, paths in builds.items() if set(paths) >= set(tables))
    return builds[complete[0]] if complete else None


def _publish(spark: SparkSession, root: str, attempt: str, paths: dict[str, str]) -> None:
    literal_rows(spark, [(t, p, attempt) for t, p in paths.items()], _MANIFEST_SCHEMA) \
        .write.mode("overwrite").parquet(f"{root}/_manifest-{attempt}")


def _inputs(spark: SparkSession, sf_dir: str, paths: dict[str, str]) -> dict[str, DataFrame]:
    bound = bind_inputs(spark, sf_dir)
    return {name: spark.read.parquet(paths[name]) if name in LANDED_INPUTS else bound[name]
            for name in INPUT_TABLES}


def _write_all(jobs: list[tuple[DataFrame, str, str]]) -> None:
    """Independent writes are submitted together (one driver thread each), so
    a narrow scan of one does not leave the cluster idle."""
    if len(jobs) == 1:
        _write(*jobs[0])
        return
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        for f in [pool.submit(_write, *job) for job in jobs]:
            f.result()


def write_phase1(spark: SparkSession, inputs: dict[str, DataFrame], root: str) -> dict[str, DataFrame]:
    """K1 on real inputs: compute the significant signatures and compound
    metadata from the five input DataFrames and write them under ``root``.

    This is the production path: the matrix is read where it lies (two
    passes — the |Z|-filtered rows, and the compound-presence projection,
    which reads only the id columns) and only the outputs are written.
    """
    phase1 = build_signatures(inputs)
    _write_all([(phase1.genetic_signatures, f"{root}/genetic_signatures", "genetic_signatures"),
                (phase1.compound_metadata, f"{root}/compound_metadata", "compound_metadata")])
    return {name: spark.read.parquet(f"{root}/{name}") for name in OUTPUT_TABLES}


def land_tables(spark: SparkSession, sf_dir: str, root: str) -> dict[str, str]:
    """Test binding: the inputs are themselves joins over the driver tables,
    so the ones that need a join or an aggregation are written first; then
    phase 1 runs on them. Everything goes into a fresh attempt folder, which
    is published by its manifest last; returns the table paths."""
    attempt = uuid.uuid4().hex[:12]
    base = f"{root}/{attempt}"
    inputs = bind_inputs(spark, sf_dir)
    _write_all([(inputs[name], f"{base}/{name}", name) for name in LANDED_INPUTS])
    paths = {name: f"{base}/{name}" for name in ALL_TABLES}
    write_phase1(spark, _inputs(spark, sf_dir, paths), base)
    _publish(spark, root, attempt, paths)
    return paths


def signature_tables(spark: SparkSession, sf_dir: str, rebuild: bool = False,
                     root: str | None = None) -> dict[str, DataFrame]:
    """DataFrames over the landed tables of ``sf_dir``; builds them once if missing.

    ``rebuild`` builds anew, and later calls use that build; a ``root`` of the
    caller's own is read or built there and remembered by nobody."""
    sf_dir = sf_dir.rstrip("/")
    key = (spark.sparkContext.applicationId, sf_dir)
    if not rebuild and root is None and key in _cache:
        return _cache[key]
    own = root is not None
    if root is None:
        base = f"{scratch_root(spark)}/sigspark-tables"
        root = (f"{base}/{_fingerprint(spark, sf_dir, ('supplier', 'part', 'lineitem'))}" if not rebuild
                else f"{base}/fresh-{uuid.uuid4().hex[:12]}")
    paths = None if rebuild else _read_manifest(spark, root)
    if paths is None:
        paths = land_tables(spark, sf_dir, root)
    tables = {**_inputs(spark, sf_dir, paths),
              **{name: spark.read.parquet(paths[name]) for name in OUTPUT_TABLES}}
    if not own:
        _cache[key] = tables
        _builds[key] = paths["genetic_signatures"]
    return tables


def build_of(spark: SparkSession, sf_dir: str) -> str:
    """Which build ``signature_tables`` answers from (changes with a rebuild)."""
    signature_tables(spark, sf_dir)
    return _builds[spark.sparkContext.applicationId, sf_dir.rstrip("/")]


def _corpus_root(spark: SparkSession, sf_dir: str, rebuild: bool) -> str:
    root = f"{scratch_root(spark)}/sigspark-corpus/{_fingerprint(spark, sf_dir, ('documents', 'lineitem', 'supplier'))}"
    return f"{root}-fresh-{uuid.uuid4().hex[:12]}" if rebuild else root


CORPUS_TABLES = ("postings", "document_frequency")


def corpus_tables(spark: SparkSession, sf_dir: str, rebuild: bool = False) -> dict[str, DataFrame]:
    """The landed positional index of the literature corpus: ``postings(token,
    doc_id, positions)`` in folders by token hash, and
    ``document_frequency(token, n_docs)``; built once per corpus."""
    sf_dir = sf_dir.rstrip("/")
    key = (spark.sparkContext.applicationId, sf_dir, "corpus")
    if not rebuild and key in _cache:
        return _cache[key]
    root = _corpus_root(spark, sf_dir, rebuild)
    paths = None if rebuild else _read_manifest(spark, root, CORPUS_TABLES)
    if paths is None:
        attempt = uuid.uuid4().hex[:12]
        paths = {t: f"{root}/{attempt}/{t}" for t in CORPUS_TABLES}
        write_postings(postings(corpus(spark, sf_dir)), paths["postings"])
        document_frequency(spark.read.parquet(paths["postings"])).sortWithinPartitions("token") \
            .write.mode("overwrite").parquet(paths["document_frequency"])
        _publish(spark, root, attempt, paths)
    tables = {t: spark.read.parquet(paths[t]) for t in CORPUS_TABLES}
    _cache[key] = tables
    return tables


def corpus_index(spark: SparkSession, sf_dir: str, rebuild: bool = False) -> DataFrame:
    """The landed document-frequency table ``(token, n_docs)`` of the literature corpus."""
    return corpus_tables(spark, sf_dir, rebuild)["document_frequency"]


def raw_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
