"""The registered queries of the operators, with the SQL that checks them."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sigspark.llm import (decontaminate, hard_negatives, html_extract, language_id, license_scan, mixing, packing, periodic_runs, simhash, substring_dedup, token_counts,
                          topk, warc)
from sigspark.llm.common import land, ship, table
from sigspark.session import scratch_root

TOKEN_BUDGET = 4096


def piece_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and the licences that they name or carry."""
    ship(spark)
    return license_scan.scan(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and the benchmark items that leak into them."""
    ship(spark)
    found = decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), "item_id", "item_words", "covered",
                        (F.col("covered") / F.col("item_words")).alias("coverage"), F.size("tiles").alias("n_tiles"))


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_extract.extract(pages).select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                        F.col("component").alias("component_id"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives are written under the shared folder and read back."""
    ship(spark)
    path = f"{scratch_root(spark)}/llm/warc-{uuid.uuid4().hex}"
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    return warc.page_report(warc.assemble(land(warc.without_payloads(warc.read_records(spark, path)), "records")))


def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    found = token_counts.count_tokens(table(spark, sf_dir, "documents"), piece_model(), TOKEN_BUDGET)
    return found.withColumnRenamed("id", "doc_id")


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup.dedup_substrings(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs = table(spark, sf_dir, "documents")
    model = language_id.fit_on_training_rows(docs)
    return language_id.predict(docs.select("doc_id", "text"), model).select(
        "doc_id", language_id.held_out().alias("held_out"), "lang_pred", "score", "rejected")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row in seven has a wrong label."""
    ship(spark)
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", label), F.col("vec_id") % 50 == 0)


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    import public_tokenizers

    tokens = packing.tokenize(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return packing.pack(tokens).select(F.col("id").alias("doc_id"), "start", "length", "ids_crc32", F.col("n_tokens").alias("doc_tokens"), "sequence_id", "offset")


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every run of every document, one text in ten with a planted repeat."""
    ship(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = periodic_runs.periodic_runs(periodic_runs.plant_repeats(docs))
    longest = F.array_sort("runs", lambda a, b: F.when(a["length"] != b["length"], F.when(a["length"] > b["length"], -1).otherwise(1))
                           .when(a["start"] != b["start"], F.when(a["start"] < b["start"], -1).otherwise(1))
                           .otherwise(F.when(a["period"] < b["period"], -1).when(a["period"] > b["period"], 1).otherwise(0)))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    best = F.get(longest, F.lit(0))
    return found.select(
        F.col("id").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"),
        best["period"].alias("period"), "collapsed", lines.alias("_lines")).select(
        "doc_id", "n_runs", "start", "length", "period", F.expr("1000 * length div period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("_lines", lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (
    op1_license_scan, op2_decontamination, op3_html_extraction, op4_simhash, op5_warc, op6_topk, op7_token_counts, op8_substring_dedup, op9_mixing, op10_language_id,
    op11_hard_negatives, op12_packing, op13_periodic_runs, pipeline)}

ORACLE = {}

_TEMPLATES = ", ".join(f"({i}, '{name}', '{text.replace(chr(39), chr(39) * 2)}')" for i, (name, text) in enumerate(license_scan.TEMPLATES))
_SPELLED = """list_transform(regexp_extract_all(lower({}), '[\\p{{L}}\\p{{N}}]+'),
             lambda x: CASE x WHEN 'licence' THEN 'license' WHEN 'licenced' THEN 'licensed' ELSE x END)"""

ORACLE["op1_license_scan"] = rf"""
WITH u AS (
  SELECT doc_id, 1 AS kind, unnest(string_split(text, chr(10))) AS u FROM documents
  UNION ALL
  SELECT doc_id, 2, u FROM (SELECT doc_id, unnest(ps) AS u, len(ps) AS n
    FROM (SELECT doc_id, regexp_split_to_array(text, '\n[^\S\n]*\n') AS ps FROM documents)) WHERE n > 1 AND contains(trim(u, chr(10)), chr(10))
  UNION ALL
  SELECT doc_id, 3, regexp_replace(text, '(?im)^\s*(?:copyright|©|\(c\))[^\n]*\n', '', 'g') FROM documents WHERE contains(text, chr(10))
), uw AS (
  SELECT row_number() OVER () AS id, doc_id, kind, {_SPELLED.format("u")} AS w FROM u
), ug AS (
  SELECT id, doc_id, kind, len(w) - 1 AS n, gram, count(*) AS c
  FROM (SELECT *, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS gram FROM uw WHERE len(w) > 1) GROUP BY ALL
), tw AS (
  SELECT tid, name, {_SPELLED.format("t")} AS w FROM (VALUES {_TEMPLATES}) AS t(tid, name, t)
), tg AS (
  SELECT tid, name, len(w) - 1 AS n, gram, count(*) AS c
  FROM (SELECT *, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS gram FROM tw) GROUP BY ALL
), hit AS (
  SELECT id, doc_id, kind, tid, name, 2 * sum(least(ug.c, tg.c))::BIGINT / (ug.n + tg.n)::DOUBLE AS dice
  FROM ug JOIN tg USING (gram) GROUP BY id, doc_id, kind, tid, name, ug.n, tg.n
)
SELECT doc_id, name AS license, max(dice) AS dice,
       CASE arg_max(kind, dice * 1000000 - kind) WHEN 1 THEN 'line' WHEN 2 THEN 'paragraph' ELSE 'text' END AS unit, count(*)::INTEGER AS units
FROM hit WHERE dice >= 0.8 GROUP BY doc_id, name
"""

ORACLE["op5_warc"] = r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS hex FROM pages
), f AS (
  SELECT hex, min(page_id) AS first FROM p GROUP BY hex
)
SELECT page_id, strlen(body)::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                ((('0x' || substr(hex, (i // 8) * 10 + 1, 10))::BIGINT >> (35 - 5 * (i % 8))::INTEGER) & 31)::INTEGER + 1, 1)), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM p JOIN f USING (hex)
"""

ORACLE["op6_topk"] = r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.x, c.x)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 10
"""

ORACLE["op11_hard_negatives"] = r"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_dot_product(a.x, c.x)::BIGINT AS score
  FROM v a JOIN v c ON a.vec_id % 50 = 0 AND a.vec_id <> c.vec_id
), p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score
  FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place FROM s WHERE same) WHERE place <= 5
), n AS (
  SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score
)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""

ORACLE["op8_substring_dedup"] = r"""
WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents
), win AS (
  SELECT doc_id, i, array_to_string(ws[i : i + 49], ' ') AS s
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM w)
), least AS (
  SELECT s, min(doc_id) AS first FROM win GROUP BY s HAVING min(doc_id) < max(doc_id)
), gone AS (
  SELECT doc_id, list(DISTINCT p) AS ps
  FROM (SELECT win.doc_id, unnest(range(i, i + 50)) AS p FROM win JOIN least USING (s) WHERE win.doc_id > least.first)
  GROUP BY doc_id
)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(len(ps), 0)::BIGINT AS n_removed,
       sha256(CASE WHEN ps IS NULL THEN array_to_string(ws, ' ')
              ELSE array_to_string(list_transform(list_filter(range(1, len(ws) + 1), lambda i: NOT list_contains(ps, i)), lambda i: ws[i]), ' ') END) AS kept_sha256
FROM w LEFT JOIN gone USING (doc_id)
"""

ORACLE["op9_mixing"] = r"""
WITH d AS (
  SELECT doc_id, source, len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> ''))::BIGINT AS size,
         md5(concat_ws('|', '9', coalesce(doc_id::VARCHAR, '-'), coalesce(text, ''))) AS h
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w
  FROM d GROUP BY source
), o AS (
  SELECT *, 2 * size AS cap,
         coalesce(sum(2 * size) OVER (ORDER BY 2.0 * size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS below,
         sum(w) OVER (ORDER BY 2.0 * size / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::BIGINT AS open,
         (sum(size) OVER ())::BIGINT AS total
  FROM s
), l AS (
  SELECT arg_min((1.5::DOUBLE * total - below) / open, 0 - open) FILTER (WHERE (1.5::DOUBLE * total - below) / open * w <= cap) AS level FROM o
), t AS (
  SELECT source, size, least(cap::DOUBLE, level * w) AS target FROM o, l
), p AS (
  SELECT *, CASE WHEN size > 0 THEN floor(target / size) ELSE 0 END::BIGINT AS whole FROM t
), q AS (
  SELECT *, floor(target - (whole * size)::DOUBLE)::BIGINT AS extra FROM p
), g AS (
  SELECT source, h, sum(size)::BIGINT AS words, count(*) AS ties FROM d GROUP BY source, h
), c AS (
  SELECT *, coalesce(sum(words) OVER (PARTITION BY source ORDER BY h ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before FROM g
)
SELECT d.doc_id, d.size, q.size AS source_size, q.target,
       (q.whole * d.size + CASE WHEN c.before + c.words <= q.extra THEN d.size
                                WHEN c.before < q.extra THEN (q.extra - c.before) // c.ties ELSE 0 END)::BIGINT AS taken
FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source JOIN c ON d.source IS NOT DISTINCT FROM c.source AND d.h = c.h
"""
