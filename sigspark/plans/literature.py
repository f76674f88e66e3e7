"""Literature footprint, re-aimed from web search to landed tables.

The reference asks a web search engine how many papers mention each
compound. Here the corpus is a table of texts: a name's count is the number of
distinct documents that contain its tokens one after the other. Tokens are
runs of letters and digits of any script, lower-cased, with inner hyphens
("MG-132" is one token, "valproic acid" two). The corpus is tokenised once
into a positional index: per token and document the places of the token, in
order, and per token its number of documents. That number answers one-token
names; for longer names the documents of the rarest token are looked up in the
others' postings, and the name occurs where their places, each less the token's
place in the name, have one in common. No text is read again. Landed web pages are parsed with regular expressions instead of a DOM library.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sigspark.functions.columns import novelty_status, research_maturity, risk_level
from sigspark.operators.sides import joined

TOKEN = r"[\p{L}\p{N}]+(?:-[\p{L}\p{N}]+)*"


def tokens(text: Column | str) -> Column:
    """The tokens of a text in order (null: none)."""
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0)), F.array().cast("array<string>"))


def document_tokens(documents: DataFrame) -> DataFrame:
    """(doc_id, token) for every token of every whole document."""
    return documents.select("doc_id", F.explode(tokens("text")).alias("token"))


# The postings lie in so many folders by the hash of the token; a list of names reads those of its tokens.
POSTING_BUCKETS = 32
# Token lists up to this length are read first and pushed into the scan.
SHORT_LIST = 1000


def _bucket(token: Column) -> Column:
    return F.pmod(F.xxhash64(token), F.lit(POSTING_BUCKETS)).cast("int")


# Documents are indexed so many tokens at a time (a longer document alone).
SLICE_TOKENS = 1 << 18


def _grouper(most: int):
    """The task's function of ``postings``: batches of (doc_id, words) are cut
    between documents into slices of at most ``most`` words before they are sorted."""
    def slices(batch):
        import numpy as np

        size = np.asarray(batch.column(1).value_lengths())
        ends, start = np.cumsum(size), 0
        while start < len(size):
            stop = max(start + 1, int(np.searchsorted(ends, ends[start] - size[start] + most, side="right")))
            yield batch.slice(start, stop - start)
            start = stop

    def group(batches):
        import numpy as np
        import pyarrow as pa

        for batch in (part for whole in batches for part in slices(whole)):
            words = batch.column(1)
            flat, size = words.flatten().dictionary_encode(), np.asarray(words.value_lengths())
            row = np.repeat(np.arange(len(size)), size)
            pos = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
            key = row * max(1, len(flat.dictionary)) + flat.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            order = np.argsort(key, kind="stable")
            first = np.flatnonzero(np.diff(key[order], prepend=-1))
            at = pa.array(order[first])
            yield pa.RecordBatch.from_arrays(
                [flat.dictionary.take(flat.indices.take(at)), batch.column(0).take(pa.array(row[order[first]])),
                 pa.ListArray.from_arrays(pa.array(np.append(first, len(key)), pa.int32()), pa.array(pos[order], pa.int32()))],
                names=["token", "doc_id", "positions"])

    return group


def postings(documents: DataFrame) -> DataFrame:
    """Positional inverted index: one ``(token, doc_id, positions)`` per
    document and token; the positions ascend, from 0. ``doc_id`` is the
    corpus's key. A document's places of a token are put together in the task
    that reads it, by sorting the token numbers (Arrow) of so many documents at a
    time as have ``SLICE_TOKENS`` tokens, so a task's memory does not follow the
    batch's size; nothing is shuffled."""
    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", tokens("text").alias("words")).mapInArrow(
        _grouper(SLICE_TOKENS), f"token string, doc_id {kind}, positions array<int>")


_postings_of = postings  # where a parameter has the name


def write_postings(postings_df: DataFrame, path: str) -> None:
    """Land postings in folders by token hash, by token and document within
    their files; a folder's documents are dealt to several tasks, so that a
    token that every document has is not one task's."""
    deal = max(1, int(postings_df.sparkSession.conf.get("spark.sql.shuffle.partitions")) // POSTING_BUCKETS)
    (postings_df.withColumn("bucket", _bucket(F.col("token"))).repartition("bucket", F.pmod(F.xxhash64("doc_id"), F.lit(deal)))
     .sortWithinPartitions("bucket", "token", "doc_id").write.mode("overwrite").partitionBy("bucket").parquet(path))


def document_frequency(postings_df: DataFrame) -> DataFrame:
    """``(token, n_docs)``: distinct documents per token, from the postings.

    Built once per corpus and landed (``sources.store.corpus_index``); every
    literature count is then a join of its term list with this table.
    """
    return postings_df.groupBy("token").agg(F.count(F.lit(1)).alias("n_docs"))


def _narrow(tokens_df: DataFrame, *tables: DataFrame) -> list[DataFrame]:
    """The tables with a token column, cut down to the folders and values of
    ``tokens_df`` where these are few. A long list touches every folder."""
    rows = tokens_df.select("token").distinct().limit(SHORT_LIST + 1).withColumn("bucket", _bucket(F.col("token"))).collect()
    if len(rows) > SHORT_LIST:
        return [t.drop("bucket") for t in tables]
    folders, values = sorted({r["bucket"] for r in rows}), [r["token"] for r in rows]
    return [(t.where(F.col("bucket").isin(folders)) if "bucket" in t.columns else t).where(F.col("token").isin(values)).drop("bucket") for t in tables]


def _words(keyed: DataFrame) -> DataFrame:
    return keyed.select(F.explode(F.split("name_key", " ")).alias("token"))


def phrase_matches(postings_df: DataFrame, index: DataFrame, names: DataFrame) -> DataFrame:
    """``(name_key, doc_id)``: the documents that contain a name's tokens one
    after the other, for names of several tokens; ``name_key`` holds the tokens
    joined by a blank.

    A name is looked for in the documents of its rarest token only. Of a
    document, the postings of the names' tokens come together, and the places
    of each, less its place in the name, are intersected in that one row."""
    parts = names.select("name_key").where(F.col("name_key").contains(" ")).distinct().select(
        "name_key", F.size(F.split("name_key", " ")).alias("n"), F.posexplode(F.split("name_key", " ")).alias("place", "token"))
    found = joined(parts, index, "token").select("name_key", "n", F.struct("n_docs", "place", "token").alias("p"))
    whole = found.groupBy("name_key", "n").agg(F.array_sort(F.collect_list("p")).alias("parts")).where(F.size("parts") == F.col("n"))
    look = whole.select("name_key", "parts", F.posexplode("parts").alias("i", "p"))
    wanted = look.groupBy(F.col("p.token").alias("token")).agg(
        F.collect_list(F.when(F.col("i") == 0, F.struct("name_key", "parts"))).alias("names"))  # those whose rarest token it is
    held = joined(postings_df, wanted, "token")
    docs = held.groupBy("doc_id").agg(F.collect_list(F.struct("token", "positions")).alias("held"), F.flatten(F.collect_list("names")).alias("names"))
    docs = docs.where(F.size("names") > 0).select("doc_id", "names", F.map_from_entries("held").alias("held"))

    def starts(part: Column) -> Column:
        at = F.coalesce(F.element_at("held", part["token"]), F.array().cast("array<int>"))
        return F.transform(at, lambda p: p - part["place"])

    def occurs(name: Column) -> Column:
        parts = name["parts"]
        return F.size(F.aggregate(F.slice(parts, 2, F.size(parts)), starts(parts[0]), lambda a, part: F.array_intersect(a, starts(part)))) > 0

    return docs.select("doc_id", F.explode(F.transform(F.filter("names", occurs), lambda n: n["name_key"])).alias("name_key"))


def name_key(term: Column | str) -> Column:
    """A name's tokens joined by a blank: names that are spelt alike but for case and punctuation share one."""
    return F.array_join(tokens(term), " ")


# F5
def literature_counts(index: DataFrame, terms: DataFrame, term_col: str = "term", count_col: str = "n_docs",
                      documents: DataFrame | None = None, postings: DataFrame | None = None) -> DataFrame:
    """Distinct documents mentioning each term (0 when none); every term row is
    kept. One-token terms are looked up in the document-frequency ``index``;
    terms of several tokens in the ``postings`` (made from the ``documents``
    where only these are given), without which they are an error. A term
    without any token is in no document."""
    keyed = terms.select(term_col).withColumn("name_key", name_key(term_col))
    hits = index.select(F.col("token").alias("name_key"), F.col("n_docs").alias("__n"))
    if postings is None and documents is not None:
        postings = _postings_of(documents)
    several = F.col("name_key").contains(" ")
    if postings is not None:
        index, postings = _narrow(_words(keyed), index, postings)
        hits = index.select(F.col("token").alias("name_key"), F.col("n_docs").alias("__n"))
        phrases = phrase_matches(postings, index, keyed)
        hits = hits.unionByName(phrases.groupBy("name_key").agg(F.count(F.lit(1)).alias("__n")))
    else:
        keyed = keyed.withColumn("name_key", F.when(~several, F.col("name_key")).otherwise(
            F.raise_error(F.concat(F.lit("a term of several tokens needs the documents: "), F.col("name_key")))))
    return (joined(keyed, hits, "name_key", "left")
            .select(term_col, F.coalesce(F.col("__n"), F.lit(0)).cast("long").alias(count_col)))


def compound_literature(index: DataFrame, compounds: DataFrame, postings: DataFrame) -> DataFrame:
    """F5 for compound names: ``pert_iname, pubmed_papers, research_maturity``."""
    names = compounds.select("pert_iname").distinct()
    return (literature_counts(index, names, "pert_iname", "pubmed_papers", postings=postings)
            .withColumn("research_maturity", research_maturity("pubmed_papers")))


def literature_search(postings_df: DataFrame, index: DataFrame, terms: DataFrame, term_col: str = "compound",
                      max_results: int = 10) -> DataFrame:
    """The search result per distinct term: total count, the first
    ``max_results`` document ids (ascending, comma-joined as in the report CSV)
    and the novelty status. Terms are matched like those of
    ``literature_counts``: by their tokens, so ``MG-132`` finds ``mg-132``.

    The id list is a top-k per term (``row_number() <= k``, limited per map
    task before the shuffle), so a term found in every document still sends
    only k ids per task; the count is the real total.
    """
    keyed = terms.select(term_col).distinct().withColumn("name_key", name_key(term_col))
    index, postings_df = _narrow(_words(keyed), index, postings_df)
    phrases = phrase_matches(postings_df, index, keyed)
    words = keyed.where(~F.col("name_key").contains(" ")).select(F.col("name_key").alias("token")).distinct()
    matches = joined(postings_df, words, "token").select("doc_id", F.col("token").alias("name_key")).unionByName(phrases)
    w = Window.partitionBy("name_key").orderBy("doc_id")
    first = (matches.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= max_results)
             .groupBy("name_key").agg(F.array_join(F.transform(F.array_sort(F.collect_list("doc_id")), lambda x: x.cast("string")), ",").alias("pmids")))
    hits = index.select(F.col("token").alias("name_key"), "n_docs").unionByName(
        phrases.groupBy("name_key").agg(F.count(F.lit(1)).alias("n_docs")))
    return (joined(joined(keyed, hits, "name_key", "left"), first, "name_key", "left")
            .withColumn("publication_count", F.coalesce("n_docs", F.lit(0)).cast("long"))
            .select(term_col, "publication_count", F.coalesce(F.col("pmids"), F.lit("")).alias("pmids"),
                    novelty_status("publication_count").alias("status")))


# the elements that hold the fields. The heading of an article page has a
# class of its own; other pages have a plain one.
TITLE_RE = r'(?is)<h1\b[^>]*class="[^"]*\bheading-title\b[^"]*"[^>]*>(.*?)</h1>'
HEADING_RE = r"(?is)<h1\b[^>]*>(.*?)</h1>"
CITATION_RE = r'(?is)<span\b[^>]*class="[^"]*\bcit\b[^"]*"[^>]*>(.*?)</span>'
COUNT_RE = r'(?is)<span\b[^>]*class="value"[^>]*>(.*?)</span>'
YEAR_RE = r"\b(?:1[89]|20)[0-9]{2}\b"
ARTICLE_MARK = 'class="article-page"'


def element_text(markup: Column) -> Column:
    """Text of an element: inner tags removed, the usual references decoded, white space as one blank."""
    text = F.regexp_replace(markup, r"<[^>]*>", "")
    for name, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        text = F.replace(text, F.lit(name), F.lit(char))
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def page_fields(pages: DataFrame) -> DataFrame:
    """Heading, year of the citation ('N/A' when absent), result count (commas removed)."""
    title = F.coalesce(*[F.nullif(element_text(F.regexp_extract("html", p, 1)), F.lit("")) for p in (TITLE_RE, HEADING_RE)], F.lit("N/A"))
    year = F.regexp_extract(element_text(F.regexp_extract("html", CITATION_RE, 1)), YEAR_RE, 0)
    count = F.replace(element_text(F.regexp_extract("html", COUNT_RE, 1)), F.lit(","), F.lit(""))
    return pages.select(
        "page_id", title.alias("title"),
        F.coalesce(F.nullif(year, F.lit("")), F.lit("N/A")).alias("year"),
        F.when(count.rlike("^[0-9]+$"), count).try_cast("long").alias("paper_count"),
        F.col("html").contains(ARTICLE_MARK).alias("single_article"))


# F1 applied to parsed pages: a page with a count, a single-article page, or neither.
def page_maturity(fields: DataFrame) -> DataFrame:
    papers = (F.when(F.col("paper_count").isNotNull(), F.col("paper_count"))
              .when(F.col("single_article"), F.lit(1)).otherwise(F.lit(0)).cast("long"))
    return fields.select("page_id", papers.alias("pubmed_papers"), research_maturity(papers).alias("research_maturity"))


# F2 / F3
def novelty_report(counts: DataFrame, count_col: str = "publication_count") -> DataFrame:
    return counts.withColumn("novelty_status", novelty_status(count_col)).withColumn("risk_level", risk_level(count_col))


def novelty_summary(report: DataFrame, count_col: str = "publication_count") -> DataFrame:
    c = F.col(count_col)
    return report.agg(
        F.count(F.lit(1)).alias("total_compounds"),
        F.sum((F.col("novelty_status") == "novel").cast("long")).alias("novel_compounds"),
        F.sum((F.col("novelty_status") == "established").cast("long")).alias("established_compounds"),
        F.sum((F.col("novelty_status") == "error").cast("long")).alias("error_compounds"),
        F.round(F.avg(F.when(c >= 0, c)), 6).alias("avg_publications"))


# F4
def leads_with_benchmark(leads: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Benchmark compound row(s) first, then the leads; missing columns are null."""
    return benchmark.unionByName(leads, allowMissingColumns=True)


# F8
def executive_report(leads: DataFrame, literature: DataFrame) -> DataFrame:
    return joined(leads, literature.select("pert_iname", "pubmed_papers", "research_maturity"), "pert_iname", "left")


# F7
def leads_by_papers(report: DataFrame) -> DataFrame:
    return report.orderBy(F.col("pubmed_papers").desc_nulls_last(), "pert_iname")
