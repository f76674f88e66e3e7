"""Exact substring de-duplication by super-k-mer partitioning.

A window is ``window`` consecutive words. Its minimiser is the least hash among
its word m-grams; consecutive windows with one minimiser travel as one packed
string (a super-k-mer) to the minimiser's bucket. Equal windows have equal
minimisers, so they meet in one bucket, where a sort of the windows finds the
least document id of each. Windows are compared by their bytes; hashes only
order them.

Three passes over the texts:

1. every super-k-mer's minimiser and document id, aggregated map-side: which
   minimisers occur in more than one document;
2. the super-k-mers of those minimisers only (a bitmap of bounded size lets
   through all of them and a few others), sent to their buckets and sorted;
3. the removal spans, joined back to their documents. A second bitmap keeps
   the texts of documents without spans out of that join's shuffle.

A bucket group of more than ``group_limit`` super-k-mers would be too much for
one task. Of its windows first only the hashes are aggregated; windows whose
hash several documents have are then aggregated by their bytes, copies
collapsing map-side, and the least ids are joined back with the skew join.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sigspark.llm.common import (SPACES, bitmap_test, flat, free_prefix, gram_hashes, hash_bitmap, land, mix, steps, text_bytes, word_bounds, word_hashes)


@dataclass(frozen=True)
class Params:
    """``gram``: words of the m-grams that minimisers are taken from.
    ``filter_bits``: the bitmap of minimisers has 2**filter_bits bits; when more
    of them repeat than it can tell apart, more strings travel and results
    stay. ``doc_bits``: likewise for the documents that lose words.
    ``group_limit``: super-k-mers that one task holds of one minimiser, whatever
    the input's size. ``hot_bits``: the bitmap of minimisers beyond it; those
    that it cannot tell apart from them are treated as hot too, and results stay."""

    window: int = 50
    gram: int = 8
    filter_bits: int = 26
    doc_bits: int = 24
    group_limit: int = 32768
    hot_bits: int = 22


def _sliding_min(g: np.ndarray, width: int) -> np.ndarray:
    n = len(g) - width + 1
    span, m = 1, g
    while span * 2 <= width:
        m = np.minimum(m[:-span], m[span:])
        span *= 2
    return np.minimum(m[:n], m[width - span:width - span + n])


def super_kmers(raw: np.ndarray, at: np.ndarray, params: Params):
    """For texts end to end: (row, first word in row, number of windows,
    minimiser, first byte, end byte) arrays of all super-k-mers. A run longer
    than the number of m-grams in a window is cut, so a packed string is
    bounded whatever the text."""
    k, m = params.window, params.gram
    start, end, first = word_bounds(raw, at)
    if len(start) < k:
        return (np.zeros(0, np.int64),) * 6
    words = word_hashes(raw, start, end)
    low = _sliding_min(gram_hashes(words, m), k - m + 1)
    row = np.searchsorted(first, np.arange(len(low)), side="right") - 1
    windows = np.flatnonzero(np.arange(len(low)) + k <= first[row + 1])
    if not len(windows):
        return (np.zeros(0, np.int64),) * 6
    v = low[windows]
    new = np.ones(len(windows), bool)
    new[1:] = (windows[1:] != windows[:-1] + 1) | (v[1:] != v[:-1])
    begin = np.flatnonzero(new)
    count = np.diff(np.append(begin, len(windows)))
    cut = k - m + 1
    pieces = -(-count // cut)
    inner = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    size = np.minimum(cut, np.repeat(count, pieces) - inner * cut)
    at_window = np.repeat(begin, pieces) + inner * cut
    w = windows[at_window]
    r = row[w]
    return r, w - first[r], size, v[at_window].view(np.int64), start[w], end[w + size + k - 2]


def _kmer_rows(params: Params, keep, hot, want_hot: bool):
    """Arrow batches of packed super-k-mers (pass 2): those whose minimiser is
    in the bitmap, either without the hot minimisers (None: there are none) or
    only these."""
    def run(batches):
        bitmap = keep.value
        for batch in batches:
            raw, at = flat(batch.column(2))
            for lo, hi in steps(at):
                part = raw[at[lo]:at[hi]]
                r, w, n, v, a, b = super_kmers(part, at[lo:hi + 1] - at[lo], params)
                ok = bitmap.test(v.view(np.uint64)) if len(v) else np.zeros(0, bool)
                if len(v) and hot is not None:
                    ok &= hot.value.test(v.view(np.uint64)) == want_hot
                ok = np.flatnonzero(ok)
                text = part.tobytes()
                for i in range(0, len(ok), 8192):
                    j = ok[i:i + 8192]
                    packed = [b" ".join(text[x:y].split()) for x, y in zip(a[j].tolist(), b[j].tolist())]
                    rows = pa.array(lo + r[j])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(v[j]), batch.column(0).take(rows), batch.column(1).take(rows), pa.array(w[j]), pa.array(n[j]),
                         pa.array(packed, pa.binary())], names=["v", "id", "key", "w", "n", "packed"])
    return run


def _windows(packed: pa.Array, k: int):
    """All windows of packed strings: bytes, word bounds, first word of each
    string, string and hash of the window at each word, and the words where
    windows begin."""
    raw, at = flat(packed)
    start, end, first = word_bounds(raw, at)
    part = word_hashes(raw, start, end)
    n = len(part) - k + 1
    if n <= 0:
        none = np.zeros(0, np.int64)
        return raw, start, end, first, none, none, np.zeros(0, np.uint64)
    h = np.zeros(n, np.uint64)
    span, done, left = 1, 0, k
    while left:  # hash of k words by doubling
        if left & 1:
            h = mix(h + part[done:done + n] * np.uint64(2 * span + 1))
            done += span
        left >>= 1
        if left:
            part = mix(part[:-span] * np.uint64(0x9E3779B97F4A7C15) + part[span:])
            span *= 2
    row = np.searchsorted(first, np.arange(n), side="right") - 1
    return raw, start, end, first, row, np.flatnonzero(np.arange(n) + k <= first[row + 1]), h


def _sorted_windows(ids: np.ndarray, packed: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(super-k-mer, window in it) of every window whose words also start in a
    super-k-mer of a smaller id. The input holds whole bucket groups."""
    raw, start, end, first, row, windows, h = _windows(packed, k)
    if not len(windows):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    order = windows[np.lexsort((ids[row[windows]], h[windows]))]
    hs = h[order]
    new = np.ones(len(order), bool)
    new[1:] = hs[1:] != hs[:-1]
    head = np.flatnonzero(new)[np.cumsum(new) - 1]  # sorted place of the least id with this hash
    later = np.flatnonzero(ids[row[order]] > ids[row[order[head]]])
    text = raw.tobytes()
    a, b = start[order], end[order + k - 1]
    equal = np.fromiter((text[a[i]:b[i]] == text[a[g]:b[g]] for i, g in zip(later.tolist(), head[later].tolist())), bool, len(later))
    found = [order[later[equal]]]
    if not equal.all():  # equal hashes of unequal windows: settle these by their bytes
        for g in np.unique(head[later[~equal]]).tolist():
            stop = g + 1
            while stop < len(order) and not new[stop]:
                stop += 1
            least: dict[bytes, int] = {}
            for i in range(g, stop):  # in the order of ids
                least.setdefault(text[a[i]:b[i]], int(ids[row[order[i]]]))
            extra = [order[i] for i in range(g, stop) if ids[row[order[i]]] > least[text[a[i]:b[i]]]]
            found.append(np.array(extra, np.int64))
    got = np.unique(np.concatenate(found))
    return row[got], got - first[row[got]]


def _runs(owner: np.ndarray, word: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Consecutive windows of one owner as one span of words [start, end)."""
    if not len(owner):
        return owner, word, word
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (word[1:] != word[:-1] + 1)
    begin = np.flatnonzero(new)
    stop = np.append(begin[1:], len(owner)) - 1
    return owner[begin], word[begin], word[stop] + k


def _bucket_spans(params: Params):
    """Spans from rows sorted by minimiser, a few thousand super-k-mers (and
    whole groups) at a time."""
    def settle(rows: pa.Table):
        rows = rows.combine_chunks()
        ids = rows.column("id").to_numpy()
        sk, j = _sorted_windows(ids, rows.column("packed").chunk(0), params.window)
        owner, begin, end = _runs(sk, rows.column("w").to_numpy()[sk] + j, params.window)
        return pa.RecordBatch.from_arrays([pa.array(ids[owner]), pa.array(rows.column("key").to_numpy()[owner]), pa.array(begin),
                                           pa.array(end)], names=["id", "key", "start", "end"])

    def run(batches):
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += len(batch)
            if n < 8192:
                continue
            rows = pa.Table.from_batches(held)
            v = rows.column("v").to_numpy()
            whole = len(v) - int(np.argmax(v[::-1] != v[-1])) if v[0] != v[-1] else 0
            if whole:  # all groups but the last, which may go on
                yield settle(rows.slice(0, whole))
                held = rows.slice(whole).to_batches()
                n = len(v) - whole
        if n:
            yield settle(pa.Table.from_batches(held))
    return run


def _window_hash_rows(params: Params):
    """Hash and id of the single windows of super-k-mers (hot groups only)."""
    def run(batches):
        for batch in batches:
            for lo in range(0, len(batch), 2048):
                part = batch.slice(lo, 2048)
                *_, row, windows, h = _windows(part.column(5), params.window)
                yield pa.RecordBatch.from_arrays([pa.array(h[windows].view(np.int64)), part.column(1).take(pa.array(row[windows]))], names=["h", "id"])
    return run


def _window_rows(params: Params, shared):
    """The windows of super-k-mers whose hash several documents have (hot groups only)."""
    k = params.window

    def run(batches):
        for batch in batches:
            for lo in range(0, len(batch), 2048):
                part = batch.slice(lo, 2048)
                raw, start, end, first, row, windows, h = _windows(part.column(5), k)
                windows = windows[shared.value.test(h[windows])] if len(windows) else windows
                rows, text = row[windows], raw.tobytes()
                out = [text[a:b] for a, b in zip(start[windows].tolist(), end[windows + k - 1].tolist())]
                at = part.column(3).to_numpy()[rows] + windows - first[rows]
                rows = pa.array(rows)
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary()), part.column(1).take(rows), part.column(2).take(rows), pa.array(at)],
                                                 names=["win", "id", "key", "w"])
    return run


def duplicate_spans(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", params: Params = Params()) -> DataFrame:
    """Rows (id, key, start, end): words start..end-1 of the document (id, key)
    are covered by windows that also start in a document of a smaller id; key
    is a hash of the text, which tells apart documents that share an id."""
    spark = df.sparkSession
    if params.gram > params.window:
        raise ValueError("gram must not exceed window")
    texts = df.filter(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("key"),
                                                        text_bytes(text_col).alias("t"))

    def minimisers(batches):
        for batch in batches:
            raw, at = flat(batch.column(1))
            ids = batch.column(0)
            for lo, hi in steps(at):
                r, _, _, v, _, _ = super_kmers(raw[at[lo]:at[hi]], at[lo:hi + 1] - at[lo], params)
                yield pa.RecordBatch.from_arrays([pa.array(v), ids.take(pa.array(lo + r))], names=["v", "id"])

    seen = texts.select("id", "t").mapInArrow(minimisers, "v long, id long")
    shared = land(seen.groupBy("v").agg(F.min("id").alias("a"), F.max("id").alias("b"), F.count(F.lit(1)).alias("n"))
                  .filter("a < b").select("v", "n"), "minimisers")
    sc = spark.sparkContext
    keep, hot = sc.broadcast(hash_bitmap(shared, "v", params.filter_bits)), None
    beyond = shared.filter(F.col("n") > params.group_limit)
    if not beyond.isEmpty():
        hot = sc.broadcast(hash_bitmap(beyond, "v", params.hot_bits))

    kinds = "v long, id long, key long, w long, n long, packed binary"
    packed = texts.mapInArrow(_kmer_rows(params, keep, hot, False), kinds)
    spans = (packed.repartition("v").sortWithinPartitions("v")
             .mapInArrow(_bucket_spans(params), "id long, key long, start long, end long"))
    if hot is None:
        return spans
    packed = texts.mapInArrow(_kmer_rows(params, keep, hot, True), kinds)
    twice = (packed.mapInArrow(_window_hash_rows(params), "h long, id long").groupBy("h").agg(F.min("id").alias("a"), F.max("id").alias("b"))
             .filter("a < b"))
    shared = sc.broadcast(hash_bitmap(twice, "h", params.filter_bits))
    windows = land(packed.mapInArrow(_window_rows(params, shared), "win binary, id long, key long, w long"), "hot-windows")
    least = land(windows.groupBy("win").agg(F.min("id").alias("a"), F.max("id").alias("b")).filter("a < b").select("win", "a"), "hot-least")
    return spans.union(windows.join(least, "win").filter("id > a")
                       .select("id", "key", F.col("w").alias("start"), (F.col("w") + params.window).alias("end")))


def kept_ranges(spans: DataFrame) -> DataFrame:
    """Rows (id, key, keep): per document the word ranges (start, n) that no
    span covers, in order; the last one is open-ended."""
    order = Window.partitionBy("id", "key").orderBy("start", "end")
    before = F.coalesce(F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long"))
    gaps = spans.distinct().withColumn("from", before).select(
        "id", "key", "end", F.when(F.col("from") < F.col("start"), F.struct(F.col("from").cast("int").alias("start"), (F.col("start") - F.col("from")).cast("int").alias("n"))).alias("gap"))
    tail = F.struct(F.max("end").cast("int").alias("start"), F.lit(2**31 - 1).alias("n"))
    return gaps.groupBy("id", "key").agg(F.concat(F.array_sort(F.collect_list("gap")), F.array(tail)).alias("keep"))


def dedup_substrings(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", params: Params = Params(),
                     kept_out: str = "kept", removed_out: str = "n_removed", words_out: str = "n_words") -> DataFrame:
    """``df`` with the words that stay (joined by one space), the number of
    words and the number removed.

    Null, empty and shorter texts lose nothing; a null text keeps the empty
    string. A row with a null id neither loses words nor takes them from
    others, as no id is smaller or greater. Rows that repeat an id do not take
    words from each other. Every input row comes back once, other columns as
    they are; the added names must be free. An empty table gives none."""
    p = free_prefix(df, "_sd_")
    spans = land(duplicate_spans(df, id_col, text_col, params), "spans")
    keep = land(kept_ranges(spans), "kept-ranges").select(F.col("id").alias(f"{p}id"), F.col("key").alias(f"{p}key"), F.col("keep").alias(f"{p}keep"))
    marks = hash_bitmap(keep.select(F.xxhash64(f"{p}id", f"{p}key").alias("h")), "h", params.doc_bits)
    marked = bitmap_test(df.sparkSession.sparkContext.broadcast(marks))(
        F.xxhash64(df[id_col].cast("long"), F.xxhash64(df[text_col])))
    same = (df[id_col].cast("long") == F.col(f"{p}id")) & (F.xxhash64(df[text_col]) == F.col(f"{p}key"))
    joined = df.filter(marked).join(keep, same, "left")
    joined = joined.unionByName(df.filter(~marked), allowMissingColumns=True)
    words = F.filter(F.split(F.coalesce(joined[text_col], F.lit("")), SPACES), lambda w: w != "")
    out = joined.withColumn(f"{p}words", words)
    all_words = F.col(f"{p}words")
    stay = F.when(F.col(f"{p}keep").isNull(), all_words).otherwise(
        F.flatten(F.transform(f"{p}keep", lambda r: F.slice(all_words, r["start"] + 1, F.least(r["n"], F.size(all_words))))))
    out = out.withColumn(f"{p}stay", stay)
    return out.select(*(out[c] for c in df.columns), F.concat_ws(" ", f"{p}stay").alias(kept_out),
                      (F.size(f"{p}words") - F.size(f"{p}stay")).cast("long").alias(removed_out), F.size(f"{p}words").cast("long").alias(words_out))
