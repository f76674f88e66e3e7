"""Benchmark decontamination by greedy string tiling.

A benchmark item leaks into a document if tiles (non-overlapping runs of words
that both share) cover most of the item, in whatever order they stand in the
document. Documents and items that share a seed (a run of ``min_match`` words)
are joined in the task that reads the document, against the broadcast seeds of
a bounded block of the benchmark; each such pair is tiled: the longest common
runs among unmarked words are found by running Karp-Rabin hashes, marked, and
the search is repeated down to ``min_match`` words.

The benchmark is dealt into blocks of some ``block_bytes``; each block is one pass
over the documents, whose results are landed before the next block is read, so
the driver and a worker hold one block at a time whatever the benchmark's size.
Documents are not shuffled.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigspark.llm.common import flat, fresh, gram_hashes, land, steps, text_bytes, word_bounds, word_hashes

_PUNCT = "“”„‘’‚—–…«»¿¡·•"
_APART = np.ones(256, dtype=bool)
for _lo, _hi in (("0", "9"), ("a", "z")):
    _APART[ord(_lo):ord(_hi) + 1] = False
_APART[0x80:] = False

MATCH = "array<struct<item_id:{},item_words:int,covered:int,tiles:array<struct<item_start:int,doc_start:int,words:int>>>>"


@dataclass(frozen=True)
class Params:
    """``min_match``: words of the shortest tile (and of a seed); ``coverage``:
    share of an item's words that tiles must cover."""

    min_match: int = 4
    coverage: float = 0.7
    block_bytes: int = 16 << 20


def normalised(column: str):
    """Lower case; some typographic marks as blanks. Words are runs of a-z, 0-9 and non-ASCII bytes."""
    return text_bytes(F.translate(F.lower(F.col(column)), _PUNCT, " " * len(_PUNCT)))


_BASE, _MOD = 1_000_003, (1 << 61) - 1


def _scan(item: list[int], doc: list[int], free_i: list[bool], free_d: list[bool], size: int) -> list[tuple[int, int, int]]:
    """Maximal common runs (length, item start, doc start) of ``size`` or more unmarked words."""
    power = pow(_BASE, size, _MOD)

    def hashes(words, free):
        h, run = 0, 0
        for j, w in enumerate(words):
            if not free[j]:
                h, run = 0, 0
                continue
            h, run = (h * _BASE + w) % _MOD, run + 1
            if run > size:
                h = (h - words[j - size] * power) % _MOD
            if run >= size:
                yield j - size + 1, h

    at = defaultdict(list)
    for p, h in hashes(doc, free_d):
        at[h].append(p)
    found = []
    for t, h in hashes(item, free_i):
        for p in at.get(h, ()):
            if t and p and free_i[t - 1] and free_d[p - 1] and item[t - 1] == doc[p - 1]:
                continue  # within a run that began earlier
            n = 0
            while t + n < len(item) and p + n < len(doc) and free_i[t + n] and free_d[p + n] and item[t + n] == doc[p + n]:
                n += 1
            if n >= size:
                found.append((n, t, p))
    return found


def greedy_tiles(item: list[int], doc: list[int], min_match: int) -> list[tuple[int, int, int]]:
    """Tiles (item start, doc start, length) of two sequences of word numbers:
    longest first, no word in two tiles."""
    free_i, free_d = [True] * len(item), [True] * len(doc)
    tiles = []
    size = max(min_match, min(20, len(item)))
    while True:
        found = _scan(item, doc, free_i, free_d, size)
        longest = max((n for n, _, _ in found), default=0)
        if longest > 2 * size:
            size = longest
            continue
        again = False
        for n, t, p in sorted(found, key=lambda x: (-x[0], x[1], x[2])):
            if all(free_i[t:t + n]) and all(free_d[p:p + n]):
                free_i[t:t + n] = [False] * n
                free_d[p:p + n] = [False] * n
                tiles.append((t, p, n))
            else:
                again = True  # partly taken: what is left of it may still be long enough
        if again:
            continue
        if size <= min_match:
            return tiles
        size = max(min_match, size // 2)


class Seeds:
    """The words of a block of benchmark items, and the hashes of their seeds."""

    def __init__(self, ids: list, texts: list[bytes | None], copies: list[int], min_match: int):
        raw, at = flat(pa.array(texts, pa.binary()))
        start, end, first = word_bounds(raw, at, _APART)
        hashes, text = word_hashes(raw, start, end), raw.tobytes()
        self.min_match = min_match
        self.items = {}
        found: dict[int, list] = defaultdict(list)  # by words of a seed: short items are seeds as a whole
        for i, key in enumerate(ids):
            a, b = int(first[i]), int(first[i + 1])
            if a == b:
                continue
            self.items[i] = (key, [text[x:y] for x, y in zip(start[a:b].tolist(), end[a:b].tolist())], copies[i])
            m = min(min_match, b - a)
            h = gram_hashes(hashes[a:b], m)
            found[m].append((h, np.full(len(h), i)))
        self.by_size = {}
        for m, parts in found.items():
            h, who = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
            order = np.argsort(h, kind="stable")
            self.by_size[m] = (h[order], who[order])

    def join(self, hashes: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray]:
        """(position, item) for every document seed that an item shares."""
        h, who = self.by_size[m]
        lo = np.searchsorted(h, hashes, side="left")
        hit = np.flatnonzero((lo < len(h)) & (h[np.minimum(lo, len(h) - 1)] == hashes))
        n = np.searchsorted(h, hashes[hit], side="right") - lo[hit]
        at = np.repeat(hit, n)
        return at, who[np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo[hit], n)]

    def tile(self, words: list[bytes], places: np.ndarray, item: int, coverage: float):
        """The match of one document with one item, or None. Words outside the
        shared seeds can be in no tile; runs of them become one separator."""
        key, target, _ = self.items[item]
        m = min(self.min_match, len(target))
        number = {w: i + 1 for i, w in enumerate(dict.fromkeys(target))}
        doc, where, last = [], [], -1
        for p in places.tolist():
            if p > last and doc:
                doc.append(0)
                where.append(-1)
            for j in range(max(p, last), p + m):
                doc.append(number.get(words[j], 0))
                where.append(j)
            last = max(last, p + m)
        if len(doc) < coverage * len(target):
            return None
        tiles = greedy_tiles([number[w] for w in target], doc, m)
        covered = sum(n for _, _, n in tiles)
        if covered < coverage * len(target):
            return None
        return {"item_id": key, "item_words": len(target), "covered": covered,
                "tiles": [{"item_start": t, "doc_start": where[p], "words": n} for t, p, n in sorted(tiles)]}


def _leaks(texts: pa.Array, seeds: Seeds, coverage: float) -> list[list[dict]]:
    raw, at = flat(texts)
    out: list[list[dict]] = [[] for _ in range(len(texts))]
    for lo, hi in steps(at):
        part = raw[at[lo]:at[hi]]
        start, end, first = word_bounds(part, at[lo:hi + 1] - at[lo], _APART)
        hashes = word_hashes(part, start, end)
        hits = []
        for m in seeds.by_size:
            where, item = seeds.join(gram_hashes(hashes, m), m)
            row = np.searchsorted(first, where, side="right") - 1
            ok = where + m <= first[row + 1]
            hits.append(np.stack([row[ok], item[ok], where[ok]]))
        if not hits:
            continue
        row, item, where = np.concatenate(hits, axis=1)
        order = np.lexsort((where, item, row))
        row, item, where = row[order], item[order], where[order]
        new = np.flatnonzero(np.diff(row, prepend=-1).astype(bool) | np.diff(item, prepend=-1).astype(bool))
        for a, b in zip(new.tolist(), np.append(new[1:], len(row)).tolist()):
            r, f = int(row[a]), int(first[row[a]])
            n = len(seeds.items[int(item[a])][1])
            if (b - a) * min(seeds.min_match, n) < coverage * n:
                continue  # too few seeds to cover the share even if none overlaps
            span = slice(f, int(first[r + 1]))
            words = _Words(part, start[span], end[span])
            got = seeds.tile(words, np.unique(where[a:b] - f), int(item[a]), coverage)
            if got:
                out[lo + r].extend([got] * seeds.items[int(item[a])][2])
    return out


class _Words:
    """The words of one document, cut out when asked for."""

    def __init__(self, raw: np.ndarray, start: np.ndarray, end: np.ndarray):
        self._raw, self._start, self._end = raw, start, end

    def __getitem__(self, i: int) -> bytes:
        return self._raw[self._start[i]:self._end[i]].tobytes()


def _judge(seeds, coverage: float, kind: str):
    @F.pandas_udf(kind)
    def judge(texts: pd.Series) -> pd.Series:
        return pd.Series(_leaks(pa.array(texts, pa.binary()), seeds.value, coverage))
    return judge


def _judges(benchmark: DataFrame, text_col: str, item_id: str, item_text: str, params: Params) -> Iterator[tuple]:
    """(column, last) for each block of the benchmark: the matches of a text with
    the block's items. A block is read when it is asked for, and the one before
    is released, so its column must be landed by then."""
    key = benchmark.schema[item_id].dataType.simpleString()
    items = land(benchmark.select(F.col(item_id).alias("id"), normalised(item_text).alias("t")).groupBy("id", "t").agg(F.count(F.lit(1)).alias("n")), "benchmark")
    total = items.agg(F.coalesce(F.sum(F.octet_length("t")), F.lit(0))).first()[0]
    blocks = max(1, -(-total // params.block_bytes))
    block = F.pmod(F.xxhash64("t", F.col("id").cast("string")), F.lit(blocks))
    for b in range(blocks):
        rows = items.filter(block == b).orderBy("id", "t").collect()
        texts = [bytes(r["t"]) if r["t"] is not None else None for r in rows]
        seeds = benchmark.sparkSession.sparkContext.broadcast(Seeds([r["id"] for r in rows], texts, [r["n"] for r in rows], params.min_match))

        yield _judge(seeds, params.coverage, MATCH.format(key))(normalised(text_col)), b == blocks - 1
        if b < blocks - 1:
            seeds.unpersist()


def with_leaks(df: DataFrame, benchmark: DataFrame, out_col: str, text_col: str = "text", item_id: str = "item_id",
               item_text: str = "text", params: Params = Params()) -> DataFrame:
    """``df`` with an array of the benchmark items that leak into each text
    (item id, its words, words covered, tiles), empty if none.

    Null and empty texts leak nothing; items without a word are in no document.
    Items and rows may repeat: each is judged by itself. Item ids may be of any
    atomic type; an item with a null id is matched and reported with a null id.
    An empty benchmark or table gives no matches. ``out_col`` must be free; other
    columns stay. With several blocks ``df`` is landed once a block; ``leaks``
    lands the matches only and ``drop_leaks`` the rows that are left."""
    out, names = df, []
    for judged, last in _judges(benchmark, text_col, item_id, item_text, params):
        names.append(out_col if last and not names else fresh(out, f"{out_col}_{len(names)}"))
        out = out.withColumn(names[-1], judged)
        if not last or len(names) > 1:
            out = land(out, "leaks")
    return out if len(names) == 1 else out.select(*df.columns, F.concat(*names).alias(out_col))


def leaks(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", params: Params = Params()) -> DataFrame:
    """Rows (id, item_id, item_words, covered, tiles): one per document and
    leaked item; documents without a leak have no row."""
    texts, parts = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")), []
    for judged, last in _judges(benchmark, "t", "item_id", "text", params):
        found = texts.select("id", F.explode(judged).alias("m")).select("id", "m.*")
        parts.append(found if last else land(found, "leaks"))
    return reduce(DataFrame.unionAll, parts)


def drop_leaks(df: DataFrame, benchmark: DataFrame, text_col: str = "text", params: Params = Params()) -> DataFrame:
    """``df`` without the rows into which a benchmark item leaks."""
    out, name = df, fresh(df, "leaks")
    for judged, last in _judges(benchmark, text_col, "item_id", "text", params):
        kept = out.withColumn(name, judged).filter(F.size(name) == 0).drop(name)
        out = kept if last else land(kept, "without-leaks")
    return out
