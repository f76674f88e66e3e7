"""Periodic runs in word sequences by a sparse diagonal DP.

A lag d is a diagonal. Its match length at word i is one more than at word i-1
if words i and i-d are equal, else nothing. A diagonal that ends with a match
of length m has found m + d words of period d. It is a run if m >= d and
m + d >= the least length. If a smaller period exists, the same stretch has
been found on that diagonal before, since the smaller lag's match starts earlier.

Words are read in order and only diagonals that an earlier occurrence opens are
kept. For lags below the least length an occurrence is the word itself. A
longer lag d must match at least d words, so only an earlier occurrence of the
whole u words from here on opens it, where u is the largest of 12, 24, 48, ...
up to d. An occurrence opens a diagonal at its first word only: there the words
before differ. There are O(n) such openings (maximal repeats whose gap is
bounded by their length), also in texts of one repeated word. An open diagonal
grows in blocks of words until two words differ, and emits its run at once.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigspark.llm.common import WORD, free_prefix, mix, steps

LEAST = 12
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def word_ids(words: list) -> np.ndarray:
    """A number per word; equal words have equal numbers, others differ."""
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    return np.fromiter(map(number.__getitem__, words), np.int64, len(words))


def _agree(a: np.ndarray, b: np.ndarray) -> int:
    """How many words two sequences share from their beginnings on."""
    n, lo, step = min(len(a), len(b)), 0, 64
    while lo < n:
        hi = min(n, lo + step)
        off = a[lo:hi] != b[lo:hi]
        first = int(off.argmax())
        if off[first]:
            return lo + first
        lo, step = hi, step * 4
    return n


def _short_lags(ids: np.ndarray, least: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(word, lag) where a lag below ``least`` opens a match that is long enough."""
    n, found = len(ids), []
    for d in range(1, min(least, n // 2 + 1)):
        same = np.zeros(n - d + 2, dtype=bool)
        same[1:-1] = ids[d:] == ids[:-d]
        edge = np.flatnonzero(same[1:] != same[:-1])
        start, end = edge[::2], edge[1::2]
        start = start[end - start >= max(d, least - d)] + d
        if len(start):
            found.append((start, np.full(len(start), d)))
    return found


def _openings(grams: np.ndarray, u: int, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """(word, lag) for lags u <= d < 2u: the u words from here on occurred d
    words before and the words before the two occurrences differ. None if no
    u words occur twice, so no longer ones do either."""
    order = np.argsort(grams, kind="stable")
    key = grams[order]
    again = key[1:] == key[:-1]
    if not again.any():
        return None
    twice = np.zeros(len(key), dtype=bool)
    twice[1:] |= again
    twice[:-1] |= again
    order, key = order[twice], key[twice]
    left = np.where(order > 0, ids[order - 1], -1)
    # Occurrences of one gram after the same word are a block: none opens a diagonal to another of its block.
    head = np.ones(len(key), dtype=bool)
    group = np.cumsum(np.concatenate([[True], key[1:] != key[:-1]]))
    head[1:] = (key[1:] != key[:-1]) | (left[1:] != left[:-1])
    block = np.cumsum(head) - 1
    first = np.flatnonzero(head)
    last = np.append(first[1:], len(key)) - 1
    span = np.int64(len(ids) + 1)
    place = group * span + order  # ascending: by gram, then by word
    at, prior = np.arange(len(key)), block - 1
    words, lags = [], []
    while len(at):
        on = prior >= 0
        at, prior = at[on], prior[on]
        on = (group[last[prior]] == group[at]) & (order[at] - order[last[prior]] < 2 * u)
        at, prior = at[on], prior[on]
        if not len(at):
            break
        use = left[first[prior]] != left[at]
        i, b = at[use], prior[use]
        lo = np.maximum(first[b], np.searchsorted(place, place[i] - (2 * u - 1)))
        hi = np.minimum(last[b] + 1, np.searchsorted(place, place[i] - u, side="right"))
        count = np.maximum(hi - lo, 0)
        j = np.repeat(lo - np.cumsum(count) + count, count) + np.arange(count.sum())
        i = np.repeat(i, count)
        words.append(order[i])
        lags.append(order[i] - order[j])
        prior = prior - 1
    return (np.concatenate(words), np.concatenate(lags)) if words else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def find_runs(ids: np.ndarray, least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of at least ``least`` words and two
    periods, by start, then period."""
    n = len(ids)
    if n < least:
        return []
    opened = _short_lags(ids, least)
    if n >= 2 * least:
        u, grams = 1, mix(ids.astype(np.uint64) + _A)
        width = least
        while u < width:  # the hash of u words, u = 1, 2, ... up to the least length
            step = min(u, width - u)
            grams = mix(grams[:len(grams) - step] * _A + grams[step:] * _B + np.uint64(u))
            u += step
        while n >= 2 * u:
            got = _openings(grams, u, ids)
            if got is None:
                break
            opened.append(got)
            grams = mix(grams[:len(grams) - u] * _A + grams[u:] * _B + np.uint64(u)) if len(grams) > u else grams[:0]
            u *= 2
    if not opened:
        return []
    word, lag = np.concatenate([w for w, _ in opened]), np.concatenate([d for _, d in opened])
    room = word + lag <= n  # a run needs a second period
    word, lag = word[room], lag[room]
    order = np.lexsort((lag, word))
    runs: dict[int, list[tuple[int, int]]] = {}  # start -> (end, period)
    for i, d in zip(word[order].tolist(), lag[order].tolist()):
        start = i - d
        if any(d % q == 0 and end >= i + d for end, q in runs.get(start, ())):
            continue  # a multiple of a period found: the same stretch
        m = _agree(ids[i:], ids[start:])
        if m >= d and m + d >= least:
            runs.setdefault(start, []).append((i + m, d))
    return sorted((start, end - start, q) for start, found in runs.items() for end, q in found)


def collapse(words: list, runs: list[tuple[int, int, int]]) -> list:
    """The words without those that a run repeats (all after its first period)."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return list(compress(words, (np.cumsum(change[:-1]) == 0).tolist()))


def periodic_runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST) -> DataFrame:
    """Rows (id, n_words, runs, collapsed), one per input row: the runs of the
    whole text's words by start, then period, and the words that no run
    repeats, joined by one space.

    A null, empty or blank text has no words, no runs and an empty collapsed
    text. Very long texts cost about n log n. Repeated rows and null ids stay;
    an empty table gives none. Other columns are not read."""
    run = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def batches(parts):
        for part in parts:
            for lo, hi in steps(np.cumsum([0, *(len(t or b"") for t in part.column(1).to_pylist())])):
                out_n, out_runs, out_text = [], [], []
                for text in part.column(1).slice(lo, hi - lo).to_pylist():
                    words = (text or b"").split()  # at the six ASCII blanks
                    runs = find_runs(word_ids(words), least)
                    out_n.append(len(words))
                    out_runs.append([{"start": s, "length": n, "period": q} for s, n, q in runs])
                    out_text.append(b" ".join(collapse(words, runs)))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).slice(lo, hi - lo), pa.array(out_n, pa.int64()), pa.array(out_runs, run), pa.array(out_text, pa.binary())],
                    names=["id", "n_words", "runs", "collapsed"])

    kind = df.schema[id_col].dataType.simpleString()
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("t"))
    out = rows.mapInArrow(batches, f"id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed binary")
    return out.withColumn("collapsed", F.decode("collapsed", "UTF-8"))


def plant_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` with a repeating tail in one text of ten, chosen by h = crc32 of
    the id's decimal digits: from word a = g % n on (g = h / 10), word i becomes
    word a + (i - a) % p, p = 1 + (n - a) / (3 + g % 8), and the words are joined
    by one space. Texts without words and null ids stay as they are."""
    p = free_prefix(df, "_pr_")
    h, g, words, first, period = (F.col(f"{p}{c}") for c in ("h", "g", "words", "first", "period"))
    chosen = h % 10 == 0
    work = df.withColumn(f"{p}h", F.crc32(F.col(id_col).cast("string").cast("binary")))
    work = work.withColumns({f"{p}g": F.floor(h / 10).cast("long"), f"{p}words": F.when(chosen, F.regexp_extract_all(text_col, F.lit(WORD), F.lit(0)))})
    some = chosen & (F.size(words) > 0)
    work = work.withColumn(f"{p}first", F.when(some, g % F.size(words)))
    work = work.withColumn(f"{p}period", F.when(some, 1 + F.floor((F.size(words) - first) / (3 + g % 8))))
    repeated = F.transform(words, lambda w, i: F.when(i < first, w).otherwise(F.get(words, (first + F.pmod(i - first, period)).cast("int"))))
    return work.withColumn(text_col, F.when(some, F.array_join(repeated, " ")).otherwise(F.col(text_col))).select(*df.columns)
