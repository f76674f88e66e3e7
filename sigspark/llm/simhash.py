"""SimHash near-duplicates by anchor-point covering.

A fingerprint is 64 bits. Anchors are the words of a covering code: the product
of two perfect binary Golay codes [23,12,7] over bits 0-22 and 23-45 (covering
radius 3 each) and of the single all-free word over the other 18 bits. Every
fingerprint x lies within the covering radius of exactly one anchor, home(x).
If x and y differ in t bits or fewer, y lies within covering radius plus t of
home(x), with the t extra bits shared out between the two blocks; so each
fingerprint is replicated to every anchor within the radius plus the threshold
(61 anchors on average at t = 2), and per anchor the visitors are compared with
the fingerprints at home there. Each linked pair is found exactly once.

Two Golay blocks give 2**24 anchors: ten billion distinct fingerprints mean
some 600 at home per anchor. The comparison is a join on the anchor, so a hot
anchor is split by the skew join, and only links come out: a fingerprint has
2,080 neighbours at most, whatever the input.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigspark.llm.common import land, text_bytes
from sigspark.llm.components import connected_components

SHINGLE, MAX_BITS, SEED = 3, 2, 42
GOLAY_POLY = 0b101011100011  # fixed value: generator polynomial of the binary Golay code
BLOCK, RADIUS = 23, 3


def fingerprint(text: bytes | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The 64-bit SimHash of one text (0 if it has no word)."""
    words = (text or b"").lower().split()  # on bytes: only A-Z and ASCII white space
    if not words:
        return 0
    total, ones, digest = max(1, len(words) - shingle + 1), np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for lo in range(0, total, 1 << 15):  # bounded work space, however long the text
        part = words[lo:lo + (1 << 15) + shingle - 1]
        line, ends, end = b" ".join(part), [], -1
        for w in part:
            end += 1 + len(w)
            ends.append(end)
        starts = [0, *(e + 1 for e in ends)]
        h = np.fromiter((digest(line[a:b], seed) for a, b in zip(starts, ends[shingle - 1:] or ends[-1:])), np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > total, bitorder="little").tobytes(), "little")


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                 seed: int = SEED) -> DataFrame:
    """Rows (id, fp): fp the fingerprint as a signed long. One row per input row."""
    def compute(batches):
        for batch in batches:
            fp = np.array([fingerprint(t.as_py(), shingle, seed) for t in batch.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp.view(np.int64))], names=["id", "fp"])

    kind = df.select(id_col).schema[0].dataType.simpleString()
    return df.select(F.col(id_col).alias("id"), text_bytes(text_col).alias("t")).mapInArrow(compute, f"id {kind}, fp long")


def _syndromes(x: np.ndarray) -> np.ndarray:
    """Remainder of each 23-bit word by the generator polynomial (11 bits)."""
    x = x.astype(np.int64).copy()
    for bit in range(BLOCK - 1, 10, -1):
        x ^= np.where((x >> bit) & 1 == 1, GOLAY_POLY << (bit - 11), 0)
    return x


class GolayAnchors:
    """For one 23-bit block: the codewords near a word, as error patterns by
    syndrome, sorted by how far beyond the covering radius they lie."""

    def __init__(self, extra: int):
        weights = [sum(1 << b for b in bits) for w in range(RADIUS + extra + 1) for bits in combinations(range(BLOCK), w)]
        over = [max(0, w - RADIUS) for w in range(RADIUS + extra + 1) for _ in combinations(range(BLOCK), w)]
        e, over = np.array(weights, np.int64), np.array(over, np.int64)
        s = _syndromes(e)
        order = np.lexsort((e, over, s))
        self.error = e[order]
        code = s[order] * (extra + 1) + over[order]
        # first[s, k]: where the patterns of syndrome s with k or more extra bits begin
        self.first = np.searchsorted(code, np.arange(2048 * (extra + 1) + 1))
        self.extra = extra
        table = np.zeros((3, 256), np.int64)
        for part in range(3):
            table[part] = _syndromes(np.arange(256, dtype=np.int64) << (8 * part) & ((1 << BLOCK) - 1))
        self._table = table

    def syndrome(self, x: np.ndarray) -> np.ndarray:
        return self._table[0][x & 255] ^ self._table[1][(x >> 8) & 255] ^ self._table[2][x >> 16]

    def span(self, s: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        """Begin and count of the patterns with low..high extra bits."""
        begin = self.first[s * (self.extra + 1) + low]
        return begin, self.first[s * (self.extra + 1) + high + 1] - begin


def _ragged(begin: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row number and index for every entry of the ranges begin..begin+count."""
    row = np.repeat(np.arange(len(count)), count)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(begin, count)


def anchors(fp: np.ndarray, code: GolayAnchors, extra: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, anchor) for every anchor within the covering radius plus ``extra`` bits."""
    low = (1 << BLOCK) - 1
    x = fp.view(np.uint64)
    a, b = (x & np.uint64(low)).astype(np.int64), ((x >> np.uint64(BLOCK)) & np.uint64(low)).astype(np.int64)
    sa, sb = code.syndrome(a), code.syndrome(b)
    rows, out = [], []
    for k in range(extra + 1):  # k extra bits in the first block leave extra - k for the second
        row, i = _ragged(*code.span(sa, k, k))
        left = a[row] ^ code.error[i]
        begin, count = code.span(sb[row], 0, extra - k)
        pair, j = _ragged(begin, count)
        rows.append(row[pair])
        out.append((left[pair] << BLOCK) | (b[row[pair]] ^ code.error[j]))
    return np.concatenate(rows), np.concatenate(out)


def links(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Rows (a, b), a < b, for every pair of distinct fingerprints (column fp)
    that differ in ``max_bits`` bits or fewer."""
    def replicate(extra, names):
        def run(batches):
            code = GolayAnchors(extra)
            for batch in batches:
                all_fp = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
                for i in range(0, len(all_fp), 2048):
                    fp = all_fp[i:i + 2048]
                    row, anchor = anchors(fp, code, extra)
                    yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(fp[row])], names=names)
        return run

    home = distinct.select("fp").mapInArrow(replicate(0, ["anchor", "a"]), "anchor long, a long")
    visit = distinct.select("fp").mapInArrow(replicate(max_bits, ["anchor", "b"]), "anchor long, b long")
    near = (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)
    return visit.join(home, "anchor").filter(near).select("a", "b")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    max_bits: int = MAX_BITS, seed: int = SEED) -> DataFrame:
    """Rows (id, fp, component): one per input row, component the least id whose
    fingerprint is reachable over links of ``max_bits`` bits or fewer.

    Null and word-free texts have fingerprint 0 and link like any other.
    Repeated rows stay and share their component. A null id keeps its row; the
    component is null only if every id in it is. An empty table gives none.
    Other columns are not read."""
    marked = land(fingerprints(df, id_col, text_col, shingle, seed), "fingerprints")
    least = land(marked.groupBy("fp").agg(F.min("id").alias("least")), "distinct")
    nodes = land(connected_components(links(least, max_bits)), "components")
    grouped = least.join(nodes, least.fp == nodes.node, "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("root"))
    grouped = land(grouped, "grouped")
    smallest = grouped.groupBy("root").agg(F.min("least").alias("component"))
    classes = land(grouped.join(smallest, "root").select("fp", "component"), "classes")
    return marked.join(classes, "fp").select("id", "fp", "component")
