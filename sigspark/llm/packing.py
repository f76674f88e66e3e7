"""Packing token sequences into windows by non-negative least squares.

A document's full windows are sequences of their own; what is left of it, its
tail, is shorter than a window. The histogram of tail lengths (fewer numbers
than a window has tokens, whatever the input's size) is all the plan needs:

1. Shallow combinations of up to three tail lengths that fill a window exactly
   are enumerated (a frequent length may occur several times in one).
2. Non-negative least squares solves how often to repeat each: the repeats
   should use up every length's count.
3. The repeats are rounded up, most frequent first, as far as tails are left.
4. Residual tails are packed greedily: first whole, the longest with the longest
   that still fit, where a window fills exactly; the others are cut at their
   binary digits into pieces whose lengths are powers of two, and pieces of one
   length fill windows exactly. The last, open window is closed at its binary
   digits too. A sequence of a power of two is not padded, so nothing is.

Which window a tail gets depends on its rank among the tails of its length.
Ranks are counted within a partition while it is tokenised and offset by the
counts of the partitions before, so one length may hold any share of all tails.
The cut points depend on the length only, so every piece that a document can
give is known, with its checksum, when it is tokenised: token ids never travel.
"""

from __future__ import annotations

import json
import re
import zlib
from collections import Counter
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sigspark.llm.common import land, steps

@dataclass(frozen=True)
class Params:
    """``window``: a power of two. ``end_id`` closes every document.
    ``combinations``: columns of the least squares problem, at most, taken
    evenly from all; what they leave over is residual. ``frequent``: lengths
    that are also taken several times at once. ``rounds`` of descent."""

    window: int = 2048
    end_id: int = 1
    combinations: int = 60_000
    frequent: int = 4
    rounds: int = 400


# Fixed value: the pattern by which byte-level BPE of this kind takes pre-tokens.
_PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# A longer word, or so much white space beyond one blank a word, goes to the tokenizers library.
LONG_WORD = 1000


def _byte_of_character() -> dict[str, int]:
    """Byte-level BPE writes printable bytes as themselves and the others, in order, from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Encoder:
    """Token ids (little-endian 32-bit) by a byte-level BPE file of the
    tokenizers library. Where the file's merges are in the order of their ids,
    tiktoken takes the same vocabulary as ranks and gives the same ids in a
    third of the time; texts with an added token's text, a very long word or
    much white space go to the tokenizers library, as all do for other files."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        form = json.loads(self._tokenizer.to_str())
        pre, model, byte = form["pre_tokenizer"] or {}, form["model"], _byte_of_character()
        merges = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model.get("merges", [])]
        self._ranked = None
        if (form["normalizer"] is None and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space")
                and form["truncation"] is None and form["padding"] is None and model.get("dropout") is None and not model.get("ignore_merges")
                and not model.get("continuing_subword_prefix") and not model.get("end_of_word_suffix")
                and [model["vocab"].get(m) for m in merges] == list(range(256, 256 + len(merges)))):
            added = {t["content"] for t in form["added_tokens"]}
            ranks = {bytes(byte[c] for c in t): i for t, i in model["vocab"].items() if t not in added}
            self._ranked = tiktoken.Encoding("ranks", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})
        self._added = re.compile("|".join(re.escape(t["content"]) for t in form["added_tokens"]) or r"(?!)")

    def _plain(self, text: str) -> bool:
        words = text.split()
        return (len(text) - sum(map(len, words)) - len(words) < LONG_WORD and max(map(len, words), default=0) <= LONG_WORD
                and not self._added.search(text))

    def encode(self, text: str) -> bytes:
        if self._ranked is not None and self._plain(text):
            return self._ranked.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False).tobytes()
        return np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


_encoders: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    """One per worker process."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def _powers(n: int, window: int) -> list[int]:
    """The powers of two that add up to ``n`` < window, largest first."""
    return [window >> k for k in range(1, window.bit_length()) if n & (window >> k)]


def tokenize(df: DataFrame, tokenizer_file: str, id_col: str = "doc_id", text_col: str = "text", params: Params = Params(), keep_ids: bool = False) -> DataFrame:
    """One landed row per input row: its place (part, row), id, n_tokens with
    the end id, first_full (full windows in the partition before it), tail (its
    length), rank (tails of that length before it in the partition), the
    checksums of its full windows, of its tail, and of the tail's power-of-two
    pieces; with ``keep_ids`` the ids too (little-endian 32-bit)."""
    window, end = params.window, np.array([params.end_id], "<u4").tobytes()
    fields = [("part", pa.int64()), ("row", pa.int64()), ("n_tokens", pa.int64()), ("first_full", pa.int64()), ("tail", pa.int64()), ("rank", pa.int64()),
              ("full_crc", pa.list_(pa.int64())), ("tail_crc", pa.int64()), ("piece_crc", pa.list_(pa.int64()))] + [("ids", pa.binary())] * keep_ids

    def batches(parts):
        encoder, place = _encoder(tokenizer_file), TaskContext.get().partitionId()
        row, fulls, ranks = 0, 0, [0] * window
        for part in parts:
            at = np.cumsum([0, *part.column(2).to_pylist()])
            for lo, hi in steps(at):
                cells = {name: [] for name, _ in fields}
                for text in part.column(1).slice(lo, hi - lo).to_pylist():
                    ids = encoder.encode(text or "") + end
                    n = len(ids) // 4
                    full, tail = divmod(n, window)
                    cuts = [4 * (full * window + c) for c in accumulate(_powers(tail, window), initial=0)]
                    values = [place, row, n, fulls, tail, ranks[tail] if tail else 0,
                              [zlib.crc32(ids[4 * window * k:4 * window * (k + 1)]) for k in range(full)],
                              zlib.crc32(ids[4 * window * full:]), [zlib.crc32(ids[a:b]) for a, b in zip(cuts, cuts[1:])]] + [ids] * keep_ids
                    for (name, _), value in zip(fields, values):
                        cells[name].append(value)
                    row, fulls = row + 1, fulls + full
                    if tail:
                        ranks[tail] += 1
                yield pa.RecordBatch.from_arrays([part.column(0).slice(lo, hi - lo), *(pa.array(cells[n], t) for n, t in fields)],
                                                 names=["id", *(n for n, _ in fields)])

    kind = df.schema[id_col].dataType.simpleString()
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"), F.coalesce(F.octet_length(text_col), F.lit(0)).alias("size"))
    schema = (f"id {kind}, part long, row long, n_tokens long, first_full long, tail long, rank long, full_crc array<long>, tail_crc long, "
              "piece_crc array<long>" + ", ids binary" * keep_ids)
    return land(rows.mapInArrow(batches, schema), "tokens")


def combinations(counts: np.ndarray, params: Params) -> tuple[np.ndarray, np.ndarray]:
    """Lengths (rows of three, 0 for none) and how often each is taken, so that
    they fill a window: all pairs, triples evenly up to ``params.combinations``,
    and for the ``params.frequent`` lengths with most tokens several of them
    with up to two others."""
    window, lengths = params.window, np.flatnonzero(counts)
    held = np.zeros(window + 1, dtype=bool)
    held[lengths] = True

    def pairs(total: int, least: int = 1) -> np.ndarray:
        a = lengths[(lengths >= least) & (2 * lengths <= total)]
        a = a[held[total - a]]
        return np.stack([a, total - a], axis=1)

    def evenly(rows: np.ndarray, n: int) -> np.ndarray:
        return rows[np.linspace(0, len(rows) - 1, n).astype(np.int64)] if len(rows) > n else rows

    found = [(np.insert(pairs(window), 0, 0, axis=1), 1)]
    for n in lengths[np.argsort(-(counts * np.arange(window))[lengths], kind="stable")][:params.frequent].tolist():
        for k in evenly(np.arange(2, window // n + 1), 24).tolist():
            rest = window - n * k
            more = evenly(pairs(rest), 64)
            one = [[0, rest]] if rest == 0 or held[rest] else []
            found.append((np.insert(np.concatenate([more, np.array(one, np.int64).reshape(-1, 2)]), 0, n, axis=1), k))
    triples = [np.insert(pairs(window - a, a), 0, a, axis=1) for a in lengths[3 * lengths <= window].tolist()]
    triples = np.concatenate(triples) if triples else np.zeros((0, 3), np.int64)
    found.append((evenly(triples, max(0, params.combinations - sum(len(c) for c, _ in found))), 1))
    columns = np.concatenate([c for c, _ in found])
    times = np.ones_like(columns)
    times[:, 0] = np.repeat([k for _, k in found], [len(c) for c, _ in found])
    return columns, times


def least_squares(columns: np.ndarray, times: np.ndarray, counts: np.ndarray, rounds: int) -> np.ndarray:
    """x >= 0 that brings sum(x_c * uses of length l in c) near counts[l], long
    tails weighing more: projected gradient descent with momentum."""
    weight = np.arange(len(counts), dtype=np.float64) / max(1, len(counts) - 1)  # squared

    def uses(x):
        return sum(np.bincount(columns[:, k], x * times[:, k], len(counts)) for k in range(columns.shape[1]))

    def back(r):
        return sum(r[columns[:, k]] * times[:, k] for k in range(columns.shape[1]))

    probe = np.ones(len(columns))
    for _ in range(30):  # the largest curvature, by power iteration
        probe = back(weight * uses(probe))
        norm = np.linalg.norm(probe)
        if not norm:
            return np.zeros(len(columns))
        probe /= norm
    step = 1.0 / (1.05 * np.linalg.norm(back(weight * uses(probe))))
    x = look = np.zeros(len(columns))
    t = 1.0
    for _ in range(rounds):
        new = np.maximum(0.0, look - step * back(weight * (uses(look) - counts)))
        t, before = (1 + (1 + 4 * t * t) ** 0.5) / 2, t
        look = new + (before - 1) / t * (new - x)
        x = new
    return x


@dataclass
class Plan:
    """Tails of length ``length`` and rank ``first`` <= rank < ``stop`` go to
    sequence ``sequence`` + rank - first at ``offset``; ranks from ``cut[length]``
    on are cut into powers of two, whose places start at ``base[k][length]``
    among the pieces of 2**k tokens."""

    length: np.ndarray
    first: np.ndarray
    stop: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    cut: np.ndarray
    base: np.ndarray
    pieces_at: np.ndarray  # per k: the first token of the pieces of 2**k in the stream of all pieces
    whole: int  # sequences of whole tails
    stream: int  # tokens of all pieces
    window: int

    @property
    def sequences(self) -> int:
        rest = self.stream % self.window
        return self.whole + self.stream // self.window + bin(rest).count("1")


def plan_tails(counts: np.ndarray, params: Params = Params()) -> Plan:
    """The plan for a histogram of tails: counts[l] tails of l tokens."""
    window, left = params.window, counts.astype(np.int64).copy()
    left[0] = 0
    taken = np.zeros(window, np.int64)  # ranks of each length given away
    rows, whole = [], 0

    def use(lengths: list[int], most: int | None = None) -> None:
        nonlocal whole
        need = Counter(lengths)
        now = min(int(left[n]) // k for n, k in need.items())
        now = now if most is None else min(now, most)
        if now <= 0:
            return
        # Of a length that a combination holds twice, the first ranks go to its first place, the next to its second.
        offset = 0
        for n in lengths:
            rows.append((n, int(taken[n]), int(taken[n]) + now, whole, offset))
            taken[n] += now
            left[n] -= now
            offset += n
        whole += now

    columns, times = combinations(left, params)
    if len(columns):
        repeats = least_squares(columns, times, left.astype(np.float64), params.rounds)
        order = np.argsort(-repeats, kind="stable")
        for c, k, wanted in zip(columns[order].tolist(), times[order].tolist(), np.ceil(repeats[order] - 1e-6).astype(np.int64).tolist()):
            if wanted <= 0:
                break
            use([n for n, times in zip(c, k) for _ in range(times) if n], wanted)
    # Greedy: the longest with the longest that still fit; kept where the window fills exactly.
    for n in range(window - 1, 0, -1):
        while left[n]:
            lengths, room, spare = [n], window - n, left.copy()
            spare[n] -= 1
            while room:
                fit = np.flatnonzero(spare[1:room + 1])
                if not len(fit):
                    break
                m = int(fit[-1]) + 1
                lengths.append(m)
                spare[m] -= 1
                room -= m
            if room:
                break
            use(lengths)
    powers = window.bit_length() - 1
    base = np.zeros((powers, window), np.int64)
    pieces_at, stream = np.zeros(powers, np.int64), 0
    for k in range(powers - 1, -1, -1):
        held = left * (np.arange(window) >> k & 1)
        base[k] = np.cumsum(held) - held
        pieces_at[k], stream = stream, stream + (int(held.sum()) << k)
    cells = np.array(rows, np.int64).reshape(-1, 5)
    cells = cells[np.lexsort((cells[:, 1], cells[:, 0]))]
    return Plan(*cells.T, cut=taken, base=base, pieces_at=pieces_at, whole=whole, stream=stream, window=window)


def place_tails(plan: Plan, tail: np.ndarray, rank: np.ndarray) -> list[list[tuple[int, int, int]]]:
    """Per tail its pieces (length, sequence, offset) in order."""
    window, out = plan.window, [None] * len(tail)
    whole = rank < plan.cut[tail]
    span = np.int64(1) << 40
    at = np.searchsorted(plan.length * span + plan.first, tail * span + rank, side="right") - 1
    i = np.flatnonzero(whole & (tail > 0))
    sequence, offset = plan.sequence[at[i]] + rank[i] - plan.first[at[i]], plan.offset[at[i]]
    for j, n, s, o in zip(i.tolist(), tail[i].tolist(), sequence.tolist(), offset.tolist()):
        out[j] = [(n, s, o)]
    closed = plan.stream - plan.stream % window  # the open window's first token in the stream
    for j in np.flatnonzero(~whole | (tail == 0)).tolist():
        n, pieces = int(tail[j]), []
        for size in _powers(n, window):
            k = size.bit_length() - 1
            token = int(plan.pieces_at[k]) + ((int(plan.base[k][n]) + int(rank[j] - plan.cut[n])) << k)
            if token < closed:
                pieces.append((size, plan.whole + token // window, token % window))
            else:  # the open window: one sequence per binary digit of its tokens
                start, s = closed, plan.whole + closed // window
                for part in _powers(plan.stream - closed, window):
                    if token < start + part:
                        break
                    start, s = start + part, s + 1
                pieces.append((size, s, token - start))
        out[j] = pieces
    return out


def pack(tokens: DataFrame, params: Params = Params()) -> DataFrame:
    """Rows (part, row, id, start, length, ids_crc32, n_tokens, sequence_id,
    offset): the pieces of the documents of ``tokenize``, each token in one, in
    sequences of one window or of a power of two.

    A null or empty text is its end id. Equal documents, null ids and documents
    of any length are packed like any other; an empty table gives none."""
    spark, window = tokens.sparkSession, params.window
    # Class 0 counts full windows, class l the tails of l tokens.
    count = F.explode(F.array(F.struct(F.lit(0).cast("long").alias("tail"), F.size("full_crc").cast("long").alias("n")),
                              F.struct("tail", (F.col("tail") > 0).cast("long").alias("n")))).alias("c")
    counts = tokens.select("part", count).select("part", "c.*").groupBy("part", "tail").agg(F.sum("n").alias("n"))
    upto = F.sum("n").over(Window.partitionBy("tail").orderBy("part").rowsBetween(Window.unboundedPreceding, 0))
    counts = land(counts.withColumn("before", upto - F.col("n")), "tail-counts")
    histogram = np.zeros(window, np.int64)
    for r in counts.groupBy("tail").agg(F.sum("n").alias("n")).collect():  # at most ``window`` rows
        histogram[r["tail"]] = r["n"]
    plan = plan_tails(histogram, params)
    shared = spark.sparkContext.broadcast(plan)
    names = ["id", "start", "length", "ids_crc32", "n_tokens", "sequence_id", "offset"]
    kind = tokens.schema["id"].dataType.simpleString()

    def batches(parts):
        plan = shared.value
        for part in parts:
            c = {n: part.column(n).to_pylist() for n in ("part", "row", "n_tokens", "full_crc", "tail_crc", "piece_crc")}
            first = part.column("first_full").to_numpy() + part.column("fulls_before").to_numpy()
            tail = part.column("tail").to_numpy()
            rank = part.column("rank").to_numpy() + part.column("before").to_numpy()
            rows, at = [], []
            for i, pieces in enumerate(place_tails(plan, tail, rank)):
                full = c["full_crc"][i]
                for k, crc in enumerate(full):
                    rows.append((c["part"][i], c["row"][i], k * window, window, crc, c["n_tokens"][i], plan.sequences + int(first[i]) + k, 0))
                start = len(full) * window
                for (n, s, o), crc in zip(pieces, [c["tail_crc"][i]] if len(pieces) == 1 else c["piece_crc"][i]):
                    rows.append((c["part"][i], c["row"][i], start, n, crc, c["n_tokens"][i], s, o))
                    start += n
                at += [i] * (len(rows) - len(at))
            cells = [pa.array(v, pa.int64()) for v in zip(*rows)] if rows else [pa.array([], pa.int64())] * 8
            yield pa.RecordBatch.from_arrays([*cells[:2], part.column("id").take(pa.array(at, pa.int64())), *cells[2:]], names=["part", "row", *names])

    fulls = counts.filter("tail = 0").select(F.col("part").alias("q"), F.col("before").alias("fulls_before"))
    before = counts.join(fulls, F.col("part") == F.col("q")).select(F.col("part").alias("p"), F.col("tail").alias("t"), "before", "fulls_before")
    narrow = tokens.select("part", "row", "id", "n_tokens", "first_full", "tail", "rank", "full_crc", "tail_crc", "piece_crc")
    rows = narrow.join(before, (F.col("part") == F.col("p")) & (F.col("tail") == F.col("t"))).drop("p", "t")
    out = ", ".join(f"{n} {kind if n == 'id' else 'long'}" for n in ["part", "row", *names])
    return rows.mapInArrow(batches, out)


def sequences(tokens: DataFrame, pieces: DataFrame) -> DataFrame:
    """Rows (sequence_id, ids): the packed sequences themselves, from tokens
    landed with their ids and the pieces of ``pack``."""
    slices = pieces.join(tokens.select(F.col("part").alias("p"), F.col("row").alias("r"), F.col("ids").alias("all")),
                         (F.col("part") == F.col("p")) & (F.col("row") == F.col("r")))
    slices = slices.select("sequence_id", "offset", F.expr("substring(all, int(4 * start) + 1, int(4 * length))").alias("ids"))
    parts = slices.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return parts.select("sequence_id", F.aggregate(F.col("parts.ids"), F.lit(b""), lambda a, x: F.concat(a, x)).alias("ids"))
