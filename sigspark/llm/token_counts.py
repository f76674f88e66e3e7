"""Exact token counts by prefix dynamic programming (sentencepiece BPE).

For a text the table holds the exact number of tokens of every prefix, so
truncation and budget questions are look-ups, not new encodings. Recurrence:
if t is the last token of the encoding of s[:j], the rest is the encoding of
s[:j-len(t)]; t is the one piece that encodes to itself and whose pair with
that prefix's own last token encodes to the two of them. So
count[j] = count[j - len(t)] + 1.

No piece has a blank after another character, so no merge crosses a word
start: the table of a text is the tables of its segments (a run of blanks and
the word after it) end to end, each added to the count before it. A segment's
table is computed once per task and shared by all its occurrences.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from functools import cached_property

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLANK = "▁"
# Segment tables in each of the two generations that a worker keeps (memory bound; results are the same).
CACHE_SEGMENTS = 600_000
STEP_CHARS = 4_000_000


Table = bytes | list  # token counts at every prefix, from the empty one on


class PrefixCounter:
    """Prefix tables for one sentencepiece BPE model with identity
    normalisation and a blank before the text."""

    def __init__(self, model_file: str):
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        with open(model_file, "rb") as f:
            proto.ParseFromString(f.read())
        norm = proto.normalizer_spec
        if (proto.trainer_spec.model_type != 2 or norm.precompiled_charsmap or norm.remove_extra_whitespaces
                or not norm.add_dummy_prefix or not norm.escape_whitespaces or not proto.trainer_spec.byte_fallback):
            raise ValueError("prefix tables need a BPE model with byte fallback, identity normalisation and a blank prefix")
        normal = [p for p in proto.pieces if p.type == 1]
        if any(p.type in (4, 5) for p in proto.pieces) or any(re.search(f"[^{BLANK}]{BLANK}", p.piece) for p in normal):
            raise ValueError("a piece crosses a word start, or is user-defined or unused")
        self._score = {p.piece: p.score for p in normal}
        self._longest = max(len(p.piece) for p in normal)
        # Control characters in no longer piece (line feeds, mostly) merge with nothing: they end a segment.
        inner = {c for p in normal if len(p.piece) > 1 for c in p.piece}
        alone = "".join(re.escape(chr(c)) for c in range(32) if chr(c) not in inner)
        self._segment = re.compile(f"[{alone}]|{BLANK}*[^{BLANK}{alone}]+|{BLANK}+")
        self._processor = SentencePieceProcessor(model_file=model_file)
        self._pairs: dict[tuple[str, str], bool] = {}
        # Pieces that encode to themselves: only these can end a prefix.
        self._tokens = frozenset(p for p in self._score if len(p) == 1 or self._merge(p) == [p])
        self._young: dict[str, Table] = {}
        self._old: dict[str, Table] = {}

    def _merge(self, text: str) -> list[str]:
        """BPE of a short string: the best-scored neighbouring pair first, leftmost on ties."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self._score.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _is_pair(self, a: str, b: str) -> bool:
        if len(self._pairs) >= CACHE_SEGMENTS:
            self._pairs.clear()
        fits = self._pairs[a, b] = self._merge(a + b) == [a, b]
        return fits

    def _encoded(self, segments: list[str]) -> list[int]:
        """The library's own counts; its blank prefix stands for a segment's
        first blank, and a line feed, which merges with nothing, for what is
        before a segment without one."""
        texts = [s[1:] if s[0] == BLANK else "\n" + s for s in segments]
        return [1 if s == BLANK else len(ids) - (0 if s[0] == BLANK else 2)
                for s, ids in zip(segments, self._processor.encode(texts, num_threads=1))]

    def _compute(self, segment: str, before: str, counts: list[int], sizes: list[int]) -> bool:
        """Extend counts and last-token lengths, which hold the prefixes of
        ``before``, to those of ``segment``; False if the recurrence finds no
        last token somewhere."""
        tokens, pairs, longest = self._tokens, self._pairs, self._longest
        same, most = 0, min(len(before), len(segment), len(counts) - 1)
        while same < most and before[same] == segment[same]:
            same += 1
        del counts[same + 1:], sizes[same + 1:]
        for j in range(same + 1, len(segment) + 1):
            for i in range(j - longest if j > longest else 0, j):  # the longest token first
                token = segment[i:j]
                if token not in tokens:
                    if i < j - 1:
                        continue
                    cost = len(token.encode("utf-8", "replace"))  # a character outside the vocabulary: its bytes
                else:
                    cost = 1
                if i:
                    pair = (segment[i - sizes[i]:i], token)
                    fits = pairs.get(pair)
                    if not (self._is_pair(*pair) if fits is None else fits):
                        continue
                counts.append(counts[i] + cost)
                sizes.append(j - i)
                break
            else:
                return False
        return True

    def _learn(self, segments: list[str]) -> dict[str, Table]:
        """Tables of new segments. The last count of each is compared with the
        library's; should they ever differ, the library counts every prefix of
        that segment."""
        if len(self._young) + len(segments) > CACHE_SEGMENTS:
            self._old, self._young = self._young, {}
        new, before, counts, sizes = {}, "", [0], [0]
        segments.sort()
        for segment, count in zip(segments, self._encoded(segments)):
            if self._compute(segment, before, counts, sizes) and counts[-1] == count:
                got = bytes(counts) if max(counts) < 256 else list(counts)
            else:
                got = [0, *self._encoded([segment[:j] for j in range(1, len(segment) + 1)])]
            before = segment
            new[segment] = got
            if len(segment) <= 64:  # longer ones hardly come again
                self._young[segment] = got
        return new

    def tables(self, texts: list[str | None]) -> list["PrefixTable"]:
        """The prefix tables of whole texts (null: the empty text)."""
        split = [self._segment.findall(BLANK + t.replace(" ", BLANK)) if t else [] for t in texts]
        young, old, tables, missing = self._young, self._old, {}, []
        for s in set().union(*split):
            got = young.get(s)
            if got is None:
                got = old.get(s)
                if got is None:
                    missing.append(s)
                    continue
                young[s] = got
            tables[s] = got
        if missing:
            tables.update(self._learn(missing))
        return [PrefixTable(list(map(tables.__getitem__, segments))) for segments in split]

    def prefixes(self, text: str | None) -> "PrefixTable":
        return self.tables([text])[0]


class PrefixTable:
    """Token counts at every prefix of one text, as segment tables end to end."""

    def __init__(self, tables: list):
        self._tables = tables
        self.tokens = sum([t[-1] for t in tables])

    # Characters and tokens before each segment. The blank put before the text
    # is no character of it, so positions are shifted by one.
    @cached_property
    def _at(self) -> np.ndarray:
        return np.cumsum([0, *(len(t) - 1 for t in self._tables)], dtype=np.int64)

    @cached_property
    def _sum(self) -> np.ndarray:
        return np.cumsum([0, *(t[-1] for t in self._tables)], dtype=np.int64)

    @property
    def chars(self) -> int:
        return max(0, sum(map(len, self._tables)) - len(self._tables) - 1)

    def count(self, chars: int) -> int:
        """Tokens of the prefix of so many characters (0: none)."""
        if chars <= 0 or not self._tables:
            return 0
        j = min(chars, self.chars) + 1
        k = bisect_right(self._at, j) - 1
        return int(self._sum[k]) + (self._tables[k][j - int(self._at[k])] if k < len(self._tables) else 0)

    def truncate(self, budget: int) -> int:
        """Characters of the longest prefix with at most ``budget`` tokens.
        Counts may fall as a prefix grows within a word, so the segments after
        the first overrun are looked at until none can come back under."""
        if self.tokens <= budget:
            return self.chars
        best, k = 0, int(np.searchsorted(self._sum, budget, side="right")) - 1
        for s in range(max(0, k - 1), len(self._tables)):
            base = int(self._sum[s])
            if base > budget:
                break
            inside = [j for j, c in enumerate(self._tables[s]) if base + c <= budget]
            best = max(best, int(self._at[s]) + max(inside))
        return max(0, best - 1)


_counters: dict[str, PrefixCounter] = {}


def _counter(model_file: str) -> PrefixCounter:
    """One counter per worker process: its tables serve all tasks that the process runs."""
    if model_file not in _counters:
        _counters[model_file] = PrefixCounter(model_file)
    return _counters[model_file]


def count_tokens(df: DataFrame, model_file: str, budget: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, n_bytes, n_tokens, over_limit, budget_chars), one per input row.

    n_tokens is the exact count of the whole text without added tokens;
    over_limit tells whether it exceeds ``budget``; budget_chars is the length
    of the longest prefix within it. A null or empty text has 0 of each and is
    never over. Repeated rows and null ids stay; an empty table gives none.
    ``model_file`` must exist on every executor. Other columns are not read."""
    def run(frames):
        counter = _counter(model_file)
        for frame in frames:
            got, lo, texts = [], 0, frame["t"].to_list()
            while lo < len(texts):  # texts of about STEP_CHARS at a time
                hi, size = lo, 0
                while hi < len(texts) and (hi == lo or size < STEP_CHARS):
                    size += len(texts[hi] or "")
                    hi += 1
                got += [(t.tokens, t.truncate(budget)) for t in counter.tables(texts[lo:hi])]
                lo = hi
            frame = frame.assign(n_tokens=[g[0] for g in got], budget_chars=[g[1] for g in got])
            yield frame[["id", "n_bytes", "n_tokens", "budget_chars"]].astype({"n_tokens": "int64", "budget_chars": "int64"})

    kind = df.select(id_col).schema[0].dataType.simpleString()
    rows = df.select(F.col(id_col).cast("string").alias("id"), F.coalesce(F.octet_length(text_col).cast("long"), F.lit(0).cast("long")).alias("n_bytes"),
                     F.col(text_col).alias("t"))
    out = rows.mapInPandas(run, "id string, n_bytes long, n_tokens long, budget_chars long")
    return out.select(F.col("id").cast(kind).alias("id"), "n_bytes", "n_tokens",
                      (F.col("n_tokens") > budget).alias("over_limit"), "budget_chars")
