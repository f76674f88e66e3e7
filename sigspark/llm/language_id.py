"""Language identification by nearest centroid.

A text is a vector of hashed character n-grams (1 to 4 bytes of its lower-cased
words), weighted by log(1 + count) times inverse document frequency and scaled
to length one. Each language has several centroids (spherical k-means over its
labelled sample); a text gets the language of the centroid with the largest
cosine. It is rejected if it has no letter, or if it lies further from that
centroid than the language's rejection radius for texts of its length.

Different n-grams may share a slot, so the model also has the n-grams themselves
that it was fitted on. All others count in a text's length, each on its own, and
never in its product with a centroid. The radius is set from pieces of the
sample's texts, a class of lengths at a time.

Document frequencies count every labelled training row. Only the centroids are
fitted on a sample: up to ``Params.per_language`` different texts of every
language, so copies of a text neither fill the sample nor empty it. A centroid
that lies at another language's, nearer than at those of its own, stands for
mislabelled rows and is dropped; a second script or variety lies at no other
language's and stays, however small its share.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sigspark.llm.common import STEP_BYTES, flat, land, steps, text_bytes

UNKNOWN = "und"


@dataclass(frozen=True)
class Params:
    """A centroid of fewer than ``least_texts`` texts, or whose cosine with a
    larger centroid of another language is ``twin`` or more and above that with
    its own language's others, is dropped; the largest of a language stays.
    ``radius_margin``: a language
    accepts texts whose cosine is at least this share of the cosine that all but
    ``radius_quantile`` of its sample's pieces of that length class reach; rows
    of dropped centroids do not count. ``longest`` is 4 at most."""

    dims: int = 1 << 13
    longest: int = 4
    per_language: int = 600
    centroids: int = 4
    rounds: int = 12
    least_texts: int = 5
    twin: float = 0.6
    radius_margin: float = 0.4
    radius_quantile: float = 0.05
    seed: int = 7


_DIGIT = np.ones(256, np.uint32)  # of n-grams as numbers: gap, a-z, bytes of UTF-8
_DIGIT[ord("a"):ord("z") + 1] = np.arange(2, 28)
_DIGIT[0x80:0xF5] = np.arange(28, 28 + 0x75)
_BASE = 28 + 0x75


class Seen:
    """A set of n-grams as numbers, exact. It travels as the sorted numbers; a
    test looks up a bit (75 MB of address space, of which memory holds the
    pages in use)."""

    def __init__(self, keys: np.ndarray):
        self.keys = np.unique(keys).astype(np.uint32)

    def __getstate__(self):
        return {"keys": self.keys}

    @cached_property
    def _bits(self) -> np.ndarray:
        bits = np.zeros((_BASE ** 4 >> 3) + 1, np.uint8)
        np.bitwise_or.at(bits, self.keys >> 3, np.uint8(1) << (self.keys & 7).astype(np.uint8))
        return bits

    def test(self, keys: np.ndarray) -> np.ndarray:
        return (self._bits[keys >> 3] >> (keys & 7).astype(np.uint8)) & 1 == 1


# Texts of up to 16, 32, 64, ... different n-grams, the last class longer ones as
# well. A word that is repeated is as short as the word.
CLASSES = 11


def length_class(grams: np.ndarray) -> np.ndarray:
    return np.clip(np.ceil(np.log2(np.maximum(grams, 1))).astype(np.int64) - 4, 0, CLASSES - 1)


def _merged(tallies: list) -> tuple[np.ndarray, np.ndarray]:
    """Different keys of (keys, times) pairs, and their times."""
    if not tallies:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    keys, at = np.unique(np.concatenate([k for k, _ in tallies]), return_inverse=True)
    return keys, np.bincount(at, np.concatenate([t for _, t in tallies]), len(keys)).astype(np.int64)


@dataclass(frozen=True)
class Model:
    """Fitted model; its size is dims * 4 bytes for each of at most
    ``centroids`` centroids a language, and 4 bytes an n-gram."""

    params: Params
    idf: np.ndarray  # dims
    centroids: np.ndarray  # rows x dims, unit length
    languages: list[str]  # of each row
    floor: np.ndarray  # lowest accepted cosine of each row, per length class
    seen: Seen  # n-grams that the centroids may count
    new: float  # weight of any other


_LETTER = np.zeros(256, dtype=np.uint8)
_LETTER[ord("a"):ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_LETTER[0x80:] = np.arange(0x80, 0x100)


def counts(raw: np.ndarray, at: np.ndarray, params: Params, seen: Seen | None = None, other: list | None = None) -> np.ndarray:
    """n-gram counts (rows x dims) of lower-cased UTF-8 texts laid end to end.
    Everything but a-z and non-ASCII bytes ends a word; n-grams of two or more
    bytes may begin or end with one such gap, never hold two.

    ``other`` gets row << 32 | number of every n-gram that ``seen`` lacks
    instead (no ``seen``: of every n-gram, which is counted as well), and times."""
    rows, dims = len(at) - 1, params.dims
    code = _LETTER[raw]
    # One gap byte after every text and a run of gaps as one.
    where = np.arange(len(raw)) + np.repeat(np.arange(rows), np.diff(at))
    line = np.zeros(len(raw) + rows, np.uint8)
    line[where] = code
    row = np.repeat(np.arange(rows, dtype=np.int64), np.diff(at) + 1)
    keep = np.ones(len(line), bool)
    keep[1:] = (line[1:] != 0) | (line[:-1] != 0)
    line, row = line[keep], row[keep]
    out = np.zeros(rows * dims, np.int64)
    h = np.zeros(len(line), np.uint32)
    shift = np.uint32(32 - (dims - 1).bit_length())
    if other is not None:
        digits, key, keys = _DIGIT[line], np.zeros(len(line), np.uint32), []
    for n in range(1, params.longest + 1):
        size = len(line) - n + 1
        if size <= 0:
            break
        h = h[:size] * np.uint32(0x01000193) + line[n - 1:].astype(np.uint32) + np.uint32(n)
        ok = row[:size] == row[n - 1:]  # the gap byte at a text's end is its own
        for j in range(1, n - 1):  # gaps only at either end
            ok &= line[j:j + size] != 0
        ok &= (line[:size] != 0) | (line[n - 1:] != 0)
        if other is not None:
            key = key[:size] * np.uint32(_BASE) + digits[n - 1:]
            new = ok if seen is None else ok & ~seen.test(key)
            keys.append(row[:size][new] << 32 | key[new])
            if seen is not None:
                ok &= ~new
        slot = ((h * np.uint32(0x9E3779B1)) >> shift).astype(np.int64)
        out += np.bincount(row[:size][ok] * dims + slot[ok], minlength=rows * dims)
    if other is not None and keys:
        other.append(np.unique(np.concatenate(keys), return_counts=True))
    return out.reshape(rows, dims)


def long_counts(raw: np.ndarray, params: Params, seen: Seen | None = None, other: list | None = None) -> np.ndarray:
    """Counts of one long text, a piece at a time. Pieces meet in a gap that
    both hold, so no n-gram is lost or counted twice."""
    total, a = np.zeros((1, params.dims), np.int64), 0
    while a < len(raw):
        b = min(a + STEP_BYTES, len(raw))
        if b < len(raw):
            gaps = np.flatnonzero(_LETTER[raw[a + 1:b]] == 0)
            b = a + 2 + int(gaps[-1]) if len(gaps) else b
        total += counts(raw[a:b], np.array([0, b - a]), params, seen, other)
        if other and len(other) > 8:
            other[:] = [_merged(other)]
        a = b - 1 if b < len(raw) and _LETTER[raw[b - 1]] == 0 else b
    return total


def _blocks(texts: pa.Array, params: Params, seen: Seen | None = None, other: list | None = None):
    """Counts of blocks of texts, in row order; ``other`` is that of the block."""
    raw, at = flat(texts)
    for lo, hi in steps(at):
        for a in range(lo, hi, 128):
            b = min(a + 128, hi)
            part, ends = raw[at[a]:at[b]], at[a:b + 1] - at[a]
            if other is not None:
                other.clear()
            yield counts(part, ends, params, seen, other) if len(part) <= 2 * STEP_BYTES else long_counts(part, params, seen, other)


def vectors(texts: pa.Array, idf: np.ndarray | None, params: Params):
    """Blocks of unit vectors (zero for a text without n-grams), in row order;
    without ``idf`` the raw counts."""
    for c in _blocks(texts, params):
        if idf is None:
            yield c
        else:
            x = np.log1p(c).astype(np.float32) * idf
            size = np.sqrt((x * x).sum(axis=1, keepdims=True))
            yield np.divide(x, size, out=np.zeros_like(x), where=size > 0)


def cosines(texts: pa.Array, idf: np.ndarray, centroids: np.ndarray, seen: Seen, new: float, params: Params):
    """Blocks of cosines with the centroids, and length classes, in row order.
    N-grams not ``seen`` have slots of their own, where centroids are zero."""
    other: list = []
    for c in _blocks(texts, params, seen, other):
        x = np.log1p(c).astype(np.float32) * idf
        size = (x * x).sum(axis=1)
        keys, times = _merged(other)
        size += np.bincount(keys >> 32, (np.log1p(times) * new) ** 2, len(c)).astype(np.float32)
        size = np.sqrt(size)[:, None]
        sims = x @ centroids.T
        yield np.divide(sims, size, out=np.zeros_like(sims), where=size > 0), length_class((c > 0).sum(axis=1) + np.bincount(keys >> 32, minlength=len(c)))


def _pieces(texts: pa.Array) -> pa.Array:
    """Of every text its beginnings of 4, 8, 16, ... letters or a little more (to
    the end of the word, 64 bytes at most), as far as it goes, and the whole."""
    raw, at = flat(texts)
    out = []
    for a, b in zip(at, at[1:]):
        text = raw[a:b]
        is_letter = _LETTER[text] != 0
        letters = np.flatnonzero(is_letter)
        for k in range(2, CLASSES + 2):
            if len(letters) <= 1 << k:
                break
            end = int(letters[(1 << k) - 1]) + 1
            gaps = np.flatnonzero(~is_letter[end:end + 64])
            out.append(text[:end + (int(gaps[0]) if len(gaps) else 0)].tobytes())
        out.append(text.tobytes())
    return pa.array(out, pa.binary())


def _floors(near: np.ndarray, classes: np.ndarray, params: Params) -> np.ndarray:
    """Lowest accepted cosine of each length class; a class of fewer
    than five pieces has that of the next shorter one with as many, or else of
    the next longer."""
    known = {}
    for k in range(CLASSES):
        got = near[classes == k]
        if len(got) >= 5:
            known[k] = float(np.quantile(got, params.radius_quantile))
    if not known:
        return np.full(CLASSES, params.radius_margin * (float(np.quantile(near, params.radius_quantile)) if len(near) else 0.0), np.float32)
    out, last = [], known[min(known)]
    for k in range(CLASSES):
        last = known.get(k, last)
        out.append(last)
    return np.asarray(out, np.float32) * np.float32(params.radius_margin)


def _frequencies(texts: DataFrame, params: Params) -> tuple[np.ndarray, int]:
    """Document frequency of each slot, and the number of documents."""
    def run(batches):
        total, n = np.zeros(params.dims, np.int64), 0
        for batch in batches:
            for c in vectors(batch.column(0), None, params):
                total += (c > 0).sum(axis=0)
                n += len(c)
        slots = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(slots, -1)), pa.array(np.append(total[slots], n))], names=["slot", "n"])

    got = texts.select("t").mapInArrow(run, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(params.dims, np.int64)
    real = got[got["slot"] >= 0]
    out[real["slot"].to_numpy()] = real["n"].to_numpy()
    return out, int(got.loc[got["slot"] < 0, "n"].sum())


def _kmeans(x: np.ndarray, k: int, rounds: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means; unit centroids and each row's own. Begins with rows far apart."""
    rng = np.random.default_rng(seed)
    first = [int(rng.integers(len(x)))]
    near = x @ x[first[0]]
    while len(first) < min(k, len(x)):
        gap = np.maximum(0, 1 - near)
        total = gap.sum()
        first.append(int(rng.choice(len(x), p=gap / total)) if total > 0 else len(first))
        near = np.maximum(near, x @ x[first[-1]])
    c = x[first].copy()
    for _ in range(rounds):
        own = np.argmax(x @ c.T, axis=1)
        for j in range(len(c)):
            if (own == j).any():
                mean = x[own == j].mean(axis=0)
                c[j] = mean / max(np.linalg.norm(mean), 1e-12)
    return c, np.argmax(x @ c.T, axis=1)


def _lowered(column: str):
    return text_bytes(F.lower(F.col(column)))


def fit(df: DataFrame, text_col: str = "text", lang_col: str = "lang", params: Params = Params()) -> Model:
    """Fit on the rows of ``df`` with a text that has a letter and a non-null
    language. No such rows: a model without centroids, which rejects all."""
    if params.longest > 4:
        raise ValueError("n-grams of more than 4 bytes")
    rows = df.filter(F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}")).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("raw"))
    frequency, n = _frequencies(rows.select(_lowered("raw").alias("t")), params)
    idf = (np.log((1 + n) / (1 + frequency)) + 1).astype(np.float32)
    new = float(np.log(1 + n) + 1)

    # The sample: a seeded hash of the whole text picks some two different texts
    # of every one wanted, then the first by that hash up to the bound.
    keyed = rows.withColumn("h", F.xxhash64("raw", F.lit(params.seed)))
    per = keyed.select("lang", "h").distinct().groupBy(F.col("lang").alias("of")).agg(F.count(F.lit(1)).alias("texts"))
    some = F.pmod("h", F.lit(1_000_000)) < F.least(F.lit(1.0), F.lit(2.0 * params.per_language) / F.col("texts")) * 1_000_000
    order = Window.partitionBy("lang").orderBy("h", "raw")
    # ``per`` has one row a language, far less than the model itself; a shuffle join would send every text.
    sample = land(keyed.join(F.broadcast(per), F.col("lang") == F.col("of")).filter(some).select("lang", "h", "raw").dropDuplicates(["lang", "h"])
                  .withColumn("k", F.row_number().over(order)).filter(F.col("k") <= params.per_language)
                  .select("lang", "h", _lowered("raw").alias("t")), "language-sample")

    def cluster(frame: pd.DataFrame) -> pd.DataFrame:
        x = np.concatenate(list(vectors(pa.array(frame.sort_values("h")["t"], pa.binary()), idf, params)))
        c, own = _kmeans(x, params.centroids, params.rounds, params.seed)
        return pd.DataFrame({"lang": frame["lang"].iloc[0], "c": list(c.astype(np.float32)), "held": np.bincount(own, minlength=len(c))})

    got = sample.groupBy("lang").applyInPandas(cluster, "lang string, c array<float>, held long").toPandas()
    got = got.sort_values(["lang", "held"], ascending=[True, False], kind="stable").reset_index(drop=True)
    stack = lambda column, width: np.array([np.asarray(c, np.float32) for c in got[column]], np.float32).reshape(-1, width)
    if not len(got):
        return Model(params, idf, stack("c", params.dims), [], np.zeros((0, CLASSES), np.float32), Seen(np.zeros(0, np.uint32)), new)
    centroids, languages = stack("c", params.dims), got["lang"].to_numpy()
    kept = genuine(centroids, languages, got["held"].to_numpy(), params)
    every = sample.sparkSession.sparkContext.broadcast((centroids, languages, kept))

    def measure(frame: pd.DataFrame) -> pd.DataFrame:
        centroids, languages, kept = every.value
        mine = languages == frame["lang"].iloc[0]
        texts, c, stays = pa.array(frame["t"], pa.binary()), centroids[mine], kept[mine]
        own = np.argmax(np.concatenate(list(vectors(texts, idf, params))) @ c.T, axis=1)
        c, texts = c[stays], texts.filter(pa.array(stays[own]))
        # N-grams of two texts at least: so a text is no witness of its own.
        grams, other = [], []
        for _ in _blocks(texts, params, None, other):
            grams.append(_merged(other)[0] & 0xFFFFFFFF)
        keys, times = np.unique(np.concatenate(grams), return_counts=True)
        seen = Seen(keys[times >= min(2, len(texts))])
        near = [(sims.max(axis=1), classes) for sims, classes in cosines(_pieces(texts), idf, c, seen, new, params)]
        floor = _floors(np.concatenate([n[0] for n in near]), np.concatenate([n[1] for n in near]), params)
        return pd.DataFrame({"lang": [frame["lang"].iloc[0]], "floor": [floor], "seen": [seen.keys.astype(np.int64)]})

    radius = sample.groupBy("lang").applyInPandas(measure, "lang string, floor array<float>, seen array<long>").toPandas().set_index("lang")
    seen = Seen(np.concatenate([np.zeros(0, np.int64), *(np.asarray(k, np.int64) for k in radius["seen"])]))
    floors = np.array([np.asarray(radius.loc[x, "floor"], np.float32) for x in languages[kept]], np.float32).reshape(-1, CLASSES)
    return Model(params, idf, centroids[kept], languages[kept].tolist(), floors, seen, new)


def genuine(centroids: np.ndarray, languages: np.ndarray, held: np.ndarray, params: Params) -> np.ndarray:
    """Which centroids stay. Rows of a language lie together, largest first."""
    kept = np.ones(len(centroids), dtype=bool)
    for language in dict.fromkeys(languages.tolist()):
        own = np.flatnonzero(languages == language)
        others = np.flatnonzero(languages != language)
        for i in own[1:]:
            mine = (centroids[own[own != i]] @ centroids[i]).max()
            larger = others[held[others] > held[i]]
            away = (centroids[larger] @ centroids[i]).max(initial=-1.0)
            kept[i] = held[i] >= params.least_texts and not (away >= params.twin and away > mine)
    return kept


def predict(df: DataFrame, model: Model, text_col: str = "text", lang_out: str = "lang_pred", score_out: str = "score",
            rejected_out: str = "rejected") -> DataFrame:
    """``df`` with the predicted language, its cosine (0 to 1) and whether the
    text is rejected. Only the text is read, the whole of it.

    A null text or one without a letter: ``und``, 0, rejected. Ties go to the
    language that sorts first. The names of the added columns must be free;
    rows, repeats and other columns stay as they are."""
    bc = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double, rejected boolean")
    def judge(texts: pd.Series) -> pd.DataFrame:
        m = bc.value
        names, scores, far = [], [], []
        if not m.languages:
            return pd.DataFrame({"lang": [None] * len(texts), "score": 0.0, "rejected": True})
        for sims, classes in cosines(pa.array(texts, pa.binary()), m.idf, m.centroids, m.seen, m.new, m.params):
            best = np.argmax(sims, axis=1)
            top = sims[np.arange(len(sims)), best]
            names += [m.languages[i] for i in best]
            scores += np.clip(top, 0, 1).astype(float).tolist()
            far += ((top <= 0) | (top < m.floor[best, classes])).tolist()
        return pd.DataFrame({"lang": names, "score": scores, "rejected": far})

    readable = F.col(text_col).rlike(r"\p{L}")
    got = F.when(readable, judge(_lowered(text_col)))
    return df.withColumn(lang_out, got).withColumns({
        lang_out: F.coalesce(F.col(lang_out)["lang"], F.lit(UNKNOWN)),
        score_out: F.coalesce(F.col(lang_out)["score"], F.lit(0.0)),
        rejected_out: F.coalesce(F.col(lang_out)["rejected"], F.lit(True)),
    })


def held_out(id_col: str = "doc_id"):
    """Rows kept from training: crc32 of the id as text leaves 1 by 3 (a null id trains)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit_on_training_rows(documents: DataFrame, params: Params = Params()) -> Model:
    return fit(documents.filter(~held_out()), params=params)
