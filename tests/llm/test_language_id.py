import zlib

import numpy as np
import pytest

from conftest import SCHEMA, clashing
from sigspark.llm import language_id as li
from sigspark.llm.queries import op10_language_id

SAMPLES = {"en": "the quick brown fox and the lazy dog were running through the green fields of the old town ",
           "de": "der schnelle braune fuchs und der faule hund liefen durch die grünen felder der alten stadt ",
           "fr": "le renard brun rapide et le chien paresseux couraient à travers les champs verts de la vieille ville "}


@pytest.fixture(scope="module")
def model(spark):
    rows = []
    for i in range(60):
        for j, (lang, text) in enumerate(SAMPLES.items()):
            words = text.split()
            rows.append((3 * i + j, " ".join(words[(i + k) % len(words)] for k in range(5 + i % 10)), lang, "s", 1))
    rows += [(1000, None, "en", "s", 1), (1001, "1234 !!", "en", "s", 1), (1002, "no language", None, "s", 1)]
    return li.fit(spark.createDataFrame(rows, SCHEMA))


def test_predictions(spark, model):
    rows = [(i, t.upper(), None, None, 1) for i, t in enumerate(SAMPLES.values())]
    rows += [(10, None, "en", "s", 1), (11, "", "en", "s", 0), (12, "123 456 !?", "en", "s", 9), (13, "the fox " * 200_000, "de", "s", 1),
             (13, "the fox", "de", "s", 1), (None, "the lazy dog", None, None, None), (14, "これは日本語の文章です", None, None, None)]
    got = li.predict(clashing(spark.createDataFrame(rows, SCHEMA)).drop("lang_pred", "score", "rejected"), model).collect()
    assert len(got) == len(rows)
    by = {(r.doc_id, r.text): r for r in got}
    for (i, t, *_), lang in zip(rows, SAMPLES):
        assert by[i, t].lang_pred == lang and not by[i, t].rejected
    for t in (None, "", "123 456 !?"):
        r = next(r for r in got if r.text == t and r.doc_id in (10, 11, 12))
        assert (r.lang_pred, r.score, r.rejected) == ("und", 0.0, True)
    assert by[None, "the lazy dog"].lang_pred == "en"
    assert by[14, rows[-1][1]].rejected  # far from every language
    assert all(0 <= r.score <= 1 for r in got)


POLISH = "wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw są oni obdarzeni rozumem i sumieniem "


def strange(spark, model):
    rng = np.random.default_rng(5)
    texts = {}
    for name, lo, hi in (("kana", 0x3041, 0x3096), ("cyrillic", 0x430, 0x44F), ("hangul", 0xAC00, 0xD7A3), ("greek", 0x3B1, 0x3C9)):
        for n in (40, 400, 2000, 50_000):
            texts[name, n] = "".join(" " if x < 0.15 else chr(c) for x, c in zip(rng.random(n), rng.integers(lo, hi + 1, n)))
    texts |= {("polish", n): POLISH * n for n in (1, 4, 500)}
    got = li.predict(spark.createDataFrame(list(texts.values()), "string").toDF("text"), model).collect()
    return {k: next(r.rejected for r in got if r.text == t) for k, t in texts.items()}


def test_unknown_scripts_and_languages_are_rejected(spark, model):
    assert all(strange(spark, model).values())


def test_unknown_is_rejected_by_the_model_of_the_test_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = li.fit_on_training_rows(docs)
    assert all(strange(spark, model).values())
    # Words of known languages stay, also alone or repeated.
    known = {w for r in docs.filter("lang = 'en'").select("text").limit(50).collect() for w in r.text.split() if w in ("the", "that", "with", "from", "this")}
    rows = [(w,) for w in known] + [(" ".join([w] * 500),) for w in known]
    assert rows and not any(r.rejected for r in li.predict(spark.createDataFrame(rows, "text string"), model).collect())


def test_one_outlier_does_not_set_the_radius(spark):
    rows = [(i, " ".join(SAMPLES["en"].split()[(i + k) % 18] for k in range(12)), "en", "s", 1) for i in range(80)]
    outlier = (999, "ж", "en", "s", 1)
    plain, mixed = (li.fit(spark.createDataFrame(r, SCHEMA)) for r in (rows, [*rows, outlier]))
    assert mixed.floor.max() > 0.5 * plain.floor.max() > 0.1


def _said(lang, n, seed, words=None):
    rng = np.random.default_rng(seed)
    words = words or SAMPLES[lang].split()
    return [" ".join(rng.choice(words, rng.integers(6, 20))) for _ in range(n)]


def _fit(spark, texts):
    return li.fit(spark.createDataFrame([(i, t, lang, "s", 1) for i, (t, lang) in enumerate(texts)], SCHEMA))


def _guess(spark, model, texts):
    return li.predict(spark.createDataFrame([(t,) for t in texts], "text string"), model).collect()


def test_more_languages_than_a_few_hundred_are_all_learned(spark):
    rng = np.random.default_rng(8)
    letters = [chr(c) for c in [*range(97, 123), *range(0x430, 0x450), *range(0x3B1, 0x3CA)]]
    own = {f"l{i:03}": ["".join(rng.choice(letters, 6)) for _ in range(6)] for i in range(230)}
    model = _fit(spark, [(" ".join(rng.permutation(w)), lang) for lang, w in own.items() for _ in range(3)])
    assert set(model.languages) == set(own)
    assert [r.lang_pred for r in _guess(spark, model, [" ".join(w) for w in own.values()])] == list(own)


@pytest.mark.parametrize("copied", [SAMPLES["fr"], SAMPLES["fr"] + "deux", "il " + SAMPLES["fr"]])
def test_copies_of_one_text_do_not_lose_a_language(spark, copied):
    model = _fit(spark, [(t, "en") for t in _said("en", 700, 1)] + [(copied, "fr")] * 3000)
    assert set(model.languages) == {"en", "fr"}
    assert all((r.lang_pred, r.rejected) == ("fr", False) for r in _guess(spark, model, [copied, "le renard brun et le chien"]))


def test_a_small_second_script_stays_and_mislabelled_rows_go(spark):
    latin = "brza smeđa lisica i lenji pas trčali su kroz zelena polja starog grada pored reke".split()
    cyrillic = "брза смеђа лисица и лењи пас трчали су кроз зелена поља старог града поред реке".split()
    texts = [(t, "en") for t in _said("en", 500, 2)] + [(t, "sr") for t in _said("", 460, 3, latin) + _said("", 25, 4, cyrillic)]
    texts += [(t, "sr") for t in _said("en", 15, 5)]  # mislabelled
    model = _fit(spark, texts)
    assert all((r.lang_pred, r.rejected) == ("sr", False) for r in _guess(spark, model, _said("", 20, 6, cyrillic) + _said("", 20, 7, latin)))
    assert all(r.lang_pred == "en" for r in _guess(spark, model, _said("en", 20, 8)))


def test_seen_is_exact():
    keys = np.unique(np.random.default_rng(1).integers(1, li._BASE ** 4, 5000)).astype(np.uint32)
    seen = li.Seen(keys[::2])
    assert seen.test(keys).tolist() == [i % 2 == 0 for i in range(len(keys))]


def test_several_centroids_of_unit_length(model):
    assert np.allclose(np.linalg.norm(model.centroids, axis=1), 1, atol=1e-4)
    assert max(model.languages.count(x) for x in SAMPLES) > 1


def test_empty_training_table(spark, no_docs, edge_docs):
    empty = li.fit(no_docs)
    got = li.predict(edge_docs, empty).collect()
    assert len(got) == edge_docs.count() and all(r.rejected and r.lang_pred == "und" for r in got)
    assert li.predict(no_docs, li.fit(edge_docs)).count() == 0


def test_counts_do_not_cross_texts():
    p = li.Params(dims=1 << 10)
    texts = [b"abc def", b"", b"x1y", "é".encode()]
    raw, at = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    together = li.counts(raw, at, p)
    for i, t in enumerate(texts):
        assert np.array_equal(together[i], li.counts(np.frombuffer(t, np.uint8), np.array([0, len(t)]), p)[0])
    assert not together[1].any()


def test_long_texts_in_pieces(monkeypatch):
    p = li.Params(dims=1 << 10)
    raw = np.frombuffer(("der schnelle  braune 12 fuchs " * 50 + "x" * 300 + " é,, ende").encode(), np.uint8)
    monkeypatch.setattr(li, "STEP_BYTES", 400)
    assert np.array_equal(li.long_counts(raw, p), li.counts(raw, np.array([0, len(raw)]), p))


def test_held_out_accuracy(spark, sf_dir):
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = op10_language_id(spark, sf_dir).collect()
    assert len(got) == len(langs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == langs[r.doc_id] for r in held) >= 0.95 * len(held)
    again = {r.doc_id: r.score for r in op10_language_id(spark, sf_dir).collect()}
    assert all(abs(again[r.doc_id] - r.score) < 1e-6 for r in got)
