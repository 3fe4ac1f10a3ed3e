import tracemalloc
import zlib

import numpy as np
import pytest

from lanemesh.llm import language

DATA = "/root/testdata/sf0.01/documents.parquet"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(DATA)
    rows = language.identified(docs).collect()
    lang = {r.doc_id: r.lang for r in docs.collect()}
    assert len(rows) == len(lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


@pytest.fixture(scope="module")
def model():
    a, b = "the quick brown fox and this thing over there with that", "der schnelle braune fuchs und dieses ding dort mit jenem"
    return language.train([a] * 30 + [b] * 30, ["en"] * 30 + ["de"] * 30)


def test_edge_cases(spark, model):
    docs = [(1, None), (2, ""), (3, "123 ### !"), (4, "the fox"), (5, "und dieses"), (6, "the thing " * 5000 + "und " * 3), (6, "the fox"), (None, "the fox"), (7, "Ω")]
    df = spark.createDataFrame([(i, t, "x", "und") for i, t in docs], "doc_id long, text string, score string, lang string")
    got = [(r.doc_id, r.lang_pred) for r in language.identified(df, model).collect()]
    assert got[:6] == [(1, "und"), (2, "und"), (3, "und"), (4, "en"), (5, "de"), (6, "en")]
    assert all(x in ("en", "de") for _, x in got[6:])
    assert language.identified(df.limit(0)).count() == 0


def test_words_of_code_switched_text(model):
    got = dict(language.label_words(model, "the quick brown fox und dieses ding dort"))
    assert got["quick"] == got["fox"] == "en" and got["dieses"] == got["dort"] == "de"


def test_blocks_equal_plain_forward_backward(monkeypatch):
    rng = np.random.default_rng(0)
    counts = np.array([0, 5, 1, 40, 0, 17])
    scores, moves = rng.standard_normal((counts.sum(), 3)).astype(np.float32), rng.standard_normal((3, 3))
    monkeypatch.setattr(language, "BLOCK_WORDS", 4)
    got = language.posteriors(scores, counts, moves, each=True)
    sums = language.posteriors(scores, counts, moves)
    at = 0
    for k, n in enumerate(counts):
        if n:
            p, _ = language.lane_gradients(np.exp(scores[None, at : at + n].astype(float)), np.exp(moves))
            assert np.allclose(got[at : at + n], p[0])
            assert np.allclose(sums[k], p[0].sum(0))
        at += n


def skewed():
    """A frequent language of long texts, a rare one, and one of texts that are each over all words allowed."""
    rows = [(i, "the quick brown fox and this thing " * 60, "en") for i in range(2000)]
    rows += [(5000 + i, "der schnelle braune fuchs und dieses ding", "de") for i in range(12)]
    return rows + [(6000 + i, "le renard brun et cette chose " * 60_000, "fr") for i in (3, 4, 5)]


@pytest.mark.parametrize("most", [3000, 300_000])
def test_rare_languages_are_learned(spark, most):
    docs = spark.createDataFrame(skewed(), "doc_id long, text string, lang string")
    model = language.learned(docs, most_words=most)
    assert model.labels == ["de", "en", "fr"]
    assert language.predict(model, ["dieses ding", "this thing", "cette chose"])[0] == ["de", "en", "fr"]


def test_words_are_shared_by_languages_and_texts():
    found = [(0, "a", "x " * 1000), (1, "b", "y z"), (2, "a", "x " * 3), (3, "c", "z " * 50), (4, "a", "x " * 70), (5, "c", "z " * 10)]
    counts = lambda most: [(lang, len(text.split())) for _, lang, text in language.shared(found, most)]
    assert counts(120) == [("a", 28), ("b", 2), ("a", 3), ("c", 49), ("a", 28), ("c", 10)]
    assert language.shared(found, 10_000) == found and language.shared([], 10) == []


def test_training_holds_a_part_of_its_words_at_a_time():
    rng = np.random.default_rng(3)
    texts, langs = [], []
    for lang in ("aa", "bb", "cc", "dd"):
        words = ["".join(x) for x in rng.choice(list("abcdefghijkl"), (2000, 6))]
        texts += [" ".join(rng.choice(words, 50_000))]
        langs += [lang]
    tracemalloc.start()
    try:
        model = language.train(texts, langs, rounds=1)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert model.labels == ["aa", "bb", "cc", "dd"] and most < 130e6


def test_parts_change_no_weights(monkeypatch):
    texts = ["der Hund und die Katze sind im Haus " * 40, "the dog and the cat are in the house " * 40, "le chien et le chat sont dans la maison " * 40]
    whole = language.train(texts, ["de", "en", "fr"], rounds=5)
    monkeypatch.setattr(language, "PART_LANES", 1)
    parts = language.train(texts, ["de", "en", "fr"], rounds=5)
    for name in ("grams", "affixes", "lexicon", "moves"):
        assert np.abs(getattr(whole, name)).max() > 0.1
        assert np.allclose(getattr(whole, name), getattr(parts, name), atol=1e-5)
