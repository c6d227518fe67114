from __future__ import annotations

import itertools
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from deedlens.llm import language, queries

SF_DIR = "/root/testdata/sf0.01"

TEXTS = {
    "en": "the cat and the dog ran through the house with another thing",
    "de": "der hund und die katze liefen durch das haus mit einem anderen ding",
    "ru": "собака и кошка бежали через дом",
}


@pytest.fixture(scope="module")
def model():
    counts = [(lang, g, 20) for lang, text in TEXTS.items() for w in text.split() for g in language.trigrams(w)]
    return language.Model.of_counts(counts)


def best_path(model, scores):
    """The best labels by trying all of them."""
    n, k = scores.shape
    paths = itertools.product(range(k), repeat=n)
    value = {p: scores[range(n), p].sum() - model.penalty * sum(a != b for a, b in zip(p, p[1:], strict=False)) for p in paths}
    return max(value.values()), value


def test_viterbi_against_all_paths(model):
    rng = np.random.default_rng(3)
    for n in (1, 2, 5, 7):
        for scale in (1, 8, 30):
            scores = rng.normal(0, scale, (n, 3))
            best, value = best_path(model, scores)
            assert value[tuple(model.viterbi(scores).tolist())] == pytest.approx(best)


def test_viterbi_two_gains_for_one_change(model):
    scores = np.array([[0.0, -5.0, -1.0]] * 10 + [[-5.0, 0.0, -1.0]] * 10)
    assert model.viterbi(scores).tolist() == [0] * 10 + [1] * 10
    # The same in few rows, against all paths.
    scores = np.array([[0.0, -50 / 3, -10 / 3]] * 3 + [[-50 / 3, 0.0, -10 / 3]] * 3)
    best, value = best_path(model, scores)
    assert value[tuple(model.viterbi(scores).tolist())] == pytest.approx(best)


def test_spans(model):
    text = f"  {TEXTS['en']}\n{TEXTS['ru']} 12 {TEXTS['de']} "
    lang, score, spans = model.label(text)
    assert [s[2] for s in spans] == ["en", "ru", "de"]
    assert spans[0][0] == 0 and spans[-1][1] == len(text)
    assert all(a[1] == b[0] for a, b in zip(spans, spans[1:], strict=False))
    assert text[spans[1][0] :].startswith("собака") and lang == "de" and 0.3 < score < 0.5


def test_script_narrows(model):
    assert model.label("дом")[0] == "ru" and model.label("中文")[0] in model.languages
    scores = model.word_scores(["zzz", "中文", "дом"])
    assert scores[0][model.languages.index("ru")] < scores[0].max() - model.penalty
    assert not scores[1].any() and scores[2].argmax() == model.languages.index("ru")


def test_no_letters_and_no_languages(model):
    for text in ("", " \n", "12 34 !", "_"):
        assert model.label(text) == ("und", 0.0, [])
    assert language.Model.of_counts([]).label("word") == ("und", 0.0, [])


def test_cache_changes_nothing(model, monkeypatch):
    rng = random.Random(1)
    words = [w for t in TEXTS.values() for w in t.split()] + ["x" * 100, "y" * 70]
    mixed = [" ".join(rng.choices(words, k=30)) for _ in range(50)]
    expected = [model.label(t) for t in mixed]
    monkeypatch.setattr(language, "CACHED", 5)
    monkeypatch.setattr(language, "TOGETHER", 3)
    assert list(model.label_all(mixed)) == expected
    monkeypatch.setattr(language, "LONG", 1)
    assert [model.label(t) for t in mixed] == expected


def test_query_held_out_accuracy(spark):
    found = queries.QUERIES["op6_language"](spark, SF_DIR).collect()
    documents = {r.doc_id: r for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    assert len(found) == len(documents)
    right = []
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1
        document = documents[r.doc_id]
        letters = any(c.isalpha() for c in document.text or "")
        assert (r.lang_pred == "und") == (not letters)
        if r.held_out and letters:
            right.append(r.lang_pred == document.lang)
    assert np.mean(right) > 0.97


def test_edges(spark):
    rows = [(1, t, lang, 1.0) for lang, t in TEXTS.items()] + [(None, None, "en", 1.0), (2, "", None, 1.0), (2, "", None, 1.0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double")
    model = language.fit(df)
    found = df.select("lang", language.identify(F.col("text"), model, spark).alias("f")).collect()
    assert [r.f.lang for r in found] == ["en", "de", "ru", "und", "und", "und"]
    assert language.fit(df.limit(0)).languages == []
    assert df.limit(0).select(language.identify(F.col("text"), model, spark)).count() == 0
