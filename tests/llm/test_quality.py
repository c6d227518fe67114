from __future__ import annotations

import re
from collections import Counter
from dataclasses import replace

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from deedlens.llm import quality, queries
from deedlens.llm.quality import IsolationForest, counts_of, fit, judge

SF_DIR = "/root/testdata/sf0.01"


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    seen = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(5)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(covered),
    )


@given(st.text(alphabet="ab \n\t\x0b#é中|\x85 ", max_size=120))
@settings(max_examples=500, deadline=None)
def test_counts(text):
    assert counts_of(text.encode())[:5] == plain(text)


def test_many_distinct_words():
    words = [f"w{i}" for i in range(70_000)]
    text = " ".join(words + words[:6] + words[-7:])
    assert counts_of(text.encode())[:5] == plain(text)


def test_forest_scores_outliers_higher():
    rng = np.random.default_rng(1)
    rows = np.concatenate([rng.normal(0, 1, (950, 3)), rng.normal(12, 0.1, (50, 3))])
    good = np.arange(1000) < 950
    forest = IsolationForest.fit(rows, good, trees=50, sample=256)
    forest.calibrate(rows, good)
    kept = forest.score(rows) <= forest.threshold
    assert (kept == good).all()
    assert (IsolationForest.fit(rows, good, trees=5).score(rows) == IsolationForest.fit(rows, good, trees=5).score(rows)).all()


@pytest.fixture(scope="module")
def whole(spark):
    found = queries.QUERIES["op3_quality_rules"](spark, SF_DIR).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    return found, texts


def test_query_against_plain_counts(whole):
    found, texts = whole
    assert Counter(r.doc_id for r in found) == Counter(texts.keys())
    for r in found:
        counts = plain(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts
        failed = counts[0] < 10 or 100 * counts[4] > 20 * counts[0]
        assert r.base_failed == failed and not (failed and r.kept)


def test_verdicts_agree_with_labels(spark, whole):
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    judged = [(r.kept, quality[r.doc_id]) for r in whole[0] if r.doc_id in quality and not r.base_failed]
    good, bad = ([k for k, q in judged if q == want] for want in (1, 0))
    assert np.mean(good) > 0.97 and np.mean(bad) < 0.1


def test_border_and_trees_come_from_all_labels(spark, monkeypatch):
    monkeypatch.setattr(quality, "SAMPLE", 50)
    monkeypatch.setattr(quality, "TREE_SAMPLE", 64)
    rng = np.random.default_rng(3)
    texts, marks = [], []
    for i in range(700):
        bad = i % 9 == 0
        words = ["".join(rng.choice(list("abcde"), rng.integers(2, 9))) for _ in range(40)]
        texts.append(" ".join(w + ("#$" if rng.random() < (0.12 if bad else 0.05) else "") for w in words))
        marks.append(int(not bad))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    forest = fit(df, spark.createDataFrame(list(enumerate(marks)), "doc_id long, quality int"))
    rows = np.array([counts_of(t.encode()) for t in texts])
    passes = (rows[:, 0] >= 10) & (100 * rows[:, 4] <= 20 * rows[:, 0])
    rows, good = quality.features(rows[passes]), np.array(marks)[passes] == 1
    assert len(rows) > 600
    plain_border = replace(forest)
    plain_border.calibrate(rows, good)
    assert forest.threshold == plain_border.threshold < 1.0
    drawn = [np.random.default_rng(42)]
    drawn = [drawn[0].choice(len(rows), 64, replace=False) for _ in range(quality.TREES)]
    same = IsolationForest.fit(rows, good, draws=drawn)
    # Paths end by the rows of a tree, not by those that reach the driver.
    assert (same.length == forest.length).all() and (same.border == forest.border).all()


def test_edges(spark):
    rows = [(None, None, 1), (1, "", 2), (1, "", 2), (2, " \n ", 3), (3, "word " * 40, 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept int")
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (3, None)], "doc_id long, quality int")
    for forest in (fit(df, labels), fit(df.limit(0), labels), fit(df, labels.limit(0))):
        judged = judge(df, forest)
        assert judged.columns == ["doc_id", "text", "kept", "quality"] and judged.count() == 5
        assert not any(r.quality.kept for r in judged.collect())
        assert judge(df.limit(0), forest).count() == 0
