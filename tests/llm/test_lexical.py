from __future__ import annotations

import math
import random
import re
from collections import Counter

import oracle
import pytest
from conftest import rows

from deedlens.llm import lexical, queries

SF_DIR = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEMS = "item_id long, text string"
DOCS = "doc_id long, text string"
UPPER = {c: c + 32 for c in range(65, 91)}


def plain_terms(text):
    return TERM.findall((text or "").translate(UPPER))


def brute(items, docs, k=20):
    """The contract, pair by pair."""
    texts = [(d, plain_terms(t)) for d, t in docs]
    texts = [(d, t) for d, t in texts if t]
    n_docs, total = len(texts), sum(len(t) for _, t in texts)
    frequency = Counter(term for _, t in texts for term in set(t))
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, []).extend(plain_terms(text))
    out = []
    for item, terms in wanted.items():
        scored = []
        for d, t in texts:
            tf, score = Counter(t), 0
            m = 100 - 25 + 25 * len(t) * n_docs // total
            for term in terms:
                if tf[term]:
                    w = math.floor(1000 * math.log((2.0 * n_docs + 2) / (2 * frequency[term] + 1)))
                    score += w * (10**9 * tf[term] // (1000 * tf[term] + 12 * m))
            if score > 0:
                scored.append((-score, d is not None, d))
        out += [(item, r + 1, s[2], -s[0]) for r, s in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def found(spark, items, docs, **more):
    result = lexical.search(spark.createDataFrame(items, ITEMS), spark.createDataFrame(docs, DOCS), **more)
    assert [f.simpleString() for f in result.schema] == ["item_id:bigint", "rank:int", "doc_id:bigint", "score:bigint"]
    return sorted((tuple(r) for r in result.collect()), key=str)


def random_text(rng):
    words = ["The", "the", "CAT", "naïve", "NAÏVE", "été", "x1", "1x", "a", "b", "日本", "ſ", "K", " ", "é"]
    marks = [" ", "\n", "-", "_", "'", "!", "\x00", "\x7f", "  ", "[", "`"]
    return "".join(rng.choice(words) + rng.choice(marks) for _ in range(rng.randrange(0, 30)))


def test_random_texts(spark):
    rng = random.Random(5)
    docs = [(i, random_text(rng)) for i in range(120)]
    items = [(i, random_text(rng)) for i in range(15)]
    assert found(spark, items, docs) == brute(items, docs)
    # Blocks of few item terms and a small k.
    assert found(spark, items[:6], docs, k=3, block=30) == brute(items[:6], docs, 3)


def test_edges(spark):
    docs = [(1, "cat dog"), (1, "cat dog"), (2, "cat dog"), (None, "cat dog"), (3, None), (4, ""), (5, " \n!"), (6, "bird"), (7, "bird")]
    items = [(10, "cat"), (10, "Cat"), (None, "dog cat"), (11, None), (12, ""), (13, "fish"), (14, "cat cat")]
    expected = brute(items, docs)
    assert found(spark, items, docs) == expected
    best = [r for r in expected if r[0] == 14]
    assert [r[2] for r in best] == [None, 1, 1, 2]
    assert found(spark, items, docs, k=1) == brute(items, docs, 1)


def test_empty_tables(spark):
    assert found(spark, [], [(1, "cat")]) == []
    assert found(spark, [(1, "cat")], []) == []
    assert found(spark, [(1, "cat")], [(1, None)]) == []


def test_other_columns(spark):
    names = "doc_id long, text string, item_id long, rank int, score long, term string, part int, block int, times int"
    docs = spark.createDataFrame([(i, f"cat {i}", 7, 7, 7, "x", 7, 7, 7) for i in range(30)], names)
    items = spark.createDataFrame([(1, "cat 3", 7, 7, 7, "x", 7, 7, 7)], names.replace("item_id", "other").replace("doc_id", "item_id"))
    got = sorted((tuple(r) for r in lexical.search(items, docs).collect()), key=str)
    assert got == brute([(1, "cat 3")], [(i, f"cat {i}") for i in range(30)])


def test_long_text(spark, monkeypatch):
    text = "cat " * 700_000 + "z" * 3_000_000 + " dog"
    docs = [(1, text), (2, "dog"), (3, "z" * 3_000_000)]
    items = [(1, "cat dog"), (2, "z" * 3_000_000)]
    assert found(spark, items, docs) == brute(items, docs)
    # Pieces that are cut amid a text lose no term and make none.
    monkeypatch.setattr(lexical, "PIECE", 7)
    block = lexical.Block.of([(1, b"cat", 1), (1, b"at", 1), (1, b"dogdogdogdog", 1)])
    n, counts = block.counts(b"cat cat, a cat at dogdogdogdog cat" * 3)
    words = (b"cat cat, a cat at dogdogdogdog cat" * 3).replace(b",", b"").split()
    assert n == len(words)
    assert counts == Counter({0: words.count(b"at"), 1: words.count(b"cat"), 2: words.count(b"dogdogdogdog")})


def test_many_documents_per_item_cut_in_tasks(spark, monkeypatch):
    monkeypatch.setattr(lexical, "_AT_ONCE", 50)
    rng = random.Random(9)
    docs = [(i % 400, " ".join(rng.choice("abcd") for _ in range(rng.randrange(1, 6)))) for i in range(500)]
    items = [(i, c) for i, c in enumerate("abcd")]
    best = lexical._Best(4, 20)
    best.most = 90
    block = lexical.Block.of([(i, c.encode(), 1) for i, c in items])
    block.documents, block.terms, block.weight = 500, 1500, lexical.np.array([5, 6, 7, 8])
    every = []
    for d, t in docs:
        n, counts = block.counts(t.encode())
        scores = block.scores([n], [counts])
        best.add([d], scores)
        every += [(i, -int(s), d) for i, s in enumerate(scores[0]) if s > 0]
    best.cut()
    expected = [r for i in range(4) for r in sorted(e for e in every if e[0] == i)[:20]]
    assert [(a, b, d) for a, b, _, d in best.kept.tolist()] == expected
    assert found(spark, items, docs) == brute(items, docs)


def test_query_equals_sql(spark):
    result = queries.QUERIES["op11_lexical"](spark, SF_DIR)
    db = oracle.connect(SF_DIR)
    sql = queries.SQL["op11_lexical"]
    assert oracle.spark_types(result) == oracle.duck_types(db, sql)
    assert oracle.spark_rows(result) == oracle.duck_rows(db, sql)


@pytest.mark.parametrize("byte", range(256))
def test_fold(byte):
    if byte < 128:
        assert bool(lexical.terms(bytes([byte]))) == bool(TERM.fullmatch(chr(byte)))
    else:
        assert lexical.terms(bytes([byte])) == [bytes([byte])]


def test_rows_helper_is_stable(spark):
    a, b = (rows(queries.QUERIES["op11_lexical"](spark, SF_DIR)) for _ in range(2))
    assert a == b
