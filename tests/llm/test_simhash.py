from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from deedlens.llm.components import connected_components
from deedlens.llm.simhash import close_forest, close_links, fingerprint, hexadecimal, near_duplicates, one_of_each


def plain_fingerprint(text):
    words = []
    for word in (text or "").translate({c: c + 32 for c in range(65, 91)}).split(" "):
        words += [w for w in __import__("re").findall(r"[^\x20\x09-\x0D]+", word)]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(pairs):
    """doc ids and fingerprints to the smallest id in reach, by comparing all pairs."""
    parent = list(range(len(pairs)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(pairs)):
        for j in range(i):
            if bin(pairs[i][1] ^ pairs[j][1]).count("1") <= 3:
                parent[max(root(i), root(j))] = min(root(i), root(j))
    least = {}
    for i, (doc, _) in enumerate(pairs):
        r = root(i)
        least[r] = min((x for x in (least.get(r), doc) if x is not None), default=None)
    return [least[root(i)] for i in range(len(pairs))]


@given(st.text(alphabet="aAb É\t\n  ſK", max_size=40))
@settings(max_examples=300, deadline=None)
def test_fingerprint(text):
    assert fingerprint(text.encode()) == plain_fingerprint(text)


def test_fingerprint_of_long_text():
    text = " ".join(random.Random(1).choice("abcdefgh") for _ in range(150_000))
    assert fingerprint(text.encode()) == plain_fingerprint(text)


def scattered(n, seed):
    """Values of which many lie within a few bits of each other."""
    rng = random.Random(seed)
    centres = [rng.getrandbits(64) for _ in range(max(1, n // 8))] + [0, 2**64 - 1]
    values = set()
    while len(values) < n:
        v = rng.choice(centres)
        for _ in range(rng.randrange(5)):
            v ^= 1 << rng.randrange(64)
        values.add(v)
    return sorted(values, key=lambda _: rng.random())


def groups_of(n, links):
    parent = list(range(n))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        parent[max(root(a), root(b))] = min(root(a), root(b))
    return [root(i) for i in range(n)]


@pytest.mark.parametrize("n", [1, 2, 300, 700])
def test_close_forest_against_all_pairs(n):
    values = scattered(n, n)
    left = np.array(values, np.uint64)
    links = [(i, j) for i in range(n) for j in range(i) if bin(values[i] ^ values[j]).count("1") <= 3]
    found = close_forest(left, left)
    assert groups_of(n, found) == groups_of(n, links) and len(found) < n
    half = n // 2
    if half:
        a, b = left[:half], left[half:]
        across = [(j, i) for i, j in links if i >= half > j]
        assert groups_of(n, close_forest(a, b)) == groups_of(n, across)


def test_tiles_lose_nothing(spark):
    values = scattered(600, 3)
    signed = np.array(values, np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(v,) for v in signed], "fp long")
    roots = {r["node"]: r["root"] for r in connected_components(close_links(df, tile=20)).collect()}
    expected = plain_components(list(zip(signed, values, strict=True)))
    assert [roots.get(v, v) for v in signed] == expected


def test_documents(spark):
    rng = random.Random(5)
    words = ["w%d" % i for i in range(50)]
    base = [" ".join(rng.choices(words, k=rng.randrange(1, 80))) for _ in range(40)]
    texts = [*base, *base[:10], *(t + " w1" for t in base[:20]), *(t.upper() for t in base[:5])]
    texts += [None, "", " \n\t", "one", "one two", "One\tTWO"]
    rows = [(i * 7 % 101, t, "x", 1) for i, t in enumerate(texts)]
    rows += [rows[0], (None, base[0], "x", 1), (None, "nothing like it at all here", None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string, component_id int")
    found = near_duplicates(df).select("doc_id", hexadecimal("fp").alias("fp"), "component_id").collect()
    prints = [(r[0], plain_fingerprint(r[1])) for r in rows]
    expected = sorted(
        (str(d), f"{fp:016x}", str(c)) for (d, fp), c in zip(prints, plain_components(prints), strict=True)
    )
    assert sorted((str(r[0]), r[1], str(r[2])) for r in found) == expected


def test_empty(spark):
    assert near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("shape", ["chain", "star", "random"])
def test_components(spark, shape):
    rng = random.Random(2)
    n = 400
    edges = {
        "chain": [(i, i + 1) for i in range(n)],
        "star": [(0, i) for i in range(1, n)],
        "random": [(rng.randrange(n), rng.randrange(n)) for _ in range(n // 2)],
    }[shape]
    edges = edges + edges[:5] + [(7, 7)]
    df = spark.createDataFrame(edges + [(None, 3), (3, None)], "a long, b long")
    found = {r["node"]: r["root"] for r in connected_components(df).collect()}
    expected = groups_of(n + 1, edges)
    touched = {x for a, b in edges if a != b for x in (a, b)}
    assert found == {x: expected[x] for x in touched}


def test_one_of_each(spark):
    text = "a text of some words that stands here more than once"
    rows = [(3, text, "b"), (2, text, "a"), (2, text, "a"), (2, text.upper(), "c"), (5, "quite another text of its own", None)]
    rows += [(None, "a third text without any id at all", "d"), (None, "a third text without any id at all", "d"), (9, None, "e"), (8, "", "f")]
    df = spark.createDataFrame(rows, "doc_id long, text string, row string")
    kept = one_of_each(df)
    assert kept.columns == df.columns
    found = sorted(map(tuple, kept.collect()), key=str)
    assert len(found) == 4 and (5, "quite another text of its own", None) in found and (8, "", "f") in found
    assert sum(r[0] == 2 for r in found) == 1 and sum(r[0] is None for r in found) == 1
    assert one_of_each(df.limit(0)).count() == 0
