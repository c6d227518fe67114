from __future__ import annotations

import re
from collections import Counter

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from deedlens.llm.simhash import fingerprint

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The result of every stage over the one before, the raw documents first."""
    home = tmp_path_factory.mktemp("stages")
    results = [spark.read.parquet(f"{SF_DIR}/documents.parquet")]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, results[-1], SF_DIR).write.parquet(str(home / str(i)))
        results.append(spark.read.parquet(str(home / str(i))))
    return results


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_registered():
    assert entry.queries()["pipeline"] is corpus_pipeline.run and corpus_pipeline.ORACLE_SQL is None


def test_columns(stages):
    for df in stages[:-1]:
        assert df.dtypes == stages[0].dtypes
    for df in stages[1:-1]:
        assert all(r.n_chars == len(r.text) for r in df.collect() if r.text is not None)


def test_quality_keeps_clean_documents(spark, stages):
    before, after = rows(stages[0]), rows(stages[1])
    assert set(after) < set(before) and all(after[i] == before[i] for i in after)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    good = [i for i, q in labels.items() if q == 1 and len((before[i].text or "").split()) >= 30]
    assert sum(i in after for i in good) >= 0.95 * len(good)


def test_line_dedup_keeps_rows_and_first_lines(stages):
    before, after = rows(stages[1]), rows(stages[2])
    assert set(before) == set(after)
    seen = Counter()
    for i in sorted(after):
        old, new = (d[i].text.split("\n") for d in (before, after))
        assert not Counter(x for x in new if x.strip()) - Counter(x for x in old if x.strip())
        seen.update(x.strip() for x in new if x.strip())
    assert seen and max(seen.values()) == 1


def test_near_dedup_leaves_one_of_each(stages):
    before, after = rows(stages[2]), rows(stages[3])
    prints = {i: fingerprint((r.text or "").encode()) for i, r in before.items()}
    parent = {i: i for i in prints}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(prints)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            if bin(prints[i] ^ prints[j]).count("1") <= 3:
                parent[max(root(i), root(j))] = min(root(i), root(j))
    assert set(after) == {root(i) for i in ids} and all(after[i] == before[i] for i in after)


def test_secrets_are_masked(stages):
    before, after = rows(stages[3]), rows(stages[4])
    pattern = re.compile(r'(token = ")[0-9a-f]{40}(")', re.I)
    assert set(before) == set(after)
    for i, r in before.items():
        assert after[i].text == pattern.sub(r"\1[SECRET]\2", r.text or "") or r.text is None


def test_packing_covers_every_document(stages):
    pieces = stages[5].collect()
    assert {r.doc_id for r in pieces} == set(rows(stages[4]))
    assert sum(r.length for r in pieces) == sum({r.doc_id: r.doc_tokens for r in pieces}.values())


def test_run(spark, stages):
    found = corpus_pipeline.run(spark, SF_DIR)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, stages[5].collect()))
