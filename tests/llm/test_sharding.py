from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import pytest

from deedlens.llm.sharding import interleaved_shards

SCHEMA = "doc_id long, text string, source string, shard string, bucket int"


def check(rows, found, shards):
    expected = Counter(
        (i, s, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, s, *_ in rows
    )
    assert Counter((r.doc_id, r.source, r.size, r.text_crc32) for r in found) == expected
    slots = defaultdict(list)
    for r in found:
        assert r.law == "rows" and r.grown_shard is None
        slots[r.shard].append(r.slot)
    counts = [len(slots[k]) for k in range(shards)]
    assert sum(counts) == len(rows) and max(counts) - min(counts) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    total, mixture = Counter(r.source for r in found), Counter((r.shard, r.source) for r in found)
    for k in range(shards):
        for source, n in total.items():
            assert abs(mixture[(k, source)] - n * counts[k] / len(rows)) < 2


@pytest.mark.parametrize("buckets", [1, 7, 1024])
def test_mixture_and_counts(spark, buckets):
    rows = [(i, f"text é {i}", "hot" if i % 3 == 0 else f"s{i % 7}", "x", i) for i in range(1000)]
    found = interleaved_shards(spark.createDataFrame(rows, SCHEMA), buckets=buckets).collect()
    check(rows, found, 24)


def test_same_shards_for_any_partitioning(spark):
    rows = [(i, f"t{i}", f"s{i % 5}", None, i) for i in range(300)]
    df = spark.createDataFrame(rows, SCHEMA)
    one = {tuple(r) for r in interleaved_shards(df.repartition(1)).collect()}
    assert one == {tuple(r) for r in interleaved_shards(df.repartition(13, "text")).collect()}
    assert one != {tuple(r) for r in interleaved_shards(df, seed=7).collect()}


def test_nulls_repeats_and_few_rows(spark):
    rows = [(None, None, None, None, None)] * 5 + [(1, "a", "s", "x", 1)] * 3 + [(2, "", None, "x", 1)]
    found = interleaved_shards(spark.createDataFrame(rows, SCHEMA)).collect()
    check(rows, found, 24)


def test_empty(spark):
    df = interleaved_shards(spark.createDataFrame([], SCHEMA))
    assert df.count() == 0 and df.columns[0] == "doc_id"


def test_no_python(spark):
    plan = interleaved_shards(spark.createDataFrame([(1, "a", "s", "x", 1)], SCHEMA))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text
