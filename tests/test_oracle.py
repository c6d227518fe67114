"""Every registered query against its SQL, on whole tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
import oracle
from deedlens import registry

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES = entry.queries()
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    assert oracle.spark_types(df) == oracle.duck_types(duck, SQL[name])
    columns, found = oracle.spark_rows(df)
    wanted_columns, wanted = oracle.duck_rows(duck, SQL[name])
    assert columns == wanted_columns
    assert found == wanted
    plan = df._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython"):
        assert unwanted not in plan


def test_sql_only_for_registered_queries():
    assert set(SQL) <= set(QUERIES)
    assert set(registry.QUERIES) - set(SQL) == {"q_latent_people", "q_latent_synthetic"}


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["country", "n_rows", "total"]
    assert 0 < df.count() <= 15


@pytest.mark.parametrize("name", ["q_latent_synthetic", "q_latent_people"])
def test_latent_histograms(spark, name):
    counts = {}
    for r in QUERIES[name](spark, SF_DIR).collect():
        key = (r["column"], r["source"])
        counts[key] = counts.get(key, 0) + r["n"]
    # Every row is drawn once, with a value in every column.
    assert len({n for (_, source), n in counts.items() if source == "synthetic"}) == 1
    for (column, source), n in counts.items():
        assert n <= counts[(column, "synthetic")]
