from __future__ import annotations

import pytest
from conftest import rows

from deedlens.operators import label

COLUMNS = "id int, PricePaid int, ProprietorName1 string, ProprietorName2 string, Proprietor1Address1 string, CountryIncorporated1 string"


def test_rule_chain(spark):
    data = [
        (1, 2_000_000, "a", "b", "c", "UK"),
        (2, 1_000_000, "a", "b", "c", "UK"),
        (3, 10, None, "b", "c", "UK"),
        (4, 10, "a", None, "c", "UK"),
        (5, 10, "a", "b", None, "UK"),
        (6, 10, "a", "b", "c", "JERSEY"),
        (7, None, "a", "b", "c", None),
        (8, 2_000_000, None, "b", "c", "JERSEY"),
    ]
    labelled = label.label_ownership(spark.createDataFrame(data, COLUMNS))
    found = {r["id"]: (r["is_fraud"], r["rule_id"], r["missing_proprietor_name"]) for r in labelled.collect()}
    assert found == {
        1: (1, "high_price", 0),
        2: (0, None, 0),
        3: (1, "missing_proprietor", 1),
        4: (1, "missing_proprietor", 1),
        5: (1, "missing_proprietor", 0),
        6: (1, "foreign_company", 0),
        7: (0, None, 0),
        8: (1, "high_price", 1),
    }
    flagged, rest = label.class_split(labelled)
    assert (flagged.count(), rest.count()) == (6, 2)


def test_threshold_takes_null_as_not_below(spark):
    df = spark.createDataFrame([(5.0,), (10.0,), (None,)], "x double")
    assert [r["is_fraud"] for r in label.threshold_label(df, "x", 10, below=0).collect()] == [0, 1, 1]
    assert [r["y"] for r in label.threshold_label(df, "x", 10, below=1, out="y").collect()] == [1, 0, 0]
    with pytest.raises(ValueError):
        label.threshold_label(df, "x", 10, below=2)


def test_bool_label(spark):
    df = spark.createDataFrame([(True,), (False,), (None,)], "b boolean")
    assert [r["n"] for r in label.bool_label(df, "b", "n").collect()] == [1, 0, 0]


def test_empty(spark):
    assert rows(label.label_ownership(spark.createDataFrame([], COLUMNS))) == []
