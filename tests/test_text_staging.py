from __future__ import annotations

import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from deedlens.operators import staging, text

LEXICON = {"great": 0.75, "durable": 0.5, "needs": -0.5, "worst": -1.0}


def test_polarity(spark):
    data = [
        (1, "Great product, durable and reliable."),
        (2, "Average performance, needs improvement."),
        (3, "WORST!!worst\tgreat-great"),
        (4, "nothing to say"),
        (5, ""),
        (6, None),
    ]
    df = spark.createDataFrame(data, "id int, t string")
    found = rows(text.polarity(df, "t", LEXICON).select("id", "polarity"))
    assert found == [(1, 0.625), (2, -0.5), (3, -0.125), (4, 0.0), (5, 0.0), (6, None)]
    as_frame = spark.createDataFrame(list(LEXICON.items()), "word string, weight double")
    assert rows(text.polarity(df, "t", as_frame).select("id", "polarity")) == found
    # Repeated and missing keys: every row keeps its columns and its own score.
    many = spark.createDataFrame([(1, "great"), (1, "worst"), (None, "needs"), (None, "great")], "id int, t string")
    expected = [(1, "great", 0.75), (1, "worst", -1.0), (None, "great", 0.75), (None, "needs", -0.5)]
    assert rows(text.polarity(many, "t", LEXICON)) == rows(text.polarity(many, "t", as_frame)) == expected
    assert rows(text.polarity(many.limit(1), "t", {})) == [(1, "great", 0.0)]


def test_polarity_bounds_and_plan(spark):
    df = spark.createDataFrame([(1, "a")], "id int, t string")
    with pytest.raises(ValueError):
        text.polarity(df, "t", {"a": 2.0})
    plan = text.polarity(df, "t", LEXICON)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
    assert "Exchange" not in plan


def message(spark, numbers):
    data = [("C", n, "T", 1, 2, ("MBN", f"p{i}")) for i, n in enumerate(numbers)]
    return spark.createDataFrame(data, staging.MESSAGE_DDL)


def test_staging_routes_every_message(spark):
    numbers = ["7411224959", "765908711", "9876543210", None, "74112x4959", "", "974112249591"]
    day = datetime.date(2024, 2, 1)
    accepted, rejected = staging.stage_messages(message(spark, numbers), F.lit(day))
    assert rows(accepted) == [("p0", "7411224959", "12332346", "MBN")]
    assert accepted.columns == ["partyId", "phoneNumber", "broadcastId", "brand"]
    reasons = {r["partyId"]: r["reason"] for r in rejected.collect()}
    assert reasons == {
        "p1": "wrong length",
        "p2": "wrong start",
        "p3": "missing number",
        "p4": "not a number",
        "p5": "not a number",
        "p6": "wrong length",
    }
    assert {r["whenRejected"] for r in rejected.collect()} == {day}


def test_eligible(spark):
    ddl = "id int, block_code_1 string, block_code_2 string, pmt_ach_flag int, int_status string, due date"
    day = datetime.date(2024, 1, 9)
    data = [
        (1, "A", "C", 0, "A", day),
        (2, None, None, 0, "D", day),
        (3, "I", "C", 0, "A", day),
        (4, "A", "W", 0, "A", day),
        (5, "A", "C", 1, "A", day),
        (6, "A", "C", 0, "B", day),
        (7, "A", "C", 0, "A", datetime.date(2024, 1, 8)),
        (8, "A", "C", 0, "A", datetime.date(2024, 1, 10)),
        (9, "A", "C", None, "A", day),
    ]
    df = spark.createDataFrame(data, ddl)
    found = staging.eligible(df, F.to_date(F.lit("2024-01-10")))
    assert rows(found.select("id")) == [(1,), (2,)]


def test_eligible_date_reaches_the_scan(spark, tmp_path):
    ddl = "id int, block_code_1 string, block_code_2 string, pmt_ach_flag int, int_status string, due date"
    path = str(tmp_path / "accounts")
    spark.createDataFrame([], ddl).write.parquet(path)
    found = staging.eligible(spark.read.parquet(path), F.to_date(F.lit("2024-01-10")))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(due,2024-01-09)" in plan


def test_polarity_by_every_way(spark, monkeypatch):
    data = [(1, "Great x great, worst"), (2, "needs-needs ümläut ÜMLÄUT"), (3, ""), (4, None), (5, "none of them"), (6, "a.b great's")]
    df = spark.createDataFrame(data, "id int, `the text` string").withColumn("word", F.lit("great"))
    lexicon = {**LEXICON, "ümläut": 0.25, "a": -0.5, "b": 0.5, "s": 0.125, "not one": 1.0, "": 1.0, "Great": -1.0}
    by_pattern = rows(text.polarity(df, "the text", lexicon).select("id", "polarity"))
    expected = [(1, 0.5 / 3), (2, -0.125), (3, 0.0), (4, None), (5, 0.0), (6, 0.21875)]
    assert by_pattern == [(i, v if v is None else pytest.approx(v)) for i, v in expected]
    frame = spark.createDataFrame(list(lexicon.items()), "word string, weight double")
    many = frame.union(spark.range(500).selectExpr("concat('w', id)", "1.0D"))
    by_hash = rows(text.polarity(df, "the text", many).select("id", "polarity"))
    assert by_hash == by_pattern
    plan = text.polarity(df, "the text", many)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan and "Python" not in plan
    # Too large to send: cut to the words that occur, then sent.
    monkeypatch.setattr(text, "LEXICON_WORDS", 50)
    assert rows(text.polarity(df, "the text", many).select("id", "polarity")) == by_pattern
    # Too large even then: joined.
    monkeypatch.setattr(text, "LEXICON_WORDS", 2)
    assert rows(text.polarity(df, "the text", many).select("id", "polarity")) == by_pattern
    assert text.polarity(df, "the text", many).columns == [*df.columns, "polarity"]


def test_polarity_with_a_million_words(spark):
    df = spark.createDataFrame([(i, f"w{i} w{i + 1} zz great") for i in range(50)], "id int, t string")
    huge = spark.range(1_000_000).selectExpr("concat('w', id) AS word", "(id % 5) / 8.0D AS weight")
    found = rows(text.polarity(df, "t", huge).select("id", "polarity"))
    assert sorted(found) == [(i, ((i % 5) / 8 + ((i + 1) % 5) / 8) / 2) for i in range(50)]


def test_polarity_words_given_twice(spark):
    df = spark.createDataFrame([(1, "great worst"), (2, "great")], "id int, t string")
    twice = spark.createDataFrame([("great", 0.5), ("great", 1.0), ("worst", -1.0), (None, 1.0), ("great", None)], "word string, weight double")
    assert rows(text.polarity(df, "t", twice).select("id", "polarity")) == [(1, pytest.approx(0.5 / 3)), (2, 0.75)]
