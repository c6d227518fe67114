from __future__ import annotations

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from deedlens.llm import queries, secrets

SF_DIR = "/root/testdata/sf0.01"
HEX = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"


@pytest.fixture(scope="module")
def model(spark):
    return secrets.fit(spark.read.parquet(f"{SF_DIR}/documents.parquet"))


def verdicts(model, text):
    return {text[s:e]: p >= secrets.THRESHOLD for s, e, p in model.findings(text)}


def test_spans():
    text = f'see ...aaaa1111bbbb2222. and key="{HEX}"; short1234 abcdefghijklmnopq ABCDEFGHIJKLMNOPQRSTU QUJDREVGR0hJSktMTU4=='
    found = [text[s:e] for s, e in secrets.spans(text)]
    assert found == ["aaaa1111bbbb2222", HEX, "ABCDEFGHIJKLMNOPQRSTU", "QUJDREVGR0hJSktMTU4=="]


def test_spans_of_context():
    def found(text):
        return [text[s:e] for s, e in secrets.spans(text)]

    assert found('password = "Tr0ub4dor" pwd: hunter2x, api_key=a!b@c#d$e%f:g.') == ["Tr0ub4dor", "hunter2x", "a!b@c#d$e%f:g"]
    assert found("Password: abcdefghijklmnop\nmy secret => 'two words' end") == ["abcdefghijklmnop", "two words"]
    assert found("password: abcd efgh ijkl mnop next") == ["abcd efgh ijkl mnop"]
    assert found('{"db_password": "p", "user": "bob"} Authorization: Bearer ab12') == ["p", "ab12"]
    assert found("go postgres://bob:p@ss/w0rd!@db.example.com:5432/x") == ["p@ss/w0rd!"]
    assert found('secret_url = "redis://:x1@h/0"')[1] == "x1"
    assert found(f"token={HEX} and token: {{password:abc1}}") == [HEX, "abc1"]
    assert found("a token and the password of http://localhost:80/x, password: ") == []
    assert found(f"{HEX}/token=abc") == [HEX + "/", "abc"]


def test_spans_take_linear_time():
    for text in ("token" * 60_000, "password=" * 30_000, "://a:" * 60_000, "=:" * 150_000, 'pwd="' * 50_000, "token " + " " * 300_000):
        spans = secrets.spans(text)
        assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:], strict=False))


def test_short_secrets_are_judged(model):
    for value in ("Tr0ub4dor", "hunter2x", "qzvkwjxhtpbrmfgd", "aB3!x@9#k$L%2:q"):
        for text in (f'my password = "{value}" here', f"the pwd: {value}\nand more", f"see https://bob:{value}@example.com/a now"):
            assert verdicts(model, text).get(value), text
    assert not any(verdicts(model, "password: required\nmax_tokens = 4096 token: none, secret: ${SECRET} ").values())


def test_forest_learns_a_rule():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(800, 6))
    y = ((x[:, 0] > 0) & (x[:, 3] < 0.5)).astype(float)
    forest = secrets.Forest.fit(x[:400], y[:400], trees=30)
    assert np.mean((forest.score(x[400:]) >= 0.5) == (y[400:] == 1)) > 0.93
    assert (secrets.Forest.fit(x, np.zeros(800)).score(x) == 0).all()


def test_held_out_made_up_findings(model):
    rows = secrets.made_up_findings(model.words.words, n=600, seed=7)
    x = np.array([secrets.features_of(t, s, e, model.words) for t, s, e, _ in rows])
    assert np.mean((model.forest.score(x) >= 0.5) == np.array([k == 1 for *_, k in rows])) > 0.93


def test_findings_in_context(model):
    assert verdicts(model, f'The with token = "{HEX}" of and.') == {HEX: True}
    assert verdicts(model, "mail to 92@mail6.example.com.or.so today") == {"mail6.example.com.or.so": False}
    assert verdicts(model, "the number 4785380592391139 of the") == {"4785380592391139": False}
    assert not any(verdicts(model, "see https://www.example.org/some/long/path/of/words for more").values())


def test_query_finds_every_planted_token(spark):
    found = {(r.doc_id, r.start): r for r in queries.QUERIES["op2_secret_scan"](spark, SF_DIR).collect()}
    planted = 0
    for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect():
        for m in re.finditer(r'token = "([0-9a-f]{40})"', r.text or "", re.I):
            row = found[r.doc_id, m.start(1)]
            planted += 1
            assert row.is_secret and row.length == 40
            assert row.value_sha256 == hashlib.sha256(m[1].encode()).hexdigest()
    secret = [r for r in found.values() if r.is_secret]
    assert planted and len(secret) <= 1.02 * planted


def test_words_of_all_documents(spark):
    # More documents and words than any sample: a small source's word is among them, and every letter pair counts.
    names = ["".join(chr(97 + i // 26**k % 26) for k in range(4)) for i in range(7_000)]
    rows = [(i, " ".join(names[(3 * i + j) % 7_000] for j in range(6))) for i in range(3_500)]
    rows += [(10_000 + i, "Zebrafish, zebrafish; rare" + "qxj" * i) for i in range(2)] + [(None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    words = secrets.fit_words(df)
    counts = {}
    for _, text in rows:
        for w in re.findall(r"[a-z]+", (text or "").lower()):
            counts[w] = counts.get(w, 0) + 1
    assert words.words == sorted(w for w, n in counts.items() if n >= secrets.LEAST and len(w) >= 3)
    assert "zebrafish" in words.words and "rareqxj" not in words.words
    pairs = {}
    for w, n in counts.items():
        for a, b in zip(w, w[1:], strict=False):
            pairs[a + b] = pairs.get(a + b, 0) + n
    assert words.transitions == secrets.Words.of_counts(pairs, []).transitions


def test_redact_and_edges(spark, model):
    text = f'a token = "{HEX}", twice "{HEX}" b'
    rows = [(1, text, "x"), (2, None, "x"), (None, "", None), (3, "plain words only", "x"), (3, "plain words only", "x"), (4, "x" * 300_000, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, value string")
    found = [r[0] for r in df.select(secrets.redact(F.col("text"), model, spark)).collect()]
    assert found[0].startswith('a token = "[SECRET]", twice') and found[1:4] == [None, "", "plain words only"]
    assert [len(r[0]) for r in df.select(secrets.scan(F.col("text"), model, spark)).collect()][1:5] == [0, 0, 0, 0]
    empty = secrets.fit(df.limit(0))
    assert verdicts(empty, f'token = "{HEX}"') == {HEX: True}
    assert df.limit(0).select(secrets.scan(F.col("text"), empty, spark)).count() == 0
