from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import oracle
from pyspark.sql import functions as F

from deedlens.llm import queries, trie

SF_DIR = "/root/testdata/sf0.01"
TURNS = "conv_id long, turn long, role string, text string"
NAMES = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()


def sequences(rows):
    """Conversations as tuples of (role, text); ties of a turn by the digest, as documented."""

    def key(row):
        _, turn, role, text = row
        r, t = (role or ""), (text or "")
        return (turn is not None, turn or 0, hashlib.sha256(f"{len(r.encode())}:{r}{t}".encode()).hexdigest())

    out = defaultdict(list)
    for row in sorted((r for r in rows if r[0] is not None), key=key):
        out[row[0]].append((row[2] or "", row[3] or ""))
    return {c: tuple(s) for c, s in out.items()}


def rebuild(own):
    out = {}
    for c, seq in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = own.get(c - int(c - 5 * int(c / 5)), ())
        out[c] = base[:h] + seq[h:]
    return out


def brute(convs):
    members = defaultdict(list)
    for c, seq in convs.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
    out = []
    for node, ids in members.items():
        below = [n for n in members if n[: len(node)] == node]
        children = [n for n in below if len(n) == len(node) + 1]
        leaves = [n for n in below if not any(len(m) == len(n) + 1 and m[: len(n)] == n for m in members)]
        saved = sum((len(members[n]) - 1) * len(n[-1][1].encode()) for n in below if n)
        ends = ",".join(str(c) for c in sorted(c for c in ids if convs[c] == node))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(ids), len(node), parent, len(ids), len(children), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def found(df):
    assert [(f.name, f.dataType.simpleString()) for f in df.select(*NAMES).schema][:-1] == [(n, "bigint") for n in NAMES[:-1]]
    return sorted((tuple(r) for r in df.select(*NAMES).collect()), key=str)


def random_turns(rng, n):
    rows = []
    for c in range(n):
        for t in range(rng.randrange(1, 6)):
            rows.append((c, t, rng.choice(["user", "assistant", None]), rng.choice(["é", "ab", "", None, "x"])))
    return rows


def test_random_conversations(spark):
    rng = random.Random(3)
    rows = random_turns(rng, 60)
    rng.shuffle(rows)
    assert found(trie.prefix_trie(spark.createDataFrame(rows, TURNS))) == brute(sequences(rows))


def test_rebuilt_starts(spark):
    rng = random.Random(4)
    rows = [(c - 30, *rest) for c, *rest in random_turns(rng, 70) if c not in (35, 50)]
    paths = trie.sequences(spark.createDataFrame(rows, TURNS))
    starts = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9
    rebuilt = trie.shared_starts(paths, starts, F.col("conv_id") - F.col("conv_id") % 5)
    expected = rebuild(sequences(rows))
    assert () in expected.values()
    assert found(trie.trie(rebuilt)) == brute(expected)


def test_nulls_ties_and_repeated_rows(spark):
    rows = [(1, None, None, None), (1, 0, "user", "a"), (1, 0, "user", "b"), (1, 0, "user", "a")]
    rows += [(2, 0, "user", "b"), (2, 0, "user", "a"), (2, 0, "user", "a"), (2, None, "", "")]
    rows += [(None, 0, "user", "a"), (3, None, "user", "z"), (3, -5, "user", "y"), (3, None, "user", "z"), (-4, 1, "use", "ra")]
    nodes = trie.prefix_trie(spark.createDataFrame(rows, TURNS))
    assert found(nodes) == brute(sequences(rows))
    assert nodes.where("depth = 4 AND n_convs = 2").count() == 1


def test_role_and_text_are_kept_apart(spark):
    rows = [(1, 0, "ab", "c"), (2, 0, "a", "bc"), (3, 0, "1:a", ""), (4, 0, "", "1:a")]
    assert trie.prefix_trie(spark.createDataFrame(rows, TURNS)).where("depth = 1").count() == 4


def test_copies_in_many_spans(spark):
    ids = [-9000, -4096, -4095, -1, 0, 1, 4095, 4096, 9, 10, 100, 2**62, -(2**62)]
    rows = [(c, t, "user", "same") for c in ids for t in range(3)] + [(7, 0, "user", "same")]
    assert found(trie.prefix_trie(spark.createDataFrame(rows, TURNS))) == brute(sequences(rows))


def test_long_and_deep(spark):
    rows = [(1, t, "user", "x" * (2_000_000 if t == 1 else 3)) for t in range(40)] + [(2, t, "user", "xxx") for t in range(2)]
    assert found(trie.prefix_trie(spark.createDataFrame(rows, TURNS))) == brute(sequences(rows))


def test_long_shared_starts_and_copies(spark):
    rows = []
    for c, turns in ((1, 37), (2, 37), (3, 19), (4, 20), (5, 16), (6, 1), (7, 64)):
        # 1 and 2 are equal; 3 and 4 share 18 turns with them; 7 shares two, then repeats one turn.
        rows += [(c, t, "user", f"{'x' * (t % 5)}{t}" if c != 7 or t < 2 else "again") for t in range(turns)]
    rows = [(c, t, r, "other" if (c, t) in ((3, 18), (4, 19)) else x) for c, t, r, x in rows]
    nodes = trie.prefix_trie(spark.createDataFrame(rows, TURNS))
    assert found(nodes) == brute(sequences(rows))
    assert nodes.select("node").distinct().count() == nodes.count()


def test_empty(spark):
    nodes = trie.prefix_trie(spark.createDataFrame([], TURNS))
    assert nodes.select(*NAMES).collect() == []
    assert trie.prefix_trie(spark.createDataFrame([(None, 1, "user", "x")], TURNS)).count() == 0


def test_other_columns(spark):
    names = f"{TURNS}, path string, depth int, n_convs int, base int, ids string, of_path string"
    rows = [(c, t, "user", f"{t * c % 3}", "p", 9, 9, 9, "i", "o") for c in range(6) for t in range(3)]
    assert found(trie.prefix_trie(spark.createDataFrame(rows, names))) == brute(sequences([r[:4] for r in rows]))


def test_query_equals_sql_and_brute_force(spark):
    result = queries.QUERIES["op12_prefix_trie"](spark, SF_DIR)
    db = oracle.connect(SF_DIR)
    sql = queries.SQL["op12_prefix_trie"]
    assert oracle.spark_types(result) == oracle.duck_types(db, sql)
    got = oracle.spark_rows(result)
    assert got == oracle.duck_rows(db, sql)
    rows = db.execute("SELECT conv_id, turn, role, text FROM conversations").fetchall()
    assert found(result) == brute(rebuild(sequences(rows)))
