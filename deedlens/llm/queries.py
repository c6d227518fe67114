"""Registered queries of the training-data operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deedlens.llm import (
    byte_bpe,
    extraction,
    language,
    lexical,
    lines,
    neighbours,
    packing,
    positive,
    quality,
    secrets,
    sharding,
    simhash,
    trie,
)
from deedlens.sources.scratch import stored

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op5_interleaved_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.interleaved_shards(table(spark, sf_dir, "documents"))


@query
def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hexadecimal("fp").alias("fingerprint"), "component_id")


@query
def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = table(spark, sf_dir, "documents").select("doc_id", byte_bpe.round_trip(F.col("text")).alias("coded"))
    return coded.select(
        "doc_id",
        F.size("coded.ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("coded.ids", ","), 256).alias("ids_sha256"),
        F.sha2("coded.decoded", 256).alias("decoded_sha256"),
    )


@query
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    forest = quality.fit(documents, table(spark, sf_dir, "labels"))
    q = quality.judge(documents, forest)
    return q.select("doc_id", *(f"quality.{n}" for n in [*quality.COUNTS, "base_failed", "kept", "score"]))


@query
def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"))


@query
def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 3 == 1
    model = language.fit(documents.where(~held_out))
    return documents.select(
        "doc_id", held_out.alias("held_out"), language.identify(F.col("text"), model, spark).alias("found")
    ).select("doc_id", "held_out", F.col("found.lang").alias("lang_pred"), "found.score")


@query
def op8_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    weights = extraction.fit(pages)
    return pages.select("page_id", "url", extraction.extract(F.col("html"), weights).alias("text")).select(
        "page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars")
    )


@query
def op4_hilbert_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@query
def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.line_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "line_no", "keep_doc_id", "keep_line_no", "kept")


@query
def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = secrets.fit(documents)
    found = documents.select("doc_id", F.explode(secrets.scan(F.col("text"), model, spark)).alias("found"))
    # The value itself is not repeated in the report.
    return found.select(
        "doc_id", "found.start", "found.length", F.sha2("found.value", 256).alias("value_sha256"), "found.score", "found.is_secret"
    )


@query
def op11_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents"))


_TERMS = r"""regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

SQL["op11_lexical"] = f"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS terms FROM documents
), totals AS (
  SELECT count(*) AS docs, sum(len(terms)) AS total FROM texts WHERE len(terms) > 0
), counts AS (
  SELECT r, doc_id, n, term, count(*) AS tf
  FROM (SELECT r, doc_id, len(terms) AS n, unnest(terms) AS term FROM texts)
  GROUP BY r, doc_id, n, term
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM counts CROSS JOIN totals GROUP BY term, docs
), items AS (
  SELECT item_id, term, count(*) AS times
  FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark)
  GROUP BY item_id, term
), scores AS (
  SELECT item_id, r, doc_id,
    CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // total)))) AS BIGINT) AS score
  FROM items JOIN counts USING (term) JOIN weights USING (term) CROSS JOIN totals
  GROUP BY item_id, r, doc_id
), ranked AS (
  SELECT item_id, doc_id, score,
    CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST) AS INTEGER) AS rank
  FROM scores WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
"""


@query
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = stored(trie.sequences(table(spark, sf_dir, "conversations")), "paths")
    starts = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9
    rebuilt = trie.shared_starts(paths, starts, F.col("conv_id") - F.col("conv_id") % 5)
    return trie.trie(rebuilt).drop("node")


# The CRC-32 of a string of digits, bit by bit.
_CRC32 = """xor(4294967295, list_reduce(
      list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)),
      lambda crc, code: list_reduce(range(8), lambda bits, i: CASE WHEN bits % 2 = 1 THEN xor(bits // 2, 3988292384) ELSE bits // 2 END, xor(crc, code)),
      4294967295))"""

SQL["op12_prefix_trie"] = f"""
WITH turns AS (
  SELECT conv_id, turn, strlen(coalesce(text, '')) AS bytes,
    sha256(CAST(strlen(coalesce(role, '')) AS VARCHAR) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest
  FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT conv_id, list({{'digest': digest, 'bytes': bytes}} ORDER BY turn NULLS FIRST, digest) AS seq, {_CRC32} % 9 AS h
  FROM turns GROUP BY conv_id
), rebuilt AS (
  SELECT own.conv_id, list_concat(coalesce(base.seq[1:own.h], []), own.seq[own.h + 1:]) AS seq
  FROM own LEFT JOIN own AS base ON base.conv_id = own.conv_id - own.conv_id % 5
), prefixes AS (
  SELECT conv_id, len(seq) AS turns, depth, seq[1:depth] AS prefix
  FROM (SELECT conv_id, seq, unnest(range(len(seq) + 1)) AS depth FROM rebuilt)
), nodes AS (
  SELECT depth, prefix, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE turns = depth), '')) AS ends_sha256,
    (count(*) - 1) * coalesce(prefix[depth].bytes, 0) AS saved
  FROM prefixes GROUP BY depth, prefix
), children AS (
  SELECT depth - 1 AS depth, prefix[1:depth - 1] AS prefix, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL
), counted AS (
  SELECT nodes.*, coalesce(children.n_children, 0) AS n_children
  FROM nodes LEFT JOIN children ON children.depth = nodes.depth AND children.prefix = nodes.prefix
), subtrees AS (
  SELECT above AS depth, prefix[1:above] AS prefix, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum(saved) AS saved_tokens
  FROM (SELECT prefix, n_children, saved, unnest(range(depth + 1)) AS above FROM counted)
  GROUP BY ALL
)
SELECT counted.conv_id, counted.depth, parent.conv_id AS parent_conv_id, counted.n_convs, counted.n_children,
  subtrees.n_leaves, CAST(subtrees.saved_tokens AS BIGINT) AS saved_tokens, counted.ends_sha256
FROM counted
JOIN subtrees ON subtrees.depth = counted.depth AND subtrees.prefix = counted.prefix
LEFT JOIN nodes AS parent ON parent.depth = counted.depth - 1 AND parent.prefix = counted.prefix[1:counted.depth - 1]
"""


@query
def op13_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 4 == 2
    model = positive.fit(documents.where(~held_out), table(spark, sf_dir, "labels").where(~held_out))
    scored = documents.select("doc_id", held_out.alias("held_out"), positive.score(F.col("text"), model, spark).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))
