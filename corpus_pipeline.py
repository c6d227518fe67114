"""A corpus from raw documents to packed training sequences, in stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; its result
is written as Parquet and read again as the next one's ``docs``. All but the
last return the columns of ``documents``. NULL ids and texts, repeated rows and
empty tables are handled as the operators say; rows are never sampled.

No SQL can express these stages (a forest, MinHash, SimHash, a tokenizer), so
``ORACLE_SQL`` is None and the tests compare with brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deedlens.llm import lines, packing, quality, secrets, simhash
from deedlens.llm.arrow import small_batches
from deedlens.sources.scratch import stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _counted(docs: DataFrame) -> DataFrame:
    """The columns of documents, with the length of the text as it is now."""
    length = F.char_length("text").cast("long")
    return docs.withColumn("n_chars", length).select(*COLUMNS)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules and the forest keep; the forest is calibrated on the labels of ``sf_dir``."""
    small_batches(spark)
    docs = docs.select(*COLUMNS)
    forest = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.judge(docs, forest).where("quality.kept").select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; of equal and nearly equal lines one is left in the corpus."""
    small_batches(spark)
    return _counted(lines.dedup_lines(docs.select(*COLUMNS)))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that with the smallest id."""
    small_batches(spark)
    return simhash.one_of_each(docs.select(*COLUMNS))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts masked."""
    small_batches(spark)
    docs = docs.select(*COLUMNS)
    model = secrets.fit(docs)
    return _counted(docs.withColumn("text", secrets.redact(F.col("text"), model, spark)))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, each a sequence."""
    small_batches(spark)
    # Python workers of earlier stages still hold memory: fewer words are kept.
    return packing.packed(docs, cached=100_000)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near-dedup", near_dedup),
    ("secret scan", secret_scan),
    ("packing", pack),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of the last stage over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
