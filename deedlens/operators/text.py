"""Polarity of texts from a lexicon."""

from __future__ import annotations

import json
import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deedlens.functions.text import quoted
from deedlens.sources.scratch import stored

# ASCII punctuation and line characters that separate words, beside the blank.
SEPARATORS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~\t\n\r"
_CLASS = r"!-/:-@\[-`{-~ \t\n\r"
_BETWEEN_WORDS = f"[{_CLASS}]+"


def words(text: Column) -> Column:
    """Lower-case words of a text, split on blanks and ASCII punctuation."""
    return F.split(F.lower(text), _BETWEEN_WORDS)


#: Words that are searched for as one pattern; a mapping or frame of more is looked up by hash.
PATTERN_WORDS = 64
#: Words, and bytes of them, up to which a lexicon is sent along with the tasks.
LEXICON_WORDS, LEXICON_BYTES = 20_000, 1 << 20


def _mean_of(found: Column) -> Column:
    """Mean weight over an array of ``(total, n)``, 0 for an empty one; NULLs are words that the lexicon lacks."""
    start = F.struct(F.lit(0.0).alias("total"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(
        found,
        start,
        lambda s, x: F.struct(
            (s["total"] + F.coalesce(x["total"], F.lit(0.0))).alias("total"),
            (s["n"] + F.coalesce(x["n"], F.lit(0).cast("long"))).alias("n"),
        ),
        lambda s: F.coalesce(s["total"] / F.nullif(s["n"], F.lit(0).cast("long")), F.lit(0.0)),
    )


def _by_pattern(text: Column, lexicon: Mapping[str, float]) -> Column:
    """Only lexicon words are taken out of the text, so what is looked up is what is found."""
    able = {w: float(weight) for w, weight in lexicon.items() if re.fullmatch(f"[^{_CLASS}]+", w) and w == w.lower()}
    if not able:
        return F.lit(0.0)
    listed = "|".join(re.escape(w) for w in able)
    # Behind a word stands a separator that is not taken, for it may be the one before the next word.
    pattern = rf"(?:^|[{_CLASS}])({listed})(?=[{_CLASS}]|\z)"
    known = F.create_map(*[F.lit(x) for pair in able.items() for x in pair])
    hits = F.regexp_extract_all(F.lower(text), F.lit(pattern), F.lit(1))
    return _mean_of(F.transform(hits, lambda w: F.struct(F.try_element_at(known, w).alias("total"), F.lit(1).cast("long").alias("n"))))


def _by_buckets(df: DataFrame, text: str, weights: DataFrame, buckets: int, out: str) -> DataFrame:
    """Words meet the lexicon in an array of small maps, at the place that their hash names.

    The array is a constant of the plan, so no text is moved. The driver holds
    the lexicon once to make it.
    """
    bucket = F.pmod(F.xxhash64("word"), F.lit(buckets)).alias("b")
    places: list[dict] = [{} for _ in range(buckets)]
    for row in weights.select(bucket, "word", "total", "n").collect():
        places[row.b][row.word] = {"total": row.total, "n": row.n}
    constant = F.from_json(F.lit(json.dumps(places)), "array<map<string, struct<total: double, n: bigint>>>")

    def mean(lexicon: Column) -> Column:
        def looked_up(word: Column) -> Column:
            place = F.pmod(F.xxhash64(word), F.lit(buckets)).cast("int") + 1
            return F.try_element_at(F.element_at(lexicon, place), word)

        return _mean_of(F.transform(words(F.col(quoted(text))), looked_up))

    # Handed on as the one element of an array, which Catalyst folds into a constant.
    score = F.element_at(F.transform(F.array(constant), mean), 1)
    return df.withColumn(out, F.when(F.col(quoted(text)).isNotNull(), score).cast("float"))


def _size(weights: DataFrame) -> tuple[int, int]:
    row = weights.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("word")), F.lit(0))).first()
    return row[0], row[1]


def _fits(size: tuple[int, int]) -> bool:
    return size[0] <= LEXICON_WORDS and size[1] <= LEXICON_BYTES


def polarity(df: DataFrame, text: str, lexicon: Mapping[str, float] | DataFrame, out: str = "polarity") -> DataFrame:
    """Add the mean weight of the lexicon words in each text; every row and column stays.

    A text without such words scores 0, a NULL text NULL. A lexicon is a mapping,
    or a frame with columns ``word`` and ``weight``, in which a word may stand
    several times. Words are lower case and hold no separator; others cannot
    occur in a text.

    Texts are never moved as long as the lexicon can be sent to the tasks. Up to
    ``PATTERN_WORDS`` words are searched for as one pattern. A larger lexicon is
    counted, which runs a job, and up to ``LEXICON_WORDS`` words looked up by
    hash. Beyond that it is first cut to words that occur in the texts, for which
    only distinct words are shuffled; what then is still too large is joined
    with the words of each distinct text.
    """
    if not isinstance(lexicon, DataFrame):
        bad = [w for w, weight in lexicon.items() if not -1.0 <= weight <= 1.0]
        if bad:
            raise ValueError(f"weights must lie between -1 and 1: {bad[:5]}")
        if len(lexicon) <= PATTERN_WORDS:
            t = F.col(quoted(text))
            return df.withColumn(out, F.when(t.isNotNull(), _by_pattern(t, lexicon)).cast("float"))
        listed = [(w, float(weight)) for w, weight in lexicon.items()]
        lexicon = df.sparkSession.createDataFrame(listed, "word string, weight double")
    weights = stored(
        lexicon.where("word IS NOT NULL AND word <> '' AND weight IS NOT NULL")
        .groupBy("word")
        .agg(F.sum(F.col("weight").cast("double")).alias("total"), F.count("*").alias("n")),
        "lexicon",
    )
    size = _size(weights)
    if not _fits(size):
        occurring = df.select(F.explode(words(F.col(quoted(text)))).alias("word")).distinct()
        weights = stored(weights.join(occurring, "word", "left_semi"), "lexicon")
        size = _size(weights)
    if _fits(size):
        return _by_buckets(df, text, weights, max(1, 2 * size[0]), out)
    return _polarity_by_join(df, text, weights, out)


def _polarity_by_join(df: DataFrame, text: str, weights: DataFrame, out: str) -> DataFrame:
    t = F.col(quoted(text))
    digest = F.sha2(t, 256)
    distinct = df.select(digest.alias("_digest"), t.alias("_text")).where("_text IS NOT NULL")
    tokens = distinct.dropDuplicates(["_digest"]).select("_digest", F.explode(words(F.col("_text"))).alias("word"))
    means = tokens.join(weights, "word").groupBy("_digest").agg((F.sum("total") / F.sum("n")).alias("_mean"))
    scored = df.withColumn("_of", digest).join(means, F.col("_of") == F.col("_digest"), "left")
    score = F.when(t.isNotNull(), F.coalesce(F.col("_mean"), F.lit(0.0))).cast("float")
    return scored.withColumn(out, score).drop("_of", "_digest", "_mean")
