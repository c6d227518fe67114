"""Languages of text spans: script ranges, word scores, and Viterbi with a switching penalty.

A word's script leaves only languages that are written in it. Among these the
word's character trigrams score each language, by a model learnt from labelled
documents. A Viterbi pass over the words labels each with a language, where a
change of language costs ``PENALTY``; neighbouring words of one label are a
span, and the language with the most letters is the text's.

The model is fitted on a bounded sample: ``PER_LANGUAGE`` labelled documents of
each language, those with the smallest hashes of their ids. Every whole text
is labelled.
"""

from __future__ import annotations

import itertools
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType
from pyspark.sql.window import Window

from deedlens.llm.arrow import texts

#: Documents of each language that the model is fitted on, at most.
PER_LANGUAGE = 1_000
#: What a change of language costs, in natural-log units.
PENALTY = 12.0
#: A language is a candidate for a script that holds at least this share of its training letters.
SCRIPT_SHARE = 0.01
UNDETERMINED = "und"
SMOOTHING = 0.5
#: Chunks that a worker keeps scores of before new texts; above that it starts again, as after a text of LONG characters.
CACHED = 300_000
LONG = 10_000_000
#: Texts whose words are scored at once.
TOGETHER = 64
SEED = 42

# First and last code point of the letters of each script; what is in none is a script of its own.
SCRIPTS = [
    (0x0041, 0x024F, "latin"),
    (0x0370, 0x03FF, "greek"),
    (0x0400, 0x052F, "cyrillic"),
    (0x0530, 0x058F, "armenian"),
    (0x0590, 0x05FF, "hebrew"),
    (0x0600, 0x077F, "arabic"),
    (0x0900, 0x097F, "devanagari"),
    (0x0980, 0x09FF, "bengali"),
    (0x0B80, 0x0BFF, "tamil"),
    (0x0E00, 0x0E7F, "thai"),
    (0x10A0, 0x10FF, "georgian"),
    (0x1100, 0x11FF, "hangul"),
    (0x1E00, 0x1EFF, "latin"),
    (0x1F00, 0x1FFF, "greek"),
    (0x3040, 0x30FF, "kana"),
    (0x3400, 0x9FFF, "han"),
    (0xAC00, 0xD7AF, "hangul"),
    (0xF900, 0xFAFF, "han"),
    (0x20000, 0x323AF, "han"),
]
_STARTS = np.array([s[0] for s in SCRIPTS])
_ENDS = np.array([s[1] for s in SCRIPTS])
_WORD = re.compile(r"[^\W\d_]+")


def script_of(letter: str) -> str:
    code = ord(letter)
    i = int(np.searchsorted(_STARTS, code, "right")) - 1
    return SCRIPTS[i][2] if i >= 0 and code <= _ENDS[i] else "other"


def trigrams(word: str) -> list[str]:
    """Character trigrams of a word with its borders; the middle of each is a letter of it."""
    padded = f" {word} "
    return [padded[i : i + 3] for i in range(len(word))]


@dataclass
class Model:
    """Log probabilities of trigrams by language, and the languages that each script leaves."""

    languages: list[str]
    #: Row of each trigram in ``table``; its last row is that of trigrams not seen.
    grams: dict[str, int]
    table: np.ndarray
    #: Row of each script in ``allowed``; scripts that were not seen leave nothing to tell languages by.
    scripts: dict[str, int]
    allowed: np.ndarray
    penalty: float = PENALTY
    # Scores of chunks seen before: row numbers, and the rows.
    _rows: dict[str, int] = field(default_factory=dict, repr=False)
    _scores: np.ndarray | None = field(default=None, repr=False)
    _script_of: dict[str, int] = field(default_factory=dict, repr=False)

    @classmethod
    def of_counts(cls, counts: list[tuple[str, str, int]], penalty: float = PENALTY) -> Model:
        """From rows of language, trigram and how often it was seen."""
        languages = sorted({c[0] for c in counts})
        grams = {gram: i for i, gram in enumerate(sorted({c[1] for c in counts}))}
        seen = np.zeros((len(grams) + 1, len(languages)))
        at = {lang: i for i, lang in enumerate(languages)}
        for lang, gram, n in counts:
            seen[grams[gram], at[lang]] += n
        total = seen.sum(axis=0)
        letters: dict[str, np.ndarray] = {}
        for gram, i in grams.items():
            letters.setdefault(script_of(gram[1]), np.zeros(len(languages)))
            letters[script_of(gram[1])] += seen[i]
        scripts = {script: i for i, script in enumerate(sorted(letters))}
        allowed = np.array([letters[s] >= SCRIPT_SHARE * np.maximum(total, 1) for s in scripts], bool)
        table = np.log(seen + SMOOTHING) - np.log(total + SMOOTHING * len(seen))
        return cls(languages, grams, table, scripts, allowed.reshape(len(scripts), len(languages)), penalty)

    def word_scores(self, words: list[str]) -> np.ndarray:
        """A row of log scores per word; languages that its script rules out lie far below the others."""
        if not words:
            return np.zeros((0, len(self.languages)))
        find, unseen = self.grams.get, len(self.grams)
        ids: list[int] = []
        for word in words:
            padded = f" {word} "
            ids += [find(padded[i : i + 3], unseen) for i in range(len(word))]
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        total = np.add.reduceat(self.table[ids], np.cumsum(lengths) - lengths, axis=0)
        script = np.fromiter(map(self._script, words), np.int64, len(words))
        allowed = self.allowed[script]
        lowest = total.min(axis=1, keepdims=True) - 2 * self.penalty
        scores = np.where(allowed, total, lowest)
        scores[(script < 0) | ~allowed.any(axis=1)] = 0
        return scores

    def _script(self, word: str) -> int:
        letter = word[0]
        found = self._script_of.get(letter)
        if found is None:
            found = self._script_of[letter] = self.scripts.get(script_of(letter), -1)
        return found

    def _learn(self, chunks: list[str]) -> None:
        """Keep the scores of all words between two blanks, and their letters behind."""
        words_of = [_WORD.findall(chunk.lower()) for chunk in chunks]
        words = [w for ws in words_of for w in ws]
        scores = np.column_stack([self.word_scores(words), np.fromiter(map(len, words), float, len(words))])
        # Running sums tell the sum of each chunk, also of those without a word.
        sums = np.vstack([np.zeros(scores.shape[1]), np.cumsum(scores, axis=0)])
        ends = np.cumsum([len(ws) for ws in words_of])
        rows = sums[ends] - sums[np.concatenate([[0], ends[:-1]])]
        first = len(self._rows)
        while first + len(chunks) > len(self._scores):
            self._scores = np.concatenate([self._scores, np.empty_like(self._scores)])
        self._scores[first : first + len(chunks)] = rows
        self._rows.update(zip(chunks, range(first, first + len(chunks)), strict=True))

    def viterbi(self, scores: np.ndarray) -> np.ndarray:
        """The best language of each row, where each change costs the penalty; ties go to the earlier language.

        If no stretch of rows gains more than half the penalty in another language
        than the one that is best for all, that one is the answer for all: a path
        with m changes has m + 1 stretches, which gain m penalties at most.
        """
        best = int(scores.sum(axis=0).argmax())
        gain = np.cumsum(scores - scores[:, best : best + 1], axis=0)
        floor = np.minimum.accumulate(np.vstack([np.zeros(gain.shape[1]), gain[:-1]]), axis=0)
        if (gain - floor).max() <= self.penalty / 2:
            return np.full(len(scores), best)
        # Plain numbers: for a few languages they beat arrays by far. ``back`` notes the rows in which a language
        # is reached from another.
        value = [0.0] * scores.shape[1]
        back: list[tuple[int, list[bool]] | None] = []
        for row in scores.tolist():
            top = max(value)
            changed = top - self.penalty
            if min(value) >= changed:
                back.append(None)
                value = [v + x for v, x in zip(value, row, strict=True)]
            else:
                back.append((value.index(top), [v < changed for v in value]))
                value = [(v if v >= changed else changed) + x for v, x in zip(value, row, strict=True)]
        path = np.empty(len(scores), np.int64)
        state = value.index(max(value))
        for t in range(len(scores) - 1, -1, -1):
            path[t] = state
            step = back[t]
            if step is not None and step[1][state]:
                state = step[0]
        return path

    def label(self, text: str) -> tuple[str, float, list[tuple[int, int, str]]]:
        """Language, its share of the letters, and spans of (start, end, language) in characters."""
        return next(self.label_all([text]))

    def label_all(self, all_texts: Iterable[str]) -> Iterator[tuple[str, float, list[tuple[int, int, str]]]]:
        """``label`` of each text; the words of some texts are scored together."""
        all_texts = iter(all_texts)
        while group := list(itertools.islice(all_texts, TOGETHER)):
            splits = [text.split() for text in group]
            if len(self._rows) > CACHED or self._scores is None:
                self._rows, self._scores = {}, np.empty((4096, len(self.languages) + 1))
            if self.languages and (new := list(set().union(*splits).difference(self._rows))):
                self._learn(new)
            for text, chunks in zip(group, splits, strict=True):
                yield self._label(text, chunks)
            if len(self._rows) > CACHED or max(map(len, group)) > LONG:
                self._rows, self._scores = {}, None

    def _label(self, text: str, chunks: list[str]) -> tuple[str, float, list[tuple[int, int, str]]]:
        if not self.languages or not chunks:
            return UNDETERMINED, 0.0, []
        table = self._scores[np.fromiter(map(self._rows.__getitem__, chunks), np.int64, len(chunks))]
        letters = table[:, -1]
        whole = letters.sum()
        if not whole:
            return UNDETERMINED, 0.0, []
        path = self.viterbi(table[:, :-1])
        share = np.bincount(path, letters, len(self.languages))
        best = int(share.argmax())
        return self.languages[best], min(1.0, float(share[best] / whole)), self._spans(text, path)

    def _spans(self, text: str, path: np.ndarray) -> list[tuple[int, int, str]]:
        cuts = np.flatnonzero(np.diff(path)) + 1
        firsts = [0, *cuts.tolist()]
        if len(firsts) == 1:
            return [(0, len(text), self.languages[path[0]])]
        starts = [m.start() for m in re.finditer(r"\S+", text)]
        borders = [0, *(starts[c] for c in firsts[1:]), len(text)]
        return [(s, e, self.languages[path[f]]) for s, e, f in zip(borders, borders[1:], firsts, strict=False)]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), texts(batch.column("text")), strict=True):
            for word, n in Counter(_WORD.findall(text.lower())).items():
                for gram in trigrams(word):
                    counts[lang, gram] += n
    if counts:
        keys = list(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys]), pa.array([k[1] for k in keys]), pa.array(list(counts.values()), pa.int64())],
            ["lang", "gram", "n"],
        )


def fit(labelled: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> Model:
    """A model from documents with a language; rows with a NULL text or language are left out.

    Takes ``PER_LANGUAGE`` rows of each language. What reaches the driver are
    the trigrams of that sample. Without rows the model knows no language.
    """
    known = labelled.select(
        F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").alias("lang")
    ).where("text IS NOT NULL AND lang IS NOT NULL")
    order = Window.partitionBy("lang").orderBy(F.xxhash64(F.lit(SEED), "id"), "id", "row")
    # Ids alone are ranked; the texts follow by a join with the short list.
    chosen = (
        known.select("id", "lang", F.xxhash64("text").alias("row"))
        .withColumn("number", F.row_number().over(order))
        .where(F.col("number") <= PER_LANGUAGE)
        .select(F.col("id").alias("of_id"), F.col("lang").alias("of_lang"), F.col("row").alias("of_row"))
        .distinct()
    )
    same = (
        F.col("id").eqNullSafe(F.col("of_id"))
        & (F.col("lang") == F.col("of_lang"))
        & (F.xxhash64("text") == F.col("of_row"))
    )
    sample = known.join(F.broadcast(chosen), same).select("lang", "text")
    counts = sample.mapInArrow(_counted, "lang string, gram string, n long")
    rows = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n")).collect()
    return Model.of_counts([tuple(r) for r in rows])


_KIND = StructType(
    [
        StructField("lang", StringType()),
        StructField("score", DoubleType()),
        StructField(
            "spans",
            ArrayType(
                StructType(
                    [StructField("start", LongType()), StructField("end", LongType()), StructField("lang", StringType())]
                )
            ),
        ),
    ]
)


def identify(text: Column, model: Model, spark) -> Column:
    """A struct of ``lang``, ``score`` and ``spans`` for each whole text.

    ``score`` is the language's share of the text's letters, from 0 to 1.
    Spans cover the text without gaps. A NULL text, one without a letter, and
    any text under a model without languages is ``und`` with score 0 and no span.
    """
    shared = spark.sparkContext.broadcast(model)

    @arrow_udf(_KIND)
    def labelled(column: pa.Array) -> pa.Array:
        found = list(shared.value.label_all(texts(column)))
        spans = [[{"start": s, "end": e, "lang": lang} for s, e, lang in f[2]] for f in found]
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))
        return pa.StructArray.from_arrays(
            [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64()), pa.array(spans, kind)],
            ["lang", "score", "spans"],
        )

    return labelled(text)
