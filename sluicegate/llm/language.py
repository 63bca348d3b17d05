"""Language by words first, then by ever shorter character n-grams.

A word that some language knows scores by its relative frequency there (negative log10, a fixed penalty where
a language lacks it). A word unknown to all backs off to its n-grams, padded with a blank on both sides, from
the longest size of which any language knows one. A text gets the language with the lowest mean over its
words.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from sluicegate.llm.rows import map_batches, map_rows, memo

UNDETERMINED = "und"
WORDS = 0  # the size under which whole words are counted
SIZES = (4, 3, 2, 1)
PENALTY = 7.0
# The model is fitted on about so many labelled documents per language, chosen by a hash of their number,
# and keeps so many words, and so many n-grams of each size, per language.
TRAIN_DOCUMENTS, KEPT = 1000, 10_000
# Distinct words whose scores a worker remembers.
REMEMBERED = 1 << 18
_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    """Runs of letters in lower case."""
    return [word for word in _WORD.findall(text.lower()) if word.isalpha()]


def grams(word: str, size: int) -> list[str]:
    """The word's n-grams, with a blank on both sides; a blank alone is none, since every word has it."""
    if size == 1:
        return list(word)
    padded = f" {word} "
    return [padded[i : i + size] for i in range(len(padded) - size + 1)]


@dataclass(frozen=True)
class Model:
    """Scores of words and n-grams, one per language in the order of ``languages``."""

    languages: tuple[str, ...]
    rows: dict[int, dict[str, int]]  # by size and gram: its row of scores
    scores: np.ndarray
    usual: str  # the language of most training documents

    @classmethod
    def of(cls, languages: Sequence[str], scores: Iterable[tuple[int, str, str, float]], usual: str) -> Model:
        """From scores as size, gram, language and score."""
        place = {lang: i for i, lang in enumerate(languages)}
        rows: dict[int, dict[str, int]] = {size: {} for size in (WORDS, *SIZES)}
        held: list[np.ndarray] = []
        for size, gram, lang, score in scores:
            row = rows[size].setdefault(gram, len(held))
            if row == len(held):
                held.append(np.full(len(languages), PENALTY, dtype=np.float32))
            held[row][place[lang]] = score
        matrix = np.array(held, dtype=np.float32).reshape(len(held), len(languages))
        return cls(tuple(languages), rows, matrix, usual)


def held_out() -> Column:
    """Whether a document is kept from training: crc32 of its number as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


COUNTS = T.StructType(
    [
        T.StructField("lang", T.StringType()),
        T.StructField("size", T.IntegerType()),
        T.StructField("gram", T.StringType()),
        T.StructField("n", T.LongType()),
    ]
)


def fit(docs: DataFrame, documents: int = TRAIN_DOCUMENTS, kept: int = KEPT) -> Model:
    """Learn from text and lang of documents that have both and a doc_id, and are not held out.

    Counts run on the executors; the driver gets at most ``kept`` entries per language and size.
    """
    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    labelled = labelled.where(~held_out()).select("doc_id", "lang", "text")
    sizes = {r.lang: r["count"] for r in labelled.groupBy("lang").count().collect()}
    if not sizes:
        return Model.of((), (), UNDETERMINED)
    shares = F.create_map(*(F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, documents / n))))
    drawn = F.pmod(F.xxhash64("doc_id", F.lit("training")), F.lit(1 << 30)) < shares[F.col("lang")] * (1 << 30)

    def rule(langs: list, texts: list) -> Iterator[tuple]:
        by_lang: dict[str, Counter] = {}
        for lang, text in zip(langs, texts):
            by_lang.setdefault(lang, Counter()).update(words_of(text))
        for lang, words in by_lang.items():
            yield from ((lang, WORDS, word, n) for word, n in words.items())
            for size in SIZES:
                counts: Counter = Counter()
                for word, n in words.items():
                    for gram in grams(word, size):
                        counts[gram] += n
                yield from ((lang, size, gram, n) for gram, n in counts.items())

    counted = map_rows(labelled.where(drawn), ("lang", "text"), rule, COUNTS)
    summed = counted.groupBy("lang", "size", "gram").agg(F.sum("n").alias("n"))
    by_size = Window.partitionBy("lang", "size")
    ranked = summed.withColumn("place", F.row_number().over(by_size.orderBy(F.desc("n"), "gram")))
    ranked = ranked.withColumn("total", F.sum("n").over(by_size)).where(F.col("place") <= kept)
    languages = tuple(sorted(sizes))
    usual = min(languages, key=lambda lang: (-sizes[lang], lang))
    score = (-F.log10(F.col("n") / F.col("total"))).alias("score")
    rows = ranked.select("size", "gram", "lang", score).collect()
    return Model.of(languages, map(tuple, rows), usual)


class Scorer(dict):
    """Scores of words under a model, remembered as rows of one matrix. Row 0 is for words without evidence."""

    def __init__(self, model: Model):
        super().__init__()
        self.model = model
        self.matrix = np.zeros((REMEMBERED + 1, len(model.languages)))

    def _scores(self, word: str) -> np.ndarray | None:
        known = self.model.rows[WORDS].get(word)
        if known is not None:
            return self.model.scores[known]
        for size in SIZES if word.isalpha() else ():
            table = self.model.rows[size]
            found = [table[gram] for gram in grams(word, size) if gram in table]
            if found:
                return np.add.reduce(self.model.scores[found]) / len(found)
        return None

    def __missing__(self, word: str) -> int:
        scores, row = self._scores(word), 0
        if scores is not None:
            row = len(self) + 1
            self.matrix[row] = scores
        self[word] = row
        return row

    def predict(self, text: str | None) -> tuple[str, float]:
        """The language and how sure it is: the softmax of the mean scores. Ties go to the first language."""
        return self.assess(text)[:2]

    def assess(self, text: str | None) -> tuple[str, float, float]:
        """The language, how sure it is, and the share of the words that the model has any evidence for."""
        counts = Counter(_WORD.findall((text or "").lower()))
        if not counts or not self.model.languages:
            return UNDETERMINED, 0.0, 0.0
        total, weight = np.zeros(len(self.model.languages)), 0
        words, times = list(counts), np.fromiter(counts.values(), np.int64, len(counts))
        step = min(REMEMBERED, 1 << 14)
        for at in range(0, len(words), step):
            part = words[at : at + step]
            if len(self) + len(part) > REMEMBERED:
                self.clear()
            rows = np.fromiter(map(self.__getitem__, part), np.int64, len(part))
            n = times[at : at + step] * (rows > 0)
            total += n @ self.matrix[rows]
            weight += int(n.sum())
        if not weight:
            return (self.model.usual if any(map(str.isalpha, text)) else UNDETERMINED), 0.0, 0.0
        mean = total / weight
        best = int(mean.argmin())
        score = float(1 / np.exp((mean[best] - mean) * np.log(10)).sum())
        return self.model.languages[best], score, weight / sum(counts.values())

    def knows(self, text: str | None) -> bool:
        """Whether a text is in a language that was learned: its language leads by more than chance would have it,
        however many were learned, and most of its words are made of letters that any of them has."""
        lang, score, share = self.assess(text)
        learned = len(self.model.languages)
        return lang != UNDETERMINED and share >= LEAST_SHARE and score >= (least_score(learned) if learned > 1 else 0)


# Times the score that chance gives to a language, and the share of words with evidence, below which a text is in none of
# the languages that were learned; and that score for four languages.
ABOVE_CHANCE, LEAST_SHARE = 1.2, 0.5


def least_score(languages: int) -> float:
    return ABOVE_CHANCE / languages


LEAST_SCORE = least_score(4)


def _scorer(name: str, model: Broadcast) -> Scorer:
    """One scorer per worker process, so that tasks share what it remembers."""
    return memo((Scorer, name), lambda: Scorer(model.value))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred and score per document.

    A text that is null or has no letter is ``und`` with score 0, as is every text where nothing was learned.
    Letters without any evidence give the usual language with score 0. Repeated rows are predicted each. The
    model has a bounded size and is sent to the tasks.
    """
    shared, name = docs.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex
    schema = T.StructType(
        [
            T.StructField("doc_id", T.LongType()),
            T.StructField("held_out", T.BooleanType()),
            T.StructField("lang_pred", T.StringType()),
            T.StructField("score", T.DoubleType()),
        ]
    )

    def rule(keys: list, held: list, texts: list) -> Iterator[tuple]:
        scorer = _scorer(name, shared)
        for doc_id, out, text in zip(keys, held, texts):
            yield doc_id, out, *scorer.predict(text)

    rows = docs.select("doc_id", held_out().alias("_held_out"), "text")
    return map_rows(rows, ("doc_id", "_held_out", "text"), rule, schema)


def identify(docs: DataFrame) -> DataFrame:
    return predict(docs, fit(docs))


def in_known_languages(docs: DataFrame) -> DataFrame:
    """Documents whose language is determined, with all their columns; undetermined and unsure ones go."""
    shared, name = docs.sparkSession.sparkContext.broadcast(fit(docs)), uuid.uuid4().hex

    def change(batch: pa.RecordBatch) -> pa.RecordBatch:
        scorer = _scorer(name, shared)
        return batch.filter(pa.array(map(scorer.knows, batch.column("text").to_pylist()), pa.bool_()))

    return map_batches(docs, change)
