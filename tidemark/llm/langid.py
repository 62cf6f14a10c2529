"""Language identification by words first, then by shorter and shorter character n-grams.

The model holds each language's log frequency of its most frequent words and of the
n-grams (one to five letters, words with a blank at either end) of all its words. A
known word scores by its frequency in each language, an unseen one by the mean over its
longest n-grams that are known, and a language without the word or n-gram gets one
penalty for all languages. A text's score in a language is the mean over its words; the
best language wins, and ``score`` is its share when the means are turned to odds.

All words of all training texts are counted: in tasks first, then summed; n-grams are
counted from distinct words rather than from texts. The model that is sent to the tasks
keeps ``MODEL_WORDS`` words and ``MODEL_GRAMS`` n-grams, split evenly among the languages
and the most frequent first, so it is bounded whatever the corpus: a word has
``LONGEST`` letters at most (longer runs are always scored by n-grams, whole). What is cut is found by
salted ranks, so no task ranks a language's whole vocabulary.

Cases: a null text, or one without letters, is ``und`` with score 0; texts of any length
are read whole; a null id is neither held out nor learned from; rows without a language
aren't learned from; repeated rows count each; on ties the language with more training words wins,
then the smaller name; where no language is learned, all is ``und``; extra columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, slim

UNKNOWN = "und"
WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")
#: The same for texts below U+0300, where letters are a short list and there are no marks: several times faster.
HIGH, LATIN = re.compile("[\u0300-\U0010ffff]"), re.compile("[A-Za-zªµºÀ-ÖØ-öø-ˁˆ-ˑˠ-ˤˬˮ]+")
#: Longest n-gram, longest word of the model, and the bounds of the model over all languages.
MOST_LETTERS, LONGEST, MODEL_WORDS, MODEL_GRAMS = 5, 40, 200_000, 200_000
#: Documents whose checksum leaves ``HELD_OUT`` when divided by ``FOLDS`` are not learned from.
FOLDS, HELD_OUT = 4, 2
#: Distinct words a task counts, or remembers scores of, before it starts anew; tasks that share the ranking of a language.
FLUSH, SALTS = 200_000, 64


def words_of(text: str) -> list[str]:
    text = text.lower()
    return (WORD if HIGH.search(text) else LATIN).findall(text)


def grams_of(word: str, n: int) -> list[str]:
    """N-grams of a word with a blank at either end; a blank alone is none."""
    padded = f" {word} "
    return [g for i in range(len(padded) - n + 1) if (g := padded[i : i + n]) != " "]


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(f"`{doc_id}`").cast("string")) % FOLDS == HELD_OUT, F.lit(False))


def count_words(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, kind, piece, n): words of at most ``LONGEST`` letters as ``w``; the n-grams of longer ones as ``g``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()

        def out() -> pa.RecordBatch:
            langs, kinds, pieces = zip(*found, strict=True) if found else ((), (), ())
            return pa.RecordBatch.from_pydict({"lang": pa.array(langs, pa.string()), "kind": pa.array(kinds, pa.string()), "piece": pa.array(pieces, pa.string()), "n": pa.array(found.values(), pa.int64())})

        for batch in batches:
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for word, n in Counter(words_of(text or "")).items():
                    if len(word) <= LONGEST:
                        found[lang, "w", word] += n
                    else:
                        for k in range(1, MOST_LETTERS + 1):
                            for gram, m in Counter(grams_of(word, k)).items():
                                found[lang, "g", gram] += n * m
                if len(found) >= FLUSH:
                    yield out()
                    found.clear()
        yield out()

    rows = slim(docs, text_col, lang_col).select(F.col(text_col), F.col(lang_col).cast("string"))
    return rows.filter(F.col(lang_col).isNotNull()).mapInArrow(count, "lang string, kind string, piece string, n long").groupBy("lang", "kind", "piece").agg(F.sum("n").alias("n"))


def count_grams(counted: DataFrame) -> DataFrame:
    """(lang, piece, n) of the n-grams of all words."""
    padded = F.concat(F.lit(" "), "piece", F.lit(" "))
    each = F.flatten(F.transform(F.sequence(F.lit(1), F.lit(MOST_LETTERS)), lambda k: F.when(F.length(padded) >= k, F.transform(F.sequence(F.lit(1), F.length(padded) - k + 1), lambda i: F.substring(padded, i, k))).otherwise(F.array().cast("array<string>"))))
    of_words = counted.filter("kind = 'w'").select("lang", F.explode(each).alias("piece"), "n").filter("piece <> ' '")
    return of_words.unionByName(counted.filter("kind = 'g'").select("lang", "piece", "n")).groupBy("lang", "piece").agg(F.sum("n").alias("n"))


def most_frequent(counted: DataFrame, each: int) -> DataFrame:
    """The ``each`` most frequent pieces of every language; ties go to the smaller piece."""
    order = [F.col("n").desc(), F.col("piece")]
    some = counted.withColumn("salt", F.pmod(F.xxhash64("piece"), F.lit(SALTS)))
    first = some.withColumn("at", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).filter(F.col("at") <= each)
    return first.withColumn("at", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("at") <= each).select("lang", "piece", "n")


@dataclass
class Model:
    """Log10 frequencies: a row of ``word_rows`` (``gram_rows``) for each word (n-gram), a column for each language."""

    langs: list[str]
    words: dict[str, int]
    word_rows: np.ndarray
    grams: dict[str, int]
    gram_rows: np.ndarray

    def known_grams(self, word: str) -> list[int]:
        """Rows of a word's longest n-grams that any language knows; none if it knows none."""
        padded, get = f" {word} ", self.grams.get
        for n in range(min(MOST_LETTERS, len(padded)), 0, -1):
            found = [at for i in range(len(padded) - n + 1) if (at := get(padded[i : i + n])) is not None]
            if found:
                return found
        return []

    def unseen(self, words: list[str]) -> np.ndarray:
        """A row for each word: the mean over its known n-grams; nothing known says nothing."""
        out = np.zeros((len(words), len(self.langs)))
        found = [self.known_grams(w) for w in words]
        sizes = np.array([len(x) for x in found])
        some = np.flatnonzero(sizes)
        if len(some):
            rows = self.gram_rows[[at for x in found for at in x]]
            out[some] = np.add.reduceat(rows, np.cumsum(sizes[some]) - sizes[some]) / sizes[some, None]
        return out

    def predict(self, text: str, remembered: Remembered) -> tuple[str, float]:
        """The language and its share; ``remembered`` keeps rows of unseen words between texts."""
        counts = Counter(words_of(text))
        if not counts or not self.langs:
            return UNKNOWN, 0.0
        places = list(map(self.words.get, counts))
        total = np.zeros(len(self.langs))
        known = [(at, n) for at, n in zip(places, counts.values(), strict=True) if at is not None]
        if known:
            rows, weights = zip(*known, strict=True)
            total += np.array(weights, float) @ self.word_rows[list(rows)]
        if len(known) < len(counts):
            total += remembered.total(self, counts, [w for w, at in zip(counts, places, strict=True) if at is None])
        mean = total / counts.total()
        best = int(mean.argmax())
        return self.langs[best], float(1 / np.power(10.0, mean - mean[best]).sum())


class Remembered:
    """Rows of unseen words that a task has met, at most ``FLUSH`` before it starts anew; long runs aren't kept."""

    def __init__(self):
        self.places: dict[str, int] = {}
        self.table: np.ndarray | None = None

    def total(self, model: Model, counts: Counter, words: list[str]) -> np.ndarray:
        """The sum of the words' rows, each as often as it is counted."""
        long = [w for w in words if len(w) > LONGEST]
        out = np.array([counts[w] for w in long], float) @ model.unseen(long)
        words = [w for w in words if len(w) <= LONGEST] if long else words
        if len(self.places) + len(words) > FLUSH:
            self.places.clear()
        new = [w for w in words if w not in self.places]
        start, end = len(self.places), len(self.places) + len(new)
        if self.table is None or end > len(self.table):
            grown = np.zeros((2 * end, len(model.langs)))
            if start:
                grown[:start] = self.table[:start]
            self.table = grown
        self.table[start:end] = model.unseen(new)
        self.places.update(zip(new, range(start, end), strict=True))
        return out + np.array([counts[w] for w in words], float) @ self.table[[self.places[w] for w in words]]


def _rows(table: dict[tuple[str, str], int], langs: list[str]) -> tuple[dict[str, int], np.ndarray]:
    pieces = {p: k for k, p in enumerate(sorted({p for _, p in table}))}
    totals = np.zeros(len(langs))
    column = {lang: k for k, lang in enumerate(langs)}
    counts = np.zeros((len(pieces), len(langs)))
    for (lang, piece), n in table.items():
        counts[pieces[piece], column[lang]] = n
        totals[column[lang]] += n
    # the penalty lies below what a single occurrence in the largest language is worth
    return pieces, np.log10(np.where(counts > 0, counts, 0.5 * totals / max(totals.max(initial=1), 1)) / np.maximum(totals, 1))


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", words: int = MODEL_WORDS, grams: int = MODEL_GRAMS) -> Model:
    """The model of labelled texts. The driver gets its bounded tables and one row a language."""
    with Scratch(docs.sparkSession) as scratch:
        counted = scratch.stored(count_words(docs, text_col, lang_col), "lang-words")
        sizes = counted.groupBy("lang").agg(F.sum("n").alias("n")).collect()
        langs = [r["lang"] for r in sorted(sizes, key=lambda r: (-r["n"], r["lang"]))]
        table = lambda rows, most: {(r["lang"], r["piece"]): r["n"] for r in most_frequent(rows, max(1, most // max(1, len(langs)))).toLocalIterator()}
        known_words = table(counted.filter("kind = 'w'").select("lang", "piece", "n"), words)
        known_grams = table(count_grams(counted), grams)
    return Model(langs, *_rows(known_words, langs), *_rows(known_grams, langs))


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) of each document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, remembered = shared.value, Remembered()
        for batch in batches:
            found = [own.predict(text or "", remembered) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x for x, _ in found], pa.string()), pa.array([x for _, x in found], pa.float64())], names=[id_col, "lang_pred", "score"])

    rows = slim(docs, id_col, text_col)
    return rows.mapInArrow(run, f"`{id_col}` {rows.schema[id_col].dataType.simpleString()}, lang_pred string, score double")


def identify(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score): learned from the documents that are not held out, predicted for all."""
    learned = docs.filter(F.col("doc_id").isNotNull() & ~held_out())
    return predict(docs, fit(learned)).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
