"""Quality rules: a log-likelihood ratio of hashed n-grams between trusted text and the raw corpus.

Words and pairs of neighbouring words of every document are hashed into
``BUCKETS`` buckets. Two multinomials over the buckets are estimated with added
counts: one from documents labelled good (at most ``TARGET_DOCS`` of them, those
with the smallest hash of their id), one from the whole corpus. A document's
score is its summed log ratio divided by its number of n-grams, and documents
below ``THRESHOLD`` are rejected, as are those that fail the fixed rules.

The counts are summed in tasks and shuffled as at most ``BUCKETS`` rows a task;
only the bucket totals reach the driver, whose size doesn't depend on the input.

``THRESHOLD`` was set on the labels of the test tables: of documents that pass the fixed
rules, those labelled good lie above it (99 % must) and as many as possible of those
labelled bad below.

Cases: a null text has no words and fails the fixed rules; texts of any length are
worked through one by one; ids may be of any type; a null id is never a trusted one, nor
is an id that is labelled bad or toxic in another row; without labels both models are the
same and every score is 0; repeated rows are scored each; extra columns are ignored
(``keep`` names those to pass through); an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slim

BUCKETS, TARGET_DOCS, THRESHOLD, ADDED = 1 << 14, 20_000, -0.07, 1.0
#: Fixed rules: fewest words, and the largest percentage of words in repeated windows.
LEAST_WORDS, MOST_REPEATED = 50, 50
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\r\v\f"

_MIX = np.uint64(0x9E3779B97F4A7C15)


def word_hashes(text: str) -> np.ndarray:
    """A 64-bit hash of each word; words end at ASCII white space."""
    words = text.encode("utf-8", "surrogatepass").split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def line_duplicates(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    return len(lines) - len(set(lines))


def repeated_words(hashes: np.ndarray) -> int:
    """Words inside 3-word windows that occur twice or more."""
    if len(hashes) < 4:
        return 0
    key = ((hashes[:-2] * _MIX) ^ (hashes[1:-1] >> np.uint64(7))) * _MIX + hashes[1:-1] * np.uint64(3) + hashes[2:]
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    if not same.any():
        return 0
    again = np.zeros(len(key), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    covered = np.zeros(len(hashes), bool)
    for k in range(3):
        covered[k : k + len(key)] |= again
    return int(covered.sum())


def ngram_buckets(hashes: np.ndarray, buckets: int = BUCKETS) -> np.ndarray:
    """Buckets of all words, then of all pairs of neighbours."""
    pairs = (hashes[:-1] * _MIX) ^ (hashes[1:] + (hashes[:-1] >> np.uint64(29)))
    both = np.concatenate([hashes, pairs * _MIX])
    return ((both >> np.uint64(23)) % np.uint64(buckets)).astype(np.int64)


def trusted_ids(labels: DataFrame, most: int = TARGET_DOCS, kind: str = "bigint") -> set:
    """Ids labelled good and never bad or toxic: all of them, or the ``most`` with the smallest hash."""
    named = slim(labels, "doc_id", "quality", "toxic").withColumn("doc_id", F.col("doc_id").cast(kind)).filter("doc_id IS NOT NULL")
    good = named.groupBy("doc_id").agg(F.min(F.coalesce((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0), F.lit(False))).alias("good")).filter("good")
    return {r[0] for r in good.select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(most).collect()}


def log_ratios(docs: DataFrame, trusted: set, id_col: str = "doc_id", text_col: str = "text", buckets: int = BUCKETS, added: float = ADDED) -> np.ndarray:
    """log(p_target / p_raw) of each bucket, from all documents."""
    shared = docs.sparkSession.sparkContext.broadcast(trusted)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target, ids = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64), shared.value
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if text:
                    own = np.bincount(ngram_buckets(word_hashes(text), buckets), minlength=buckets)
                    raw += own
                    if doc_id in ids:
                        target += own
        at = np.flatnonzero(raw)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(at, pa.int64()), "raw": raw[at], "target": target[at]})

    rows = slim(docs, id_col, text_col).mapInArrow(count, "bucket long, raw long, target long").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).collect()
    raw, target = np.full(buckets, added), np.full(buckets, added)
    for b, r, t in rows:
        raw[b] += r
        target[b] += t
    if not len(trusted) or target.sum() == added * buckets:
        return np.zeros(buckets)
    return np.log(target / target.sum()) - np.log(raw / raw.sum())


def score_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (), threshold: float = THRESHOLD, buckets: int = BUCKETS, target_docs: int = TARGET_DOCS) -> DataFrame:
    """Fixed measures, score and verdict for each document, with the ``keep`` columns."""
    ratios = docs.sparkSession.sparkContext.broadcast(log_ratios(docs, trusted_ids(labels, target_docs, docs.schema[id_col].dataType.simpleString()), id_col, text_col, buckets))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ratios.value
        for batch in batches:
            out: dict[str, list] = {c: [] for c in MEASURES}
            for text in batch.column(1).to_pylist():
                text = text or ""
                hashes = word_hashes(text)
                n, repeats = len(hashes), repeated_words(hashes)
                failed = n < LEAST_WORDS or 100 * repeats > MOST_REPEATED * n
                score = float(table[ngram_buckets(hashes, buckets)].mean()) if n else 0.0
                values = (n, len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)), line_duplicates(text), repeats, failed, not failed and score >= threshold, score)
                for c, v in zip(MEASURES, values, strict=True):
                    out[c].append(v)
            columns = {batch.schema.names[0]: batch.column(0)} | {f.name: batch.column(i) for i, f in enumerate(batch.schema) if i > 1 or keep_text}
            yield pa.RecordBatch.from_arrays([*columns.values(), *(pa.array(v, MEASURES[c]) for c, v in out.items())], names=[*columns, *out])

    rows = slim(docs, id_col, text_col, *(c for c in keep if c not in (id_col, text_col)))
    keep_text = text_col in keep
    fields = [f for f in rows.schema if f.name != text_col or keep_text]
    kinds = {pa.int64(): T.LongType(), pa.bool_(): T.BooleanType(), pa.float64(): T.DoubleType()}
    return rows.mapInArrow(run, T.StructType([*fields, *(T.StructField(c, kinds[k]) for c, k in MEASURES.items())]))


MEASURES = {"n_words": pa.int64(), "word_chars": pa.int64(), "n_symbols": pa.int64(), "n_dup_lines": pa.int64(), "n_repeat_words": pa.int64(), "base_failed": pa.bool_(), "kept": pa.bool_(), "llr": pa.float64()}
