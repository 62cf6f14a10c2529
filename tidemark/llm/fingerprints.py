"""Fingerprints from locally consistent parsing.

A text is a sequence of names (at first its code points). Each level turns runs
of one name into a name of their own, then reduces the names by deterministic
coin tossing (twice the lowest bit position in which a name differs from the one
before it, plus that bit) until few labels remain, and starts a phrase at each
local maximum of the labels. A phrase's name is a hash of its names. Where a
phrase starts depends on a few names around it only, so equal substrings get the
same interior phrases whatever their offset. The fingerprint is a bottom-k sketch
of the phrase names of levels 2 to 4; the likeness of two is their estimated Jaccard resemblance.

Short texts have few names (one of twenty characters three to seven), so their likeness
is coarse: texts of a few words that differ in one may have any likeness down to 0.

Cases: a null text is empty; the empty text's fingerprint is the empty string,
alike (1.0) only to another empty one; equal texts have equal fingerprints; ids may be of
any type that Spark can sort; rows are ordered by (id, hash of the text) with null ids
first, so ties and repeated rows have a defined next row, and equal rows, however many,
spread over tasks; texts of any length are parsed in one piece; extra columns are ignored;
an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, slim

#: Names kept in a fingerprint; levels whose names count.
SKETCH, FIRST_LEVEL, LAST_LEVEL = 96, 2, 4
#: Characters parsed at a time.
BATCH_CHARS = 1 << 20
#: Bytes of text in a range of rows, about.
RANGE_BYTES = 8 << 20
#: Ranges at most, about: beyond so many times ``RANGE_BYTES`` ranges grow instead. Texts of a range are worked through one after another, so its size costs no memory.
MOST_RANGES = 1 << 16

_C1, _C2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
#: Odd multipliers for the places in a phrase, which has far fewer than 64 names.
_PLACES = np.array([pow(0x9E3779B97F4A7C15, k + 1, 1 << 64) for k in range(64)], np.uint64)


#: Position of the lowest set bit of each byte.
_LOW8 = np.array([8] + [(b & -b).bit_length() - 1 for b in range(1, 256)], np.uint8)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer, element by element."""
    x = (x ^ (x >> np.uint64(30))) * _C1
    x = (x ^ (x >> np.uint64(27))) * _C2
    return x ^ (x >> np.uint64(31))


def _lowest_bit(x: np.ndarray) -> np.ndarray:
    """Position of the lowest set bit of nonzero integers, from a float's exponent."""
    if x.dtype == np.uint8:
        return _LOW8[x]
    low = x & -x
    if x.dtype == np.uint32:
        return ((low.astype(np.float32).view(np.int32) >> 23) - 127).astype(np.uint8)
    return ((low.astype(np.float64).view(np.int64) >> 52) - 1023).astype(np.uint8)


def _toss(names: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One round of coin tossing against the name to the left, which a document's first name lacks."""
    differs = np.empty_like(names)
    np.bitwise_xor(names[1:], names[:-1], out=differs[1:])
    differs[first] = 1
    k = _lowest_bit(differs)
    bit = (names >> k).astype(np.uint8) & np.uint8(1)
    return (k << np.uint8(1)) | bit


def _phrases(at: np.ndarray, names: np.ndarray) -> np.ndarray:
    """A name for each phrase from its names and their places in it."""
    size = np.diff(np.append(at, len(names)))
    place = np.arange(len(names), dtype=np.int64)
    place -= np.repeat(at, size)
    value = names.astype(np.uint64)
    value += np.uint64(1)
    value *= _C1
    value ^= value >> np.uint64(29)
    value *= _PLACES[place & 63]
    return mix(np.add.reduceat(value, at) + size.astype(np.uint64))


def next_level(names: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Phrases of one level; ``at`` has where each (not empty) document's names start."""
    first = np.zeros(len(names), bool)
    first[at] = True
    run = np.empty(len(names), bool)
    run[0] = True
    np.not_equal(names[1:], names[:-1], out=run[1:])
    run |= first
    heads = np.flatnonzero(run)
    if len(heads) < len(names):  # a run of one name becomes a name
        size = np.diff(np.append(heads, len(names)))
        names, first = names[heads], first[heads]
        long = np.flatnonzero(size > 1)
        if names.dtype == np.uint32:
            names[long] = (mix(names[long] + size[long].astype(np.uint64) * _C2) >> np.uint64(32)).astype(np.uint32) | np.uint32(1 << 21)
        else:
            names[long] = mix(names[long] + size[long].astype(np.uint64) * _C2)
    labels = _toss(names, first)
    for _ in range(3):  # at most 128 labels, then 14, 8 and 6; neighbours stay different
        labels = _toss(labels, first)
    # local maxima, apart from a document's second name: its first one starts a phrase anyway
    starts = np.zeros(len(names), bool)
    np.greater(labels[1:], labels[:-1], out=starts[1:])
    starts[1:-1] &= (labels[1:-1] > labels[2:]) | first[2:]
    starts[1:] &= ~first[:-1]
    starts |= first
    begin = np.flatnonzero(starts)
    return _phrases(begin, names), np.flatnonzero(first[begin])


def sketches(texts: list[str], size: int = SKETCH) -> list[np.ndarray]:
    """The bottom-k sketch of each text's phrase names, sorted."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    out = [np.empty(0, np.uint64)] * len(texts)
    full = np.flatnonzero(lengths)
    if not len(full):
        return out
    names = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4").copy()
    at = (np.cumsum(lengths) - lengths)[full]
    kept: list[tuple[np.ndarray, np.ndarray]] = []
    for level in range(1, LAST_LEVEL + 1):
        names, at = next_level(names, at)
        if level >= FIRST_LEVEL:
            kept.append((mix(names), np.append(at, len(names))))
    for k, i in enumerate(full):
        out[i] = np.unique(np.concatenate([n[bounds[k] : bounds[k + 1]] for n, bounds in kept]))[:size]
    return out


def encode(sketch: np.ndarray) -> str:
    """The fingerprint as a string: hexadecimal of each kept name, smallest first."""
    return sketch.astype(">u8").tobytes().hex()


def decode(fingerprint: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(fingerprint), ">u8").astype(np.uint64)


def likeness(a: np.ndarray, b: np.ndarray, size: int = SKETCH) -> float:
    """Estimated Jaccard resemblance of two sketches, from 0 to 1."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = np.sort(np.concatenate([a, b]))
    same = both[1:][both[1:] == both[:-1]]
    union = len(both) - len(same)
    if union <= size or len(a) < size and len(b) < size:
        return len(same) / union
    bound = np.unique(both)[size - 1]
    return float(np.count_nonzero(same <= bound)) / size


def edited(text: str, following: str) -> str:
    """``text`` whose last floor(n/2) code points give way to the first as many of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _chunks(pairs: Iterator[tuple]) -> Iterator[list[tuple]]:
    held, chars = [], 0
    for pair in pairs:
        held.append(pair)
        chars += len(pair[1])
        if chars >= BATCH_CHARS:
            yield held
            held, chars = [], 0
    if held:
        yield held


def _key(row_id: object, text_hash: int, number: int) -> tuple:
    """Sorts as the rows do: null ids first, then id, hash of the text and number of the row."""
    return (row_id is not None, row_id, text_hash, number) if row_id is not None else (False, 0, text_hash, number)


def range_starts(rows: DataFrame, range_bytes: int, most: int = MOST_RANGES) -> list[tuple]:
    """Keys of the first row of each range of about ``range_bytes``, from (id, hash, number, bytes).

    Only narrow rows are sorted. A key for each range reaches the driver and all tasks: at
    most about ``MOST_RANGES``, since ranges are larger where there would be more.
    """
    with Scratch(rows.sparkSession) as scratch:
        narrow = scratch.stored(rows.select("id", "hash", "number", (F.octet_length("text") + 64).alias("bytes")), "keys")
        total = narrow.agg(F.sum("bytes")).first()[0] or 0
        range_bytes = max(range_bytes, -(-total // most))
        ranged = narrow.repartitionByRange(max(1, -(-total // (8 * range_bytes))), F.col("id").asc_nulls_first(), "hash", "number")

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = range_bytes
            for batch in batches:
                ends = np.cumsum(batch.column(3).to_numpy()) + held
                before, at = ends - batch.column(3).to_numpy(), []
                while (i := int(np.searchsorted(before, range_bytes))) < len(ends):
                    at.append(i)
                    ends, before = ends - before[i], before - before[i]
                held = int(ends[-1]) if len(ends) else held
                yield batch.take(pa.array(at, pa.int64())).select([0, 1, 2])

        starts = ranged.sortWithinPartitions(F.col("id").asc_nulls_first(), "hash", "number").mapInArrow(cut, narrow.select("id", "hash", "number").schema)
        return sorted(_key(*r) for r in starts.collect())


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Fingerprint every text and its edited text, and compare with both it and the next row.

    Rows are dealt into ranges of their order, of about ``range_bytes`` each; a range also
    gets the first row of the one after it and is worked through in order, so the text is
    shuffled once.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = slim(docs, id_col, text_col).select(F.col(f"`{id_col}`").alias("id"), text.alias("text")).withColumns({"hash": F.xxhash64("text"), "number": F.monotonically_increasing_id()})
    kind = rows.schema["id"].dataType.simpleString()
    starts = range_starts(rows, range_bytes) or [_key(None, 0, 0)]
    shared = rows.sparkSession.sparkContext.broadcast(starts)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each row with its range, and again, as its head, with the range before one that begins with such a row."""
        keys, sent = shared.value, set()
        heads: dict[tuple, list[int]] = {}
        for i, key in enumerate(keys):
            heads.setdefault(key[:3], []).append(i)
        for batch in batches:
            at, range_of, head = [], [], []
            for i, (row_id, text_hash, number) in enumerate(zip(*(batch.column(k).to_pylist() for k in (0, 2, 3)), strict=True)):
                key = _key(row_id, text_hash, number)
                at.append(i)
                range_of.append(max(0, bisect_right(keys, key) - 1))
                head.append(False)
                # equal rows have equal texts, so one of them for each task will do
                if key[:3] in heads and key[:3] not in sent:
                    sent.add(key[:3])
                    for k in heads[key[:3]]:
                        at.append(i)
                        range_of.append((k - 1) % len(keys))
                        head.append(True)
            rows_of = batch.take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(range_of, pa.int32()), pa.array(head, pa.bool_()), *rows_of.columns], names=["range", "head", "id", "text", "hash", "number"])

    def with_next(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        """(id, text, next text); a range's rows come in order, then its head row."""
        held = place = None
        for batch in batches:
            for b, is_head, i, t in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                if b != place:
                    place, held = b, None
                if held is not None:
                    yield *held, t
                held = None if is_head else (i, t)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is None:
            return
        arrow_kind = first.column(2).type
        for chunk in _chunks(with_next(chain([first], batches))):
            ids, texts, nexts = zip(*chunk, strict=True)
            changed = [edited(t, n) for t, n in zip(texts, nexts, strict=True)]
            own, other = sketches([*texts]), sketches(changed)
            # the next row is usually the next of the chunk
            odd = [i for i in range(len(texts)) if i + 1 == len(texts) or texts[i + 1] is not nexts[i]]
            spare = dict(zip(odd, sketches([nexts[i] for i in odd]), strict=True))
            following = [spare.get(i) if i in spare else own[i + 1] for i in range(len(texts))]
            yield pa.RecordBatch.from_pydict({
                "id": pa.array(ids, arrow_kind), "n_chars": pa.array(map(len, texts), pa.int64()),
                "edited_sha256": [hashlib.sha256(t.encode()).hexdigest() for t in changed],
                "fingerprint": [encode(s) for s in own], "edited_fingerprint": [encode(s) for s in other],
                "near_edited": [likeness(a, b) for a, b in zip(own, other, strict=True)],
                "near_next": [likeness(a, b) for a, b in zip(own, following, strict=True)],
            })

    schema = f"id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    dealt = rows.mapInArrow(deal, f"range int, head boolean, id {kind}, text string, hash long, number long").repartitionById(len(starts), "range")
    ordered = dealt.sortWithinPartitions("range", "head", F.col("id").asc_nulls_first(), "hash", "number").select("range", "head", "id", "text")
    return ordered.mapInArrow(run, schema).withColumnRenamed("id", id_col)
