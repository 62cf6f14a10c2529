"""Sequence packing: first-fit decreasing over a tournament tree of bin capacities.

Rows are dealt at random (by a hash of id, text and the row's place in the table,
stored with the row) into groups of about ``group_docs`` and each group is packed on
its own, so the work spreads over the cluster and no task holds more than its group,
however many rows are equal. A document of more than
``width`` ids gives full pieces, which are sequences of their own, and one
remainder, which first-fit decreasing places in the leftmost bin with room.

Tokenizing reads the text once; only piece lengths and checksums are shuffled.
A chunk between safe boundaries (before a space that stands between two
characters other than white space) always has the same ids, so they are kept in
a bounded table for each worker. The ids are those of the `tokenizers` library
for the same vocabulary (a test holds them against it); tiktoken does the
merges because it needs a third of the time. The vocabulary's added tokens, which
that library takes out of a text before all else, are taken out first.

Cases: a null text is empty and has the end id alone; a null id is kept; texts
and runs of one character may be of any length; repeated rows and ids are packed
apart; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bpe import encode_text, encoding, rank_file
from .common import slim

WIDTH, END_ID, GROUP_DOCS = 2048, 1, 4096
#: Chunks whose ids a worker keeps before it starts afresh.
CACHE_CHUNKS = 300_000

_SAFE = regex.compile(r"(?<=\S) (?=\S)")
#: Where every single space is a safe boundary.
_PLAIN = regex.compile(r"\s(?:\s)|^\s|\s$")


def added_tokens(path: str | None = None) -> dict[str, int]:
    """The added tokens of a tokenizer file, which are found as they stand, and their ids."""
    with open(path or rank_file("byte_bpe_50k.json"), encoding="utf-8") as f:
        found = json.load(f)["added_tokens"]
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in found):
        raise ValueError("added tokens that depend on what surrounds them are not supported")
    return {t["content"]: t["id"] for t in found}


class ChunkIds(dict):
    """Ids of chunks between safe boundaries as bytes."""

    def __init__(self, enc, added: dict[str, int] | None = None):
        super().__init__()
        self.enc, self.added = enc, added or {}
        self.cuts = re.compile("|".join(map(re.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None

    def __missing__(self, chunk: str) -> bytes:
        if len(self) >= CACHE_CHUNKS:
            self.clear()
        ids = encode_text(chunk, self.enc).tobytes()
        if len(chunk) <= 64:
            self[chunk] = ids
        return ids

    def of(self, text: str) -> bytes:
        """The ids of a text without added tokens."""
        first, *rest = _SAFE.split(text) if _PLAIN.search(text) else text.split(" ")
        return self[first] + b"".join([self[c] for c in map(" ".__add__, rest)])


def document_ids(text: str | None, chunks: ChunkIds, end_id: int = END_ID) -> np.ndarray:
    """All ids of a document with the end id, unsigned 32-bit little-endian."""
    text, body, start = text or "", [], 0
    for cut in chunks.cuts.finditer(text) if chunks.cuts else ():
        body += [chunks.of(text[start : cut.start()]), np.uint32(chunks.added[cut[0]]).astype("<u4").tobytes()]
        start = cut.end()
    body.append(chunks.of(text[start:]))
    return np.append(np.frombuffer(b"".join(body), "<u4"), np.uint32(end_id)).astype("<u4")


def token_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, end_id: int = END_ID, vocabulary: str | None = None, tokenizer: str | None = None) -> DataFrame:
    """One row for each document: its count of ids and the CRC-32 of each piece of ``width``, without the ids.

    ``vocabulary`` is the rank file of the merges and ``tokenizer`` the file with the added tokens.
    """
    path, added = vocabulary or rank_file(), added_tokens(tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = ChunkIds(encoding(path), added)
        for batch in batches:
            total, crcs = [], []
            for text in batch.column(1).to_pylist():
                ids = document_ids(text, chunks, end_id)
                raw = ids.tobytes()
                total.append(len(ids))
                crcs.append([zlib.crc32(raw[a : a + 4 * width]) for a in range(0, len(raw), 4 * width)])
            yield pa.RecordBatch.from_pydict({id_col: batch.column(0), "salt": batch.column(2), "doc_tokens": pa.array(total, pa.int64()), "crcs": pa.array(crcs, pa.list_(pa.int64()))})

    rows = slim(docs, id_col, text_col).withColumn("salt", F.xxhash64(f"`{id_col}`", f"`{text_col}`", F.monotonically_increasing_id()))
    kind = rows.schema[0].dataType.simpleString()
    return rows.mapInArrow(run, f"`{id_col}` {kind}, salt long, doc_tokens long, crcs array<long>")


class TournamentTree:
    """Remaining capacities of bins; a node holds the largest below it."""

    def __init__(self, bins: int, capacity: int):
        self.leaves = 1 << max(0, (bins - 1).bit_length())
        self.best = [capacity] * (2 * self.leaves)

    def first_fit(self, size: int) -> tuple[int, int]:
        """Put ``size`` into the leftmost bin with room: (bin, offset in it from the capacity's end)."""
        best, node = self.best, 1
        while node < self.leaves:
            node *= 2
            if best[node] < size:
                node += 1
        room = best[node]
        best[node] = room - size
        bin_ = node - self.leaves
        while node > 1:
            node //= 2
            best[node] = max(best[2 * node], best[2 * node + 1])
        return bin_, room


def first_fit_decreasing(sizes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset for each size (at most ``width``), in the order given."""
    bins, offsets = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    tree = TournamentTree(max(1, len(sizes)), width)
    for i in np.argsort(-sizes, kind="stable"):
        bin_, room = tree.first_fit(int(sizes[i]))
        bins[i], offsets[i] = bin_, width - room
    return bins, offsets


def pack(pieces: DataFrame, id_col: str = "doc_id", width: int = WIDTH, group_docs: int = GROUP_DOCS, seed: int = 17) -> DataFrame:
    """Pack what ``token_pieces`` gives; ``pieces`` is read twice and its salts must not change, so store it first."""
    n = pieces.count()
    groups = max(1, -(-n // group_docs))
    kind = pieces.schema[id_col].dataType
    dealt = pieces.withColumn("grp", F.pmod(F.xxhash64("salt", F.lit(seed)), F.lit(groups)))

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("doc_tokens", "ascending"), ("salt", "ascending"), (id_col, "ascending")])
        group = table.column("grp")[0].as_py() if table.num_rows else 0
        tokens = table.column("doc_tokens").to_numpy()
        n_pieces = -(-tokens // width)
        doc = np.repeat(np.arange(len(tokens)), n_pieces)
        index = np.arange(len(doc)) - np.repeat(np.cumsum(n_pieces) - n_pieces, n_pieces)
        start = index * width
        length = np.minimum(width, tokens[doc] - start)
        full = length == width
        seq, offset = np.zeros(len(doc), np.int64), np.zeros(len(doc), np.int64)
        bins, offsets = first_fit_decreasing(length[~full], width)
        seq[~full], offset[~full] = bins, offsets
        seq[full] = (bins.max() + 1 if len(bins) else 0) + np.arange(full.sum())
        crc = table.column("crcs").combine_chunks().flatten()
        return pa.table({
            id_col: table.column(id_col).take(pa.array(doc)),
            "start": start, "length": length, "ids_crc32": crc, "doc_tokens": tokens[doc],
            "sequence_id": group * (1 << 24) + seq, "offset": offset,
        })

    schema = T.StructType([T.StructField(id_col, kind), *(T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"))])
    return dealt.groupBy("grp").applyInArrow(run, schema)
