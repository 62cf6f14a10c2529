"""Byte-level BPE by the tiktoken library from a local rank file.

``encode_documents`` encodes whole texts; long ones are first cut at safe
boundaries: before the last white-space character of a run that other text
follows. The pre-split pattern never matches across such a place, so the ids are
those of the uncut text. The rest of a run is one match, so a run of more than
``LONG_RUN`` is merged as such: the library's pattern matcher recurses over it and
would overflow its stack.

Cases: a null text counts as empty and has no ids; texts and runs of any one
character may be of any length; repeated rows give repeated results; a null id
stays null; extra columns are ignored; an empty table gives an empty result. A
``pattern`` of one's own must treat white space as the standard one does.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import slim

#: Texts beyond so many characters are encoded piece by piece.
PIECE_CHARS = 1 << 16

#: White space in a row beyond so many characters is merged without the pattern.
LONG_RUN = 4096

_SAFE = regex.compile(r"\s(?=\S)")
_RUN = regex.compile(rf"\s{{{LONG_RUN},}}+")
_ENCODINGS: dict = {}


def rank_file(name: str = "byte_bpe_50k.tiktoken") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def encoding(path: str, pattern: str | None = None):
    """The tiktoken encoding of a local rank file, without special tokens."""
    import public_tokenizers
    import tiktoken

    pattern = pattern or public_tokenizers.PATTERN
    if (path, pattern) not in _ENCODINGS:
        with open(path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        _ENCODINGS[path, pattern] = tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _ENCODINGS[path, pattern]


def long_runs(text: str) -> Iterator[tuple[str, bool]]:
    """``text`` in parts, where True marks a long run of white space (without its last character if text follows)."""
    start = 0
    for run in _RUN.finditer(text) if len(text) >= LONG_RUN else ():
        end = run.end() - (run.end() < len(text))
        yield text[start : run.start()], False
        yield text[run.start() : end], True
        start = end
    yield text[start:], False


def safe_pieces(text: str, piece_chars: int = PIECE_CHARS) -> Iterator[str]:
    """Cut ``text`` at safe boundaries into pieces of about ``piece_chars``."""
    start = 0
    while len(text) - start > piece_chars:
        cut = _SAFE.search(text, start + piece_chars)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


def encode_text(text: str | None, enc, piece_chars: int = PIECE_CHARS) -> np.ndarray:
    """Ids of a whole text as little-endian unsigned 32-bit integers."""
    text = text or ""
    if len(text) <= min(piece_chars, LONG_RUN):
        return np.array(enc.encode_ordinary(text), "<u4")
    ids = []
    for part, is_run in long_runs(text):
        ids += [enc._encode_single_piece(part)] if is_run else map(enc.encode_ordinary, safe_pieces(part, piece_chars))
    return np.concatenate([np.array(x, "<u4") for x in ids])


def decode_ids(ids: np.ndarray, enc) -> bytes:
    """The raw bytes of ids, which need not be valid UTF-8 on their own."""
    return enc.decode_bytes(ids.tolist())


def encode_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, pattern: str | None = None, piece_chars: int = PIECE_CHARS, keep_ids: bool = True) -> DataFrame:
    """Encode and decode each text: id, n_tokens, ids_sha256, decoded_sha256, and ids (array of int) if ``keep_ids``."""
    path = path or rank_file()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(path, pattern)
        for batch in batches:
            n, sha, back, kept = [], [], [], []
            for text in batch.column(1).to_pylist():
                ids = encode_text(text, enc, piece_chars)
                n.append(len(ids))
                sha.append(hashlib.sha256(ids.tobytes()).hexdigest())
                back.append(hashlib.sha256(decode_ids(ids, enc)).hexdigest())
                if keep_ids:
                    kept.append(ids.astype("i4"))
            out = {id_col: batch.column(0), "n_tokens": pa.array(n, pa.int64()), "ids_sha256": pa.array(sha, pa.string()), "decoded_sha256": pa.array(back, pa.string())}
            if keep_ids:
                out["ids"] = pa.array(kept, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_pydict(out)

    rows = slim(docs, id_col, text_col)
    schema = f"`{id_col}` {rows.schema[0].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * keep_ids
    return rows.mapInArrow(run, schema)
