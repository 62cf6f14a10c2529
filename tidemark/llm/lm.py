"""Language-model scores from a sharded Elias-Fano n-gram trie.

1. ``chunks``: each task turns its texts into chunks of about two million tokens:
   local word numbers and the words' hashes, stored once.
2. The chunks' words are counted over the corpus (a table on Spark). The ``SHORT`` most
   frequent ones get two-byte keys in what is sent later, all others keep their hash;
   that changes what a key costs and nothing else.
3. Each chunk sends its distinct words, pairs and triples (with their training counts,
   so already summed) to shards, by their first word. What would crowd a shard is
   spread: pairs of the ``HOT`` most frequent words go by both words, triples that
   begin with two of the ``HOTTEST`` words by all three; the counts of those words and
   pairs, a table of fixed size, are known to all shards. A shard merges all chunks'
   counts into a trie (see ``trie``), maps it from a file and answers each chunk's
   n-grams from it. That file lives as long as the task's answer; a task that is run
   again builds it again.
4. Chunks meet their answers and score their texts.

The model is a triple model with Dirichlet smoothing at each order:
p(w|u,v) = c(uvw)/(c(uv)+K3) + K3/(c(uv)+K3) * p(w|v), p(w|v) = (c(vw) + K2 p(w)) /
(c(v)+K2), and p(w) is the base. A text starts after a mark that is never
predicted and ends with an end token. Nothing is pruned and no order is capped:
what is gathered grows with the corpus, and a shard's size stays as it is. A chunk and a
shard share a row of what is sent only if they share an n-gram, all rows of a chunk are
cut from the same arrays; each shard is one partition, and the chunks of one partition of
the input are another, so no task grows with the corpus.

Words are told apart by 63 bits of a hash: among 10^9 different words two would share
theirs with a probability of 0.05. Rare words after a context are told apart by 47 bits:
among a million that follow the same one, two would share theirs with a probability of
0.004. Codes of probabilities are exact to 0.04 %.

Cases: a null text is empty and has the end token alone; a null id counts as held
out (its remainder is not known to differ from 0); repeated rows are learned and
scored each; texts of any length are split over no chunks but stand whole in one;
extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import tempfile
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, slim, stored_by
from .trie import Trie, coded, from_code, to_code

K2, K3 = 300.0, 8.0
#: Tokens of a chunk and tokens whose n-grams make a shard, about.
CHUNK_TOKENS, SHARD_TOKENS = 1 << 21, 2_000_000
#: Words with short keys, whose pairs are spread, and whose triples are spread.
SHORT, HOT, HOTTEST = 65_535, 1024, 128
#: Bytes of an input partition whose chunks are scored in one task, about.
SLOT_BYTES = 4 << 20
#: Buckets of chunks at most: what Spark allows by default. Beyond it a bucket has several slots, which are still scored one by one.
MOST_BUCKETS = 100_000
#: Tokens scored at a time.
SLICE = 1 << 18
#: The end token and the mark before a text; no word has a space.
END, BEGIN = b" end", b" begin"

_GOLD, _C1 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_32 = np.uint64(32)
#: A rare successor's key: 47 bits of its word's, and one that sets it apart from frequent ones.
_NEAR, _RARE = np.uint64((1 << 47) - 1), np.uint64(1 << 47)

#: What a chunk sends to a shard, by name and bytes: words (with their pairs' number), pairs (with their triples'), triples and spread triples.
SENT = {"w_key": 2, "w_far": 8, "w_count": 1, "w_count_far": 4, "runs": 1, "runs_far": 4, "p_key": 2, "p_far": 6, "p_count": 1, "p_count_far": 4, "children": 1, "children_far": 4,
    "t_key": 2, "t_far": 6, "t_count": 1, "t_count_far": 4, "h_first": 1, "h_second": 1, "h_key": 2, "h_far": 6, "h_count": 1, "h_count_far": 4}
#: What a shard answers: counts, codes and rests of words, codes of pairs and triples.
ANSWERED = {"w_counts": 8, "w_codes": 2, "w_rests": 2, "p_codes": 2, "t_codes": 2, "h_codes": 2}


class Numbers(dict):
    """Words by number, in the order of their first use."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def tokens(text: str | None) -> list[bytes]:
    """Words with A-Z lowered, which end at ASCII white space."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def is_held_out(doc_id: object, folds: int = 10) -> bool:
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % folds == 0


def planes(x: np.ndarray) -> bytes:
    """Unsigned 32-bit integers as four compressed byte planes."""
    return zstandard.ZstdCompressor(3).compress(np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes())


def from_planes(block: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(block), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(raw.T).view("<u4").ravel()


def word_key(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word) | 1 << 63


BEGIN_KEY = word_key(BEGIN)


def chunks(docs: DataFrame, id_col: str, text_col: str, each: int, chunk_tokens: int = CHUNK_TOKENS) -> DataFrame:
    """(slot, made, ids, n_tokens, held_out, tokens, words, train, numbers) of all texts; ``words`` are keys, with their training counts.

    A chunk is named by its slot and its number there; a partition's chunks have its slots
    in turn, of which there are ``each`` for a partition.
    """
    rows = slim(docs, id_col, text_col)
    kind = rows.schema[0].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        made, n = 0, 0
        number = Numbers({END: 0, BEGIN: 1})
        ids, lengths, held, found = [], [], [], []
        for batch in batches:
            arrow_kind = batch.schema[0].type
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = tokens(text)
                found.append(np.fromiter(map(number.__getitem__, words), np.uint32, len(words)))
                ids.append(doc_id)
                lengths.append(len(words) + 1)
                held.append(is_held_out(doc_id))
                n += lengths[-1]
                if n >= chunk_tokens:
                    yield _chunk(part, made, each, arrow_kind, ids, lengths, held, found, number)
                    made, n = made + 1, 0
                    number = Numbers({END: 0, BEGIN: 1})
                    ids, lengths, held, found = [], [], [], []
        if ids:
            yield _chunk(part, made, each, arrow_kind, ids, lengths, held, found, number)

    fields = [("slot", T.LongType()), ("made", T.LongType()), ("ids", T.ArrayType(kind)), ("n_tokens", T.ArrayType(T.LongType())), ("held_out", T.ArrayType(T.BooleanType())), ("tokens", T.LongType()), *((c, T.ArrayType(T.LongType())) for c in ("words", "train")), ("numbers", T.BinaryType())]
    return rows.mapInArrow(run, T.StructType([T.StructField(*f) for f in fields]))


def _chunk(part: int, made: int, each: int, kind: pa.DataType, ids: list, lengths: list, held: list, found: list, number: dict) -> pa.RecordBatch:
    keys = np.fromiter(map(word_key, number), np.uint64, len(number))
    trained = [x for x, h in zip(found, held, strict=True) if not h]
    train = np.bincount(np.concatenate([np.empty(0, np.uint32), *trained]), minlength=len(number))
    train[:2] = len(trained)
    longs = pa.list_(pa.int64())
    return pa.RecordBatch.from_pydict({
        "slot": pa.array([slot_of(part * each + made % each)], pa.int64()), "made": pa.array([part << 24 | made], pa.int64()), "ids": pa.array([ids], pa.list_(kind)), "n_tokens": pa.array([lengths], longs), "held_out": pa.array([held], pa.list_(pa.bool_())),
        "tokens": pa.array([sum(lengths)], pa.int64()), "words": pa.array([keys.view(np.int64)], longs), "train": pa.array([train], longs), "numbers": pa.array([planes(np.concatenate(found))], pa.binary()),
    })


def slot_of(number: int) -> int:
    """A long that Spark's hash of a column (32-bit Murmur3 with seed 42) maps to ``number``.

    So slots lie in buckets as evenly as their numbers, and every task knows its own without
    a table. Each step of the hash is undone; the long's lower half is 0.
    """
    h = _unshifted(number & _MASK, 16)
    h = _unshifted(h * pow(0xC2B2AE35, -1, 1 << 32) & _MASK, 13)
    h = _unshifted(h * pow(0x85EBCA6B, -1, 1 << 32) & _MASK, 16) ^ 8
    h = _turned((h - 0xE6546B64) * pow(5, -1, 1 << 32) & _MASK, 32 - 13) ^ (_turned(42, 13) * 5 + 0xE6546B64 & _MASK)
    high = _turned(h * pow(0x1B873593, -1, 1 << 32) & _MASK, 32 - 15) * pow(0xCC9E2D51, -1, 1 << 32) & _MASK
    return (high - (high >> 31 << 32)) << 32


_MASK = 0xFFFFFFFF


def _turned(x: int, bits: int) -> int:
    return (x << bits | x >> 32 - bits) & _MASK


def _unshifted(x: int, bits: int) -> int:
    """The number that gives ``x`` when its own upper bits are added to it."""
    out = x
    for _ in range(32 // bits):
        out = x ^ out >> bits
    return out


class Common:
    """The most frequent words: their keys by rank, and counts that every shard knows."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, hot: int = HOT, hottest: int = HOTTEST):
        self.keys, self.counts, self.hot, self.hottest = keys, counts, hot, hottest
        self.order = np.argsort(keys)
        self.sorted = keys[self.order]
        self.pair_counts = np.zeros((hottest, hottest), np.int64)

    def ranks(self, keys: np.ndarray) -> np.ndarray:
        """Rank of each key, ``SHORT`` for the others."""
        if not len(self.sorted):
            return np.full(len(keys), SHORT)
        at = np.minimum(np.searchsorted(self.sorted, keys), len(self.sorted) - 1)
        return np.where(self.sorted[at] == keys, self.order[at], SHORT)

    def context_counts(self, keys: np.ndarray) -> np.ndarray:
        """Counts of hot words, by their keys within a trie; -1 for others."""
        hot = keys < np.uint64(min(self.hot, len(self.counts)))
        out = np.full(len(keys), -1, np.int64)
        out[hot] = self.counts[keys[hot].astype(np.int64)]
        return out

    def of_pairs(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Counts of pairs of the hottest words, by their keys; -1 for others."""
        hot = (first < np.uint64(self.hottest)) & (second < np.uint64(self.hottest))
        out = np.full(len(first), -1, np.int64)
        out[hot] = self.pair_counts[first[hot].astype(np.int64), second[hot].astype(np.int64)]
        return out


def most_frequent(counted: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys and counts of the most frequent words, frequent ones first: as many whole steps of an eighth of a power of two as give no more than ``most``."""
    step = F.floor(F.log2("train") * 8).alias("step")
    least, n = None, 0
    for r in sorted(counted.groupBy(step).count().collect(), reverse=True):
        n += r["count"]
        if n > most:
            break
        least = r["step"]
    rows = [] if least is None else counted.filter(F.floor(F.log2("train") * 8) >= least).collect()
    rows.sort(key=lambda r: (-r["train"], r["words"]))
    return np.array([r["words"] for r in rows], np.int64).view(np.uint64), np.array([r["train"] for r in rows], np.int64)


def _bytes(size: str) -> int:
    """Bytes of a setting such as 128MB, 16m or 1048576b."""
    digits = size.rstrip("bBkKmMgG")
    return int(digits) << {"": 0, "b": 0, "k": 10, "m": 20, "g": 30}[size[len(digits) :][:1].lower()]


class Stream:
    """The tokens of a chunk in order, each with the one before it, as local numbers."""

    def __init__(self, numbers: np.ndarray, lengths: np.ndarray, held: np.ndarray):
        end = np.cumsum(lengths) - 1  # places of the end tokens
        self.first = end - lengths + 1
        self.now = np.zeros(int(lengths.sum()), np.int32)
        is_word = np.ones(len(self.now), bool)
        is_word[end] = False
        self.now[is_word] = numbers
        self.before = np.empty_like(self.now)
        self.before[1:] = self.now[:-1]
        self.before[self.first] = 1
        self.train = np.repeat(~held, lengths)

    def hottest_pairs(self, ranks: np.ndarray, hottest: int) -> np.ndarray:
        """Training counts of all pairs of the hottest words."""
        a, b = ranks[self.before], ranks[self.now]
        both = self.train & (a < hottest) & (b < hottest)
        return np.bincount(a[both] * hottest + b[both], minlength=hottest * hottest)


class Ngrams:
    """The distinct words, pairs and triples of a chunk, by shard and then sorted.

    A word has an entry in its own shard and, if it is hot, in each that has pairs of it.
    """

    def __init__(self, own: dict, common: Common, shards: int):
        keys = own["words"].view(np.uint64)
        ranks = common.ranks(keys)
        self.stream = s = Stream(from_planes(own["numbers"]), own["n_tokens"], own["held_out"])
        key = np.where(ranks < SHORT, ranks.astype(np.uint64), keys)
        order = np.argsort(key)
        place = np.empty(len(key), np.int32)
        place[order] = np.arange(len(key), dtype=np.int32)
        key, ranks, width = key[order], ranks[order], len(key)
        now = place[s.now].astype(np.int64)
        # pairs, by shard
        pair, of_pair = _numbered(place[s.before] * np.int64(width) + now)
        above, suc = pair // width, pair % width
        word_shard = _shard(key, shards)
        shard = np.where(ranks[above] < common.hot, _shard(key[above] ^ (key[suc] * _GOLD + _32), shards), word_shard[above])
        order = np.argsort(shard, kind="stable")
        at = np.empty(len(order), np.int32)
        at[order] = np.arange(len(order), dtype=np.int32)
        self.of_pair = at[of_pair]
        del of_pair
        above, suc, shard = above[order], suc[order], shard[order]
        p_count = np.bincount(self.of_pair[s.train], minlength=len(order))
        # triples begin with the pair that ends one place earlier
        inner = np.ones(len(now), bool)
        inner[s.first] = False
        tri, self.of_tri = _numbered(self.of_pair[:-1][inner[1:]] * np.int64(width) + now[inner])
        del now
        t_pair, t_suc = tri // width, tri % width
        t_count = np.bincount(self.of_tri[s.train[inner]], minlength=len(tri))
        spread = ((ranks[above] < common.hottest) & (ranks[suc] < common.hottest))[t_pair]
        h = np.flatnonzero(spread)
        h_shard = _shard((key[above[t_pair[h]]] * _C1 ^ key[suc[t_pair[h]]]) * _GOLD ^ key[t_suc[h]], shards)
        order = np.argsort(h_shard, kind="stable")
        h, h_shard = h[order], h_shard[order]
        near = np.flatnonzero(~spread)
        self.tri_of_answer = np.concatenate([near, h])
        # words, with the number of their pairs in a shard
        entry = np.unique(np.concatenate([word_shard * width + np.arange(width), (shard * width + above)[ranks[above] < common.hot]]))
        e_shard, e_word = entry // width, entry % width
        self.entry_of_pair = np.searchsorted(entry, shard * width + above).astype(np.int32)
        self.entry_of_word = np.searchsorted(entry, word_shard * width + np.arange(width))[place]
        home = e_shard == word_shard[e_word]
        far = np.where(ranks < SHORT, np.uint64(0), key & _NEAR | _RARE)
        first = lambda i: (ranks[i].astype(np.uint16), key[i][ranks[i] == SHORT].view(np.uint8).reshape(-1, 8))
        after = lambda i: (ranks[i].astype(np.uint16), far[i][ranks[i] == SHORT].view(np.uint8).reshape(-1, 8)[:, :6])
        self.parts = {
            "w": (e_shard, *first(e_word), {"w_count": np.where(home, own["train"][np.argsort(place)][e_word], 0), "runs": np.bincount(self.entry_of_pair, minlength=len(entry))}),
            "p": (shard, *after(suc), {"p_count": p_count, "children": np.bincount(t_pair[near], minlength=len(shard))}), "t": (shard[t_pair[near]], *after(t_suc[near]), {"t_count": t_count[near]}),
            "h": (h_shard, *after(t_suc[h]), {"h_first": ranks[above[t_pair[h]]], "h_second": ranks[suc[t_pair[h]]], "h_count": t_count[h]}),
        }

    def rows(self, slot: int, made: int) -> pa.RecordBatch:
        """What goes to each shard that has something of this chunk."""
        there = np.unique(np.concatenate([p[0] for p in self.parts.values()]))
        out = {"shard": pa.array(there, pa.int32()), "slot": pa.array(np.full(len(there), slot), pa.int64()), "made": pa.array(np.full(len(there), made), pa.int64())}
        for name, (shard, key, far, more) in self.parts.items():
            at = np.append(np.searchsorted(shard, there), len(shard))
            out[f"{name}_key"] = _slices(key, at)
            out[f"{name}_far"] = _slices(far, np.searchsorted(np.flatnonzero(key == SHORT), at))
            for n, v in more.items():
                out[n] = _slices(np.minimum(v, 255).astype(np.uint8), at)
                if f"{n}_far" in SENT:
                    large = np.flatnonzero(v >= 255)
                    out[f"{n}_far"] = _slices(v[large].astype(np.uint32), np.searchsorted(large, at))
        return pa.RecordBatch.from_pydict({n: out[n] for n in ("shard", "slot", "made", *SENT)})


def _slices(values: np.ndarray, at: np.ndarray) -> pa.Array:
    """Bytes of the rows of ``values`` from each place to the next."""
    width = values.itemsize * (values.shape[1] if values.ndim > 1 else 1)
    return pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer((at * width).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))])


def _joined(column: pa.ChunkedArray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary column as rows of ``width``, and how many each row of the column has."""
    values, sizes = [np.empty(0, np.uint8)], [np.empty(0, np.int64)]
    for c in column.chunks:
        if len(c):
            at = np.frombuffer(c.buffers()[1], np.int32, len(c) + 1, 4 * c.offset)
            values.append(np.frombuffer(c.buffers()[2], np.uint8, at[-1] - at[0], at[0]) if at[-1] > at[0] else values[0])
            sizes.append(np.diff(at) // width)
    return np.concatenate(values).reshape(-1, width), np.concatenate(sizes)


class Received:
    """All that chunks sent to a shard, chunk by chunk."""

    def __init__(self, table: pa.Table):
        self.sizes = {}
        for name, width in SENT.items():
            value, self.sizes[name] = _joined(table.column(name), width)
            if width == 6:
                wide = np.zeros((len(value), 8), np.uint8)
                wide[:, :6] = value
                value = wide
            setattr(self, name, value.view({1: "u1", 2: "u2", 4: "u4"}.get(width, "u8")).ravel())
        for name in ("w_count", "runs", "p_count", "children", "t_count", "h_count"):
            value = getattr(self, name).astype(np.int64)
            value[value == 255] = getattr(self, f"{name}_far")
            setattr(self, name, value)
        self.keys = self.w_key.astype(np.uint64)
        self.keys[self.w_key == SHORT] = self.w_far
        # ranks of successors: of the frequent ones by a table, of the others among all that came
        short = np.zeros(SHORT + 1, bool)
        for key in (self.p_key, self.t_key, self.h_key, self.h_first, self.h_second):
            short[key] = True
        short[SHORT] = False
        self.dictionary = np.concatenate([np.flatnonzero(short).astype(np.uint64), np.unique(np.concatenate([self.p_far, self.t_far, self.h_far]))])
        table = np.cumsum(short) - 1
        self.p_rank, self.t_rank, self.h_rank = (self._ranks(table, key, far) for key, far in ((self.p_key, self.p_far), (self.t_key, self.t_far), (self.h_key, self.h_far)))
        # spread triples come without their words and pairs
        pair = np.unique(self.h_first.astype(np.int64) << 16 | self.h_second)
        self.own_words, self.own_pairs = len(self.keys), len(self.p_rank)
        self.h_pair = self.own_pairs + np.searchsorted(pair, self.h_first.astype(np.int64) << 16 | self.h_second)
        self.keys = np.concatenate([self.keys, (pair >> 16).astype(np.uint64)])
        self.w_count = np.concatenate([self.w_count, np.zeros(len(pair), np.int64)])
        self.runs = np.concatenate([self.runs, np.ones(len(pair), np.int64)])
        self.p_rank = np.concatenate([self.p_rank, table[pair & 0xFFFF]])
        self.children = np.concatenate([self.children, np.zeros(len(pair), np.int64)])
        learned = np.zeros(len(pair), np.int64)
        learned[np.searchsorted(pair, (self.h_first.astype(np.int64) << 16 | self.h_second)[self.h_count > 0])] = 1
        self.p_count = np.concatenate([self.p_count, learned])

    def _ranks(self, table: np.ndarray, key: np.ndarray, far: np.ndarray) -> np.ndarray:
        out = table[key]
        out[key == SHORT] = np.searchsorted(self.dictionary, far)
        return out


def _numbered(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys, sorted, and the number of each given one (32 bits)."""
    order = np.argsort(keys).astype(np.int32)
    keys = keys[order]
    new = np.ones(len(keys), bool)
    np.not_equal(keys[1:], keys[:-1], out=new[1:])
    number = np.empty(len(keys), np.int32)
    number[order] = np.cumsum(new, dtype=np.int32) - 1
    return keys[new], number


def _shard(x: np.ndarray, shards: int) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _C1
    return (((x ^ (x >> np.uint64(29))) * _GOLD) >> _32).astype(np.int64) % shards


def _by_group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows of one value of the first column at a time, from rows sorted by it."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        keys = batch.column(0).to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(keys)) + 1), len(keys)]
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            if held and held[0].column(0)[0].as_py() != keys[a]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def answers_of(table: pa.Table, common: Common, base: Callable, k2: float, k3: float) -> pa.RecordBatch:
    """A shard's answers to the chunks of ``table`` (columns of ``SENT``)."""
    r = Received(table)
    triples = np.concatenate([np.repeat(np.arange(len(r.p_rank)), r.children), r.h_pair]), np.concatenate([r.t_rank, r.h_rank])
    with tempfile.TemporaryDirectory() as folder:
        pairs = np.repeat(np.arange(len(r.keys)), r.runs), r.p_rank, r.p_count
        of_pairs = lambda keys, ranks: common.of_pairs(keys, r.dictionary[ranks])
        trie = Trie.build((r.keys, r.w_count), pairs, (*triples, np.concatenate([r.t_count, r.h_count])), k2, k3, base, common.context_counts, of_pairs).saved(f"{folder}/trie")
        del pairs, triples
        w = trie.words.find(r.keys)
        pair = trie.level2.find(w, r.runs, r.p_rank)
        triple = trie.level3.find(pair[: r.own_pairs], r.children[: r.own_pairs], r.t_rank)
        spread = trie.level3.find(pair[r.h_pair], np.ones(len(r.h_pair), np.int64), r.h_rank)
        # a word without a count has the base's probability, a context without one leaves all to the shorter
        w, pair = w[: r.own_words], pair[: r.own_pairs]
        seen = w >= 0
        values = {
            "w_counts": np.where(seen, trie.word_counts[np.maximum(w, 0)], 0) if len(trie.word_counts) else np.zeros(len(w), np.int64), "w_codes": np.where(seen, coded(trie.word_codes, w), to_code(base(np.zeros(1)))[0]),
            "w_rests": np.where(seen, coded(trie.word_rest, w), 0), "p_codes": trie.level2.code(pair), "t_codes": trie.level3.code(triple), "h_codes": trie.level3.code(spread),
        }
        del trie
    out = {n: table.column(n).combine_chunks() for n in ("slot", "made", "shard")}
    for name, value in values.items():
        out[name] = _slices(value.astype(f"u{ANSWERED[name]}"), np.concatenate([[0], np.cumsum(r.sizes[f"{name[0]}_key"])]))
    return pa.RecordBatch.from_pydict(out)


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chunk_tokens: int = CHUNK_TOKENS, shard_tokens: int = SHARD_TOKENS, k2: float = K2, k3: float = K3, short: int = SHORT, hot: int = HOT, hottest: int = HOTTEST) -> DataFrame:
    """Base and model scores of every text."""
    spark = docs.sparkSession
    kind = slim(docs, id_col).schema[0].dataType
    partitions, each = docs.rdd.getNumPartitions() or 1, -(-_bytes(spark.conf.get("spark.sql.files.maxPartitionBytes")) // SLOT_BYTES)
    cut = stored_by(chunks(docs, id_col, text_col, each, chunk_tokens), "chunks", "slot", min(partitions * each, MOST_BUCKETS))
    shards = max(1, -(-(cut.agg(F.sum("tokens")).first()[0] or 0) // shard_tokens))
    with Scratch(spark) as scratch:
        word = cut.select(F.explode(F.arrays_zip("words", "train")).alias("w")).select("w.*").filter("train > 0")
        counted = scratch.stored(word.groupBy("words").agg(F.sum("train").alias("train")), "words")
        n_train, vocabulary = counted.filter(F.col("words") != BEGIN_KEY - (1 << 64)).agg(F.coalesce(F.sum("train"), F.lit(0)), F.count("*")).first()
        top = most_frequent(counted, short)
    common = Common(*top, hot, hottest)

    def base(count: np.ndarray) -> np.ndarray:
        return (count + 0.1) / (n_train + 0.1 * (vocabulary + 1))

    def own_of(batch: pa.RecordBatch | pa.Table, row: int) -> dict:
        own = {n: batch.column(n)[row] for n in ("n_tokens", "held_out", "words", "train", "numbers")}
        return {n: v.as_py() if n == "numbers" else np.asarray(v.values) if n != "held_out" else v.values.to_numpy(zero_copy_only=False) for n, v in own.items()}

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(hottest * hottest, np.int64)
        for batch in batches:
            for row in range(batch.num_rows):
                own = own_of(batch, row)
                total += Stream(from_planes(own["numbers"]), own["n_tokens"], own["held_out"]).hottest_pairs(common.ranks(own["words"].view(np.uint64)), hottest)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"pair": pa.array(some, pa.int64()), "n": pa.array(total[some], pa.int64())})

    own_columns = ("slot", "made", "n_tokens", "held_out", "words", "train", "numbers")
    for pair, n in cut.select(*own_columns).mapInArrow(pairs, "pair long, n long").groupBy("pair").agg(F.sum("n")).collect():
        common.pair_counts[pair // hottest, pair % hottest] = n
    shared = spark.sparkContext.broadcast(common)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                yield Ngrams(own_of(batch, row), shared.value, shards).rows(batch.column("slot")[row].as_py(), batch.column("made")[row].as_py())

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _by_group(batches):
            out = answers_of(table, shared.value, base, k2, k3)
            del table
            yield out
            # what this shard took goes back before the next one is gathered
            del out
            pa.default_memory_pool().release_unused()

    def score(owns: pa.Table, answers: pa.Table) -> pa.Table:
        """The scores of a partition's chunks, each with its answers by shard."""
        answers, out = answers.sort_by([("made", "ascending"), ("shard", "ascending")]), []
        made = answers.column("made").to_numpy()
        for row in range(owns.num_rows):
            number = owns.column("made")[row].as_py()
            a, b = np.searchsorted(made, (number, number + 1))
            out.append(scored(owns.column("ids")[row].values, own_of(owns, row), answers.slice(a, b - a)))
        return pa.concat_tables(out)

    def scored(ids: pa.Array, own: dict, answers: pa.Table) -> pa.Table:
        grams = Ngrams(own, shared.value, shards)
        s = grams.stream
        got = {n: _joined(answers.column(n), w)[0].view(f"u{w}").ravel() for n, w in ANSWERED.items()}
        count, p1 = got["w_counts"][grams.entry_of_word].astype(np.int64), from_code(got["w_codes"])[grams.entry_of_word]
        exact = base(count)
        rest2, share2 = from_code(got["w_rests"])[grams.entry_of_pair], from_code(got["p_codes"])
        rest3 = k3 / (share2 / rest2 * k2 + k3)  # a pair's count is its share of its context's and the prior, which the rest tells
        share3 = np.empty(len(grams.tri_of_answer))
        share3[grams.tri_of_answer] = from_code(np.concatenate([got["t_codes"], got["h_codes"]]))
        lengths = own["n_tokens"]
        sums: list[list[np.ndarray]] = [[], [], []]
        cuts = np.flatnonzero(np.diff(np.cumsum(lengths) // SLICE, prepend=-1))
        for lo, hi in zip(cuts, [*cuts[1:], len(lengths)], strict=True):  # documents, some hundred thousand tokens at a time
            a = s.first[lo]
            at, first = slice(a, a + int(lengths[lo:hi].sum())), s.first[lo:hi] - a
            pair = grams.of_pair[at]
            p = share2[pair] + rest2[pair] * p1[s.now[at]]
            inner = np.ones(len(p), bool)
            inner[first] = False
            tri = grams.of_tri[a - lo : a - lo + int(inner.sum())]
            p[inner] = share3[tri] + rest3[pair[:-1][inner[1:]]] * p[inner]
            for total, x in zip(sums, (count[s.now[at]] > 0, np.log10(exact[s.now[at]]), np.log10(p)), strict=True):
                total.append(np.add.reduceat(x.astype(np.int64) if x.dtype == bool else x, first))
        known, plain, model = map(np.concatenate, sums)
        return pa.table({
            id_col: ids, "held_out": pa.array(own["held_out"], pa.bool_()), "n_tokens": pa.array(lengths, pa.int64()), "n_known": pa.array(known, pa.int64()),
            "train_tokens": pa.array(np.full(len(lengths), n_train, np.int64)), "base_score": plain, "score": model,
        })

    binary = lambda names: ", ".join(f"{n} binary" for n in names)
    asked = cut.select(*own_columns).mapInArrow(send, f"shard int, slot long, made long, {binary(SENT)}")
    answers = asked.repartitionById(shards, "shard").sortWithinPartitions("shard").mapInArrow(answer, f"slot long, made long, shard int, {binary(ANSWERED)}")
    schema = T.StructType([T.StructField(id_col, kind), T.StructField("held_out", T.BooleanType()), *(T.StructField(c, T.LongType()) for c in ("n_tokens", "n_known", "train_tokens")), *(T.StructField(c, T.DoubleType()) for c in ("base_score", "score"))])
    return cut.groupBy("slot").cogroup(answers.groupBy("slot")).applyInArrow(score, schema)
