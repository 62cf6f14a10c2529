"""Byte-level BPE, packing and language-model scores against brute force."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tidemark.llm import bpe, lm, packing, trie


def test_bpe_round_trip_and_pieces(docs, texts, odd_docs, no_docs):
    enc = bpe.encoding(bpe.rank_file())
    for r in bpe.encode_documents(docs).collect():
        want = enc.encode_ordinary(texts[r.doc_id] or "")
        assert r.ids == want and r.n_tokens == len(want)
        assert r.ids_sha256 == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()
    odd = bpe.encode_documents(odd_docs, piece_chars=100, keep_ids=False).collect()
    assert len(odd) == odd_docs.count() and sum(r.n_tokens == 0 for r in odd) == 3
    assert bpe.encode_documents(no_docs).count() == 0


def test_safe_pieces_keep_the_ids(texts):
    enc = bpe.encoding(bpe.rank_file())
    for text in [*list(texts.values())[:60], "a  b   c\n d\t e's 'll 12 3 \n\n x" * 40, " lead", "trail ", "x" * 500]:
        for size in (1, 7, 64):
            assert bpe.encode_text(text, enc, size).tolist() == enc.encode_ordinary(text)


@pytest.mark.parametrize("char", [" ", "\n", "^", "a", "7", "中", " \n\t"])
def test_a_million_of_one_character(char):
    enc = bpe.encoding(bpe.rank_file())
    whole = char * (1_000_000 // len(char))
    for text in (whole, "start" + whole + "end", whole + "end " + whole):
        ids = bpe.encode_text(text, enc)
        assert bpe.decode_ids(ids, enc).decode() == text
        packed = packing.document_ids(text, packing.ChunkIds(enc, packing.added_tokens()))
        assert (packed[:-1] == ids).all()
    # what the library can take whole has the same ids
    for text in (char * 20_000, "start" + char * 20_000 + "end" + char * 9_000 + " x"):
        assert bpe.encode_text(text, enc).tolist() == enc.encode_ordinary(text)


def test_bytes_that_are_no_text_decode():
    enc = bpe.encoding(bpe.rank_file())
    ids = bpe.encode_text("中文😀", enc)
    assert b"".join(bpe.decode_ids(ids[i : i + 1], enc) for i in range(len(ids))) == "中文😀".encode()


def test_ids_are_those_of_the_tokenizers_library(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    chunks = packing.ChunkIds(bpe.encoding(bpe.rank_file()), packing.added_tokens())
    samples = [*texts.values(), None, "", "  two  blanks ", "tab\tand\nline \n x", "<|endoftext|> a", "é😀  x", "ends ", " starts"]
    for text in samples:
        assert packing.document_ids(text, chunks)[:-1].tolist() == t.encode(text or "", add_special_tokens=False).ids


def test_first_fit_decreasing_equals_a_scan():
    rng = np.random.default_rng(3)
    sizes = rng.integers(1, 2048, 500)
    bins, offsets = packing.first_fit_decreasing(sizes, 2048)
    free: list[int] = []
    for i in np.argsort(-sizes, kind="stable"):
        k = next((b for b, f in enumerate(free) if f >= sizes[i]), None)
        if k is None:
            free.append(2048)
            k = len(free) - 1
        assert bins[i] == k and offsets[i] == 2048 - free[k]
        free[k] -= sizes[i]


def check_packed(rows, lengths):
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append((r.start, r.length, r.doc_tokens))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= packing.WIDTH
    for doc, n in lengths.items():
        at = 0
        for start, length, total in sorted(pieces[doc]):
            assert start == at and total == n
            at += length
        assert at == n
    return sum(r.length for r in rows) / (len(sequences) * packing.WIDTH)


def test_packing_is_whole_gapless_and_dense(docs, texts):
    chunks = packing.ChunkIds(bpe.encoding(bpe.rank_file()), packing.added_tokens())
    ids = {d: packing.document_ids(t, chunks) for d, t in texts.items()}
    rows = packing.pack(packing.token_pieces(docs).persist()).collect()
    fill = check_packed(rows, {d: len(x) for d, x in ids.items()})
    assert fill > 0.97
    for r in rows:
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes())


def test_equal_rows_do_not_crowd_a_group(spark):
    rows = spark.range(100_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("one text").alias("text"))
    groups = packing.pack(packing.token_pieces(rows).persist()).groupBy(F.expr("sequence_id div 16777216").alias("g")).count().collect()
    assert sum(r["count"] for r in groups) == 100_000 and max(r["count"] for r in groups) < 1.2 * packing.GROUP_DOCS


def test_packing_of_odd_rows(odd_docs, no_docs):
    rows = packing.pack(packing.token_pieces(odd_docs).persist(), group_docs=3).collect()
    assert sum(r.start == 0 for r in rows) == odd_docs.count()
    taken = Counter((r.sequence_id, r.offset) for r in rows)
    assert max(taken.values()) == 1
    assert packing.pack(packing.token_pieces(no_docs)).count() == 0


@pytest.mark.parametrize("n", [0, 1, 5, 3000])
def test_elias_fano(n):
    rng = np.random.default_rng(n)
    values = np.sort(rng.integers(0, 1 << 62, n).astype(np.uint64))
    for data in (values, values >> np.uint64(50), np.unique(values >> np.uint64(48)), values // np.uint64(1 << 62), np.arange(n, dtype=np.uint64)):
        ef, m = trie.EliasFano.of(data), len(data)
        assert (ef.get(np.arange(m)) == data).all()
        if m > 1:
            assert (np.array(ef.two(np.arange(m - 1))) == np.array([data[:-1], data[1:]])).all()
        asked = np.concatenate([data, data + np.uint64(1), np.uint64([1 << 63, (1 << 64) - 1]), rng.integers(0, 1 << 62, 50).astype(np.uint64)])
        at = np.searchsorted(data, asked)
        want = np.where((at < m) & (data[np.minimum(at, max(m - 1, 0))] == asked) if m else np.zeros(len(asked), bool), at, -1)
        assert (ef.find(asked) == want).all()


def test_elias_fano_within_ranges():
    rng = np.random.default_rng(1)
    ef = trie.EliasFano.of(data := np.sort(rng.integers(0, 300, 500)))
    first = rng.integers(0, 500, 4000)
    last, asked = first + rng.integers(0, 60, 4000).clip(max=500 - first), rng.integers(0, 310, 4000)
    for x, a, b, got in zip(asked, first, last, ef.find(asked, first, last).tolist(), strict=True):
        hit = np.flatnonzero(data[a:b] == x)
        assert got == (a + hit[0] if len(hit) else -1)


def test_trie_from_a_file(tmp_path):
    rng = np.random.default_rng(2)
    keys = np.unique(rng.integers(5, 1 << 63, 60).astype(np.uint64))
    n, size = 4000, len(keys)
    weights = 1 / np.arange(1, size + 1)
    text = rng.choice(size, n, p=weights / weights.sum())
    learned = rng.random(n - 1) > 0.2  # the others are only asked for
    t_learned = learned[1:] & learned[:-1]
    words, two, three = text.tolist(), list(zip(text.tolist(), text[1:].tolist())), list(zip(text.tolist(), text[1:].tolist(), text[2:].tolist()))
    w_count, p_count, t_count = Counter(words), Counter(x for x, y in zip(two, learned) if y), Counter(x for x, y in zip(three, t_learned) if y)
    of_words = lambda x: np.where(x == keys[1], 5000, -1)
    of_pairs = lambda x, rank: np.where((x == keys[1]) & (rank == 2), 900, -1)
    build = (keys[text], np.ones(n, int)), (np.arange(n - 1), text[1:], learned.astype(int)), (np.arange(n - 2), text[2:], t_learned.astype(int))
    t = trie.Trie.build(*build, 300.0, 8.0, lambda c: (c + 0.1) / 4100, of_words, of_pairs).saved(str(tmp_path / "t"))
    w = t.words.find(keys[text])
    assert t.word_counts[w].tolist() == [w_count[x] for x in words] and t.words.find(np.array([7], np.uint64)).tolist() == [-1]
    assert trie.from_code(t.word_codes[w]) == pytest.approx((t.word_counts[w] + 0.1) / 4100, rel=1e-3)
    one = lambda a: 5000 if a == 1 else w_count[a]
    both = lambda a, b: 900 if (a, b) == (1, 2) else p_count[a, b]
    assert trie.from_code(t.word_rest[w]) == pytest.approx(np.array([300 / (one(x) + 300) for x in words]), rel=1e-3)
    number = t.level2.find(w[:-1], np.ones(n - 1, int), text[1:])
    want = [both(a, b) / (one(a) + 300) if p_count[a, b] else 0 for a, b in two]
    assert trie.from_code(t.level2.code(number)) == pytest.approx(np.array(want), rel=1e-3)
    third = t.level3.find(number[:-1], np.ones(n - 2, int), text[2:])
    want = [t_count[x] / (both(*x[:2]) + 8) if t_count[x] else 0 for x in three]
    assert trie.from_code(t.level3.code(third)) == pytest.approx(np.array(want), rel=1e-3)
    assert t.level2.find(np.array([0, -1]), np.array([2, 1]), np.array([-1, 1, 0])).tolist()[::2] == [-1, -1]


def brute_scores(texts, k2=lm.K2, k3=lm.K3):
    tokens = {d: [*(w.decode() for w in lm.tokens(t)), "\n"] for d, t in texts.items()}
    train = [d for d in texts if not lm.is_held_out(d)]
    uni, bi, tri = Counter(), Counter(), Counter()
    for d in train:
        seq = [" ", *tokens[d]]
        uni.update(seq)
        bi.update(zip(seq, seq[1:]))
        tri.update(zip(seq, seq[1:], seq[2:]))
    starts = uni.pop(" ")
    n, v = sum(uni.values()), len(uni)
    out = {}
    for d, words in tokens.items():
        seq, base, score, known = [" ", *words], 0.0, 0.0, 0
        for i in range(1, len(seq)):
            w, p = seq[i], (uni[seq[i]] + 0.1) / (n + 0.1 * (v + 1))
            base, known = base + math.log10(p), known + (uni[w] > 0)
            c = starts if seq[i - 1] == " " else uni[seq[i - 1]]
            p = (bi[seq[i - 1], w] + k2 * p) / (c + k2)
            if i > 1:
                context = bi[seq[i - 2], seq[i - 1]]
                p = (tri[seq[i - 2], seq[i - 1], w] + k3 * p) / (context + k3)
            score += math.log10(p)
        out[d] = (len(words), known, n, base, score)
    return out


def test_lm_scores_equal_counting(docs, texts):
    want = brute_scores(texts)
    for options in ({}, {"chunk_tokens": 3000, "shard_tokens": 20_000}, {"chunk_tokens": 3000, "shard_tokens": 20_000, "short": 40, "hot": 20, "hottest": 10}):
        rows = lm.score_documents(docs, **options).collect()
        assert len(rows) == len(texts)
        assert {len(rows), len({r.doc_id for r in rows})} == {len(texts)}
        for r in rows:
            n, known, total, base, score = want[r.doc_id]
            assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total) and r.held_out == lm.is_held_out(r.doc_id)
            assert r.base_score == pytest.approx(base, rel=1e-9) and r.score == pytest.approx(score, rel=2e-3)


def test_more_slots_than_buckets(docs, texts, monkeypatch):
    """A bucket with several slots: each is a group of its own."""
    monkeypatch.setattr(lm, "MOST_BUCKETS", 2)
    want = {r.doc_id: r.score for r in lm.score_documents(docs).collect()}
    got = {r.doc_id: r.score for r in lm.score_documents(docs.repartition(5), chunk_tokens=3000).collect()}
    assert got.keys() == want.keys() == texts.keys() and all(got[k] == pytest.approx(want[k], rel=2e-3) for k in want)


def test_chunks_send_only_what_they_have(docs):
    own = lm.chunks(docs, "doc_id", "text", 2, 500).first()
    assert own["slot"] == lm.slot_of(0)
    own = {n: np.array(own[n]) if n != "numbers" else bytes(own[n]) for n in ("n_tokens", "held_out", "words", "train", "numbers")}
    common = lm.Common(own["words"][2:30].view(np.uint64), own["train"][2:30], 20, 10)
    few, many = (lm.Ngrams(own, common, n).rows(0, 0) for n in (3, 100_000))
    assert few.num_rows == 3 and many.num_rows < 10_000
    for name, width in lm.SENT.items():
        sums = {len(lm._joined(pa.chunked_array([x.column(name)]), width)[0]) for x in (few, many)}
        assert len(sums) == 1 or name[0] in "wr"  # a hot word has an entry in each shard with its pairs


def test_slots_are_dealt_evenly(spark):
    """Tasks know their slots by undoing Spark's hash; nothing is collected for it."""
    numbers = [*range(50), 2**31 - 1, 12_345_678, 25_000_000]
    hashed = spark.createDataFrame([(n, lm.slot_of(n)) for n in numbers], "n long, slot long").selectExpr("n", "hash(slot) AS h")
    assert all(r.n == r.h for r in hashed.collect())
    slots = np.array([lm.slot_of(n) for n in range(37)])
    frame = spark.createDataFrame([(int(x),) for x in slots], "slot long").repartition(37, "slot").select(F.spark_partition_id().alias("p"), "slot")
    assert sorted(r.p for r in frame.collect()) == list(range(37)) and len(set(slots.tolist())) == 37


def test_lm_helps_on_held_out_text(docs):
    rows = [r for r in lm.score_documents(docs).collect() if r.held_out]
    assert rows and sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_lm_of_odd_rows(odd_docs, no_docs):
    rows = lm.score_documents(odd_docs).collect()
    assert len(rows) == odd_docs.count() and sum(r.n_tokens == 1 for r in rows) == 4
    assert all(r.held_out for r in rows if r.doc_id is None)
    assert lm.score_documents(no_docs).count() == 0
