"""Quality rules, near-duplicates and the pipeline against brute force."""

import itertools
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_tokens import check_packed
from tidemark.llm import bpe, minhash, packing, pii, quality, queries


def brute_quality(text):
    text = text or ""
    words = [w for w in text.replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\v", " ").replace("\f", " ").split(" ") if w]
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines, seen, again = text.split("\n"), set(), 0
    for line in lines:
        if line.strip(quality.SPACES):
            again += line in seen
            seen.add(line)
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), again, len(covered), failed)


def test_fixed_rules(spark, sf_dir, docs, texts, odd_docs, no_docs):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = quality.score_documents(docs, labels).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute_quality(texts[r.doc_id])
    for r in quality.score_documents(odd_docs, labels, keep=("text", "id", "lang")).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute_quality(r.text) and r.id == 1
    assert quality.score_documents(no_docs, labels).count() == 0
    assert {r.llr for r in quality.score_documents(docs, labels.limit(0)).collect()} == {0.0}


def test_log_ratio_equals_counting(spark, sf_dir, docs, texts):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    good = {r.doc_id for r in labels.collect() if r.quality == 1 and not r.toxic}
    raw, target = np.ones(quality.BUCKETS), np.ones(quality.BUCKETS)
    for d, t in texts.items():
        for b in quality.ngram_buckets(quality.word_hashes(t or "")):
            raw[b] += 1
            target[b] += d in good
    want = np.log(target / target.sum()) - np.log(raw / raw.sum())
    for r in quality.score_documents(docs, labels).collect():
        b = quality.ngram_buckets(quality.word_hashes(texts[r.doc_id] or ""))
        assert r.llr == pytest.approx(want[b].mean() if len(b) else 0.0, abs=1e-9) and r.kept == (not r.base_failed and r.llr >= quality.THRESHOLD)


def test_trusted_ids(spark):
    labels = spark.createDataFrame([("a", 1, 0), ("a", 0, 0), ("b", 1, None), ("c", 1, 1), (None, 1, 0), ("d", None, 0), ("e", 1, 0), ("e", 1, 0)], "doc_id string, quality int, toxic int").selectExpr("*", "1 as good")
    assert quality.trusted_ids(labels, kind="string") == {"b", "e"} and len(quality.trusted_ids(labels, 1, "string")) == 1
    words = " ".join(f"w{i % 70}" for i in range(60))
    docs = spark.createDataFrame([("b", words), ("x", words + " y " * 5000), (None, words), ("z", None)], "doc_id string, text string")
    rows = {r.doc_id: r for r in quality.score_documents(docs, labels).collect()}
    assert rows["b"].llr > rows["x"].llr and not rows["z"].kept and rows[None].n_words == 60


def test_verdicts_on_labels(spark, sf_dir):
    labels = {r.doc_id: r for r in spark.read.parquet(f"{sf_dir.replace('sf0.001', 'sf0.01')}/labels.parquet").collect()}
    rows = [r for r in queries.op8_quality_rules(spark, sf_dir.replace("sf0.001", "sf0.01")).collect() if r.doc_id in labels and not r.base_failed]
    good = [r.kept for r in rows if labels[r.doc_id].quality == 1]
    bad = [r.kept for r in rows if labels[r.doc_id].quality == 0]
    assert sum(good) >= 0.99 * len(good) and sum(bad) <= 0.2 * len(bad)


# Near-duplicates


def test_signatures_are_unbiased():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 1 << 62, 500).astype(np.uint64)
    for change in (0.1, 0.4, 0.8):
        a = rng.integers(1, 12, 500)
        b = np.where(rng.random(500) < change, rng.integers(1, 12, 500), a)
        sig = minhash.signatures(np.concatenate([keys, keys]), np.concatenate([a, b]), np.repeat([0, 1], 500), 2, 3000)
        assert abs((sig[0] == sig[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum()) < 0.035


def slow_overlap(a, b):
    a, b = (dict(zip(k.tolist(), n.tolist())) for k, n in (a, b))
    both = sum(min(n, b.get(k, 0)) for k, n in a.items())
    return both / (sum(a.values()) + sum(b.values()) - both)


def test_blocks_count_overlaps_exactly(monkeypatch):
    monkeypatch.setattr(minhash, "COLUMNS", 16)
    rng = random.Random(5)
    texts = [" ".join(rng.choice("a b c d".split()) for _ in range(rng.randint(1, 40))) for _ in range(60)] + ["word " * 300, "word " * 250]
    keys, bags = ([f(t) for t in texts] for f in (minhash.bag_keys, minhash.shingles))
    for threshold in (0.3, 0.8):
        got = {tuple(p) for p in minhash.alike(keys[:30], keys[20:], threshold).tolist()}
        assert got == {(i, j) for i in range(30) for j in range(42) if slow_overlap(bags[i], bags[20 + j]) >= threshold}


def brute_classes(texts):
    bags = {d: minhash.shingles(t) for d, t in texts.items()}
    keys = {d: minhash.bag_keys(t) for d, t in texts.items()}
    parent = {d: d for d in texts}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    def link(a, b):
        a, b = sorted((find(a), find(b)))
        parent[b] = a

    by_text, having = {}, defaultdict(list)
    for d, t in texts.items():
        link(by_text.setdefault(t or "", d), d)
        for k in bags[d][0]:
            having[k].append(d)
    for a, b in {p for v in having.values() for p in itertools.combinations(v, 2)}:
        if find(a) != find(b) and slow_overlap(bags[a], bags[b]) >= 0.8:
            assert minhash.overlap(keys[a], keys[b]) == slow_overlap(bags[a], bags[b])
            link(a, b)
    return {d: find(d) for d in texts}


def planted(rng, n_base=12, copies=25):
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    texts = {}
    for b in range(n_base):
        base = [rng.choice(words) for _ in range(rng.randint(30, 200))]
        texts[len(texts)] = " ".join(base)
        for _ in range(copies):
            t = base[:]
            for _ in range(rng.randint(0, max(1, len(t) // 14))):
                t[rng.randrange(len(t))] = rng.choice(words)
            texts[len(texts)] = " ".join(t)
    return texts


def test_classes_equal_brute_force(spark, docs, texts):
    got = {r.doc_id: r.class_id for r in minhash.near_duplicates(docs).collect()}
    assert got == brute_classes(texts)


@pytest.mark.parametrize("block", [256, 8])
def test_crowds_of_near_copies(spark, monkeypatch, block):
    monkeypatch.setattr(minhash, "BLOCK", block)
    texts = planted(random.Random(7))
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    got = {r.doc_id: r.class_id for r in minhash.near_duplicates(df).collect()}
    want = brute_classes(texts)
    assert sum(got[d] != want[d] for d in texts) == 0


@pytest.mark.parametrize("keys", [1 << 20, 300])
def test_an_original_and_its_edited_copies(spark, monkeypatch, keys):
    """Copies are alike to the original but not to one another, and all share buckets."""
    monkeypatch.setattr(minhash, "BLOCK_KEYS", keys)
    rng = random.Random(11)
    base = [f"w{rng.randint(0, 999)}" for _ in range(230)]
    texts = {0: " ".join(base)}
    for i in range(1, 120):
        t = base[:]
        for at in rng.sample(range(0, 230, 12), 5):
            t[at] = f"new{rng.randint(0, 9999)}"
        texts[i] = " ".join(t)
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    assert {r.class_id for r in minhash.near_duplicates(df).collect()} == set(brute_classes(texts).values()) == {0}


def test_texts_of_one_hash_stay_apart(spark, monkeypatch):
    monkeypatch.setattr(minhash, "text_hash", lambda text: F.pmod(F.xxhash64(text), F.lit(3)))
    texts = {i: f"text number {i} " * (1 + i % 4) for i in range(40)} | {100 + i: f"text number {i} " * (1 + i % 4) for i in range(40)}
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    assert {r.doc_id: r.class_id for r in minhash.near_duplicates(df).collect()} == brute_classes(texts)
    assert sorted(r.doc_id for r in minhash.one_of_each_class(df).collect()) == list(range(40))


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 120)] + [(200, 200)]
    got = {r.tid: r.root for r in minhash.components(spark.createDataFrame(chain, "tid bigint, leader bigint")).collect()}
    assert all(got[i] == 0 for i in range(1, 41)) and all(got[i] == 100 for i in range(101, 120))


def test_classes_of_odd_rows(odd_docs, no_docs):
    rows = minhash.near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by = defaultdict(list)
    for r in rows:
        by[r.root].append(r.doc_id)
    assert sorted(map(str, next(v for v in by.values() if 6 in v))) == ["5", "5", "6"]
    assert sorted(map(str, next(v for v in by.values() if 3 in v))) == ["2", "3", "None"]
    kept = minhash.one_of_each_class(odd_docs)
    assert kept.columns == odd_docs.columns and kept.count() == len(by)
    assert minhash.near_duplicates(no_docs).count() == 0 and minhash.one_of_each_class(no_docs).count() == 0


# Pipeline


def test_pipeline_stages_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    (_, rules), (_, near), (_, private), (_, pack) = corpus_pipeline.STAGES
    one = rules(spark, docs, sf_dir).persist()
    kept = {r.doc_id for r in quality.score_documents(docs, labels).collect() if r.kept}
    assert {r.doc_id for r in one.collect()} == kept and one.columns == docs.columns
    two = near(spark, one, sf_dir).persist()
    classes = brute_classes({r.doc_id: r.text for r in one.collect()})
    assert sorted(r.doc_id for r in two.collect()) == sorted(set(classes.values())) and two.columns == docs.columns
    three = private(spark, two, sf_dir).persist()
    spans = {r.id: r for r in pii.find_spans(two).collect()}
    before = {r.doc_id: r.text for r in two.collect()}
    for r in three.collect():
        found = spans[r.doc_id]
        marks = sorted([(s.start, s.end, s.kind) for s in found.base] + [(s.start, s.end, "term") for s in found.terms])
        text, at = "", 0
        for start, end, kind in marks:
            if start >= at:
                text += before[r.doc_id][at:start] + pii.NAMES[kind]
            at = max(at, end)
        assert r.text == text + before[r.doc_id][at:] and r.n_chars == len(r.text)
    chunks = packing.ChunkIds(bpe.encoding(bpe.rank_file()))
    lengths = {r.doc_id: len(packing.document_ids(r.text, chunks)) for r in three.collect()}
    assert check_packed(pack(spark, three, sf_dir).collect(), lengths) > 0.9


def test_run_and_registration(spark, sf_dir):
    import __spark_entry__ as entry

    found = entry.queries()
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in found) == 1
    assert found["pipeline"] is corpus_pipeline.run and corpus_pipeline.ORACLE_SQL is None and "pipeline" not in entry.oracle_sql()
    assert corpus_pipeline.run(spark, sf_dir).count() > 0


def test_pipeline_of_odd_rows(spark, sf_dir, odd_docs, no_docs):
    for start in (odd_docs, no_docs):
        d = start.select(*corpus_pipeline.COLUMNS)
        first = corpus_pipeline.STAGES[0][1](spark, d, sf_dir)
        assert first.columns == d.columns and {r.doc_id for r in first.collect()} <= {r.doc_id for r in d.collect()}
        for _, stage in corpus_pipeline.STAGES[1:]:  # the rules leave few of these rows, the others get them all
            out = stage(spark, d, sf_dir)
            out.count()
