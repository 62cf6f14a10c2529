"""Language identification, the filter audit and spelling variants against slow versions."""

import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
import regex
from pyspark.sql import functions as F

from tidemark.llm import filter_audit, langid, queries, variants

# --- spelling variants


def near(a: str, b: str) -> bool:
    """One edit apart, by trying every edit of the longer or equal one."""
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    long, short = (a, b) if len(a) > len(b) else (b, a)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def slow_counts(rows) -> dict[str, int]:
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 5:
                n[run] += 1
    return {w: k for w, k in n.items() if k >= 3}


def slow_variants(rows) -> set[tuple]:
    n = slow_counts(rows)
    by_length = defaultdict(list)
    for w in n:
        by_length[len(w)].append(w)
    form, count = {}, {}
    for w in n:
        found = [x for k in (-1, 0, 1) for x in by_length[len(w) + k] if near(w, x)]
        best = min(found, key=lambda x: (-n[x], x), default=None)
        form[w], count[w] = best if best and n[best] >= 2 * n[w] else None, len(found)

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return {(w, form[w], root(w), n[w], count[w], n[form[w]] if form[w] else None) for w in n}


def as_rows(df) -> list[tuple]:
    return [tuple(r) for r in df.collect()]


def check_variants(spark, rows):
    got = as_rows(variants.spelling_variants(spark.createDataFrame(rows, "doc_id bigint, text string")))
    assert len(got) == len(set(got)) and set(got) == slow_variants(rows)
    return got


def test_variants_of_few_letters(spark):
    """Words of two and three letters: repeated grams, many near words, ties of counts."""
    rng = random.Random(5)
    for letters, lengths in (("ab", (5, 8)), ("abÿ", (5, 7)), ("abcde", (5, 6))):
        words = ["".join(rng.choices(letters, k=rng.randint(*lengths))) for _ in range(220)]
        rows = [(k, " ".join(rng.choices(words, k=60)) + " " + " ".join(words)) for k in range(5)]
        got = check_variants(spark, rows)
        assert len(got) > 40 and max(r[4] for r in got) > 3


def test_variants_of_edits_everywhere(spark):
    """Every single edit of long and short words is found, at each place."""
    rng = random.Random(6)
    words = ["abcde", "vérité", "proportional", "aaaaaaaaaa", "abababababab", "x" * 300]
    edited = []
    for w in words:
        for i in range(0, len(w) + 1, 1 if len(w) < 20 else 37):
            edited += [w[:i] + "q" + w[i:], w[:i] + w[i + 1 :], w[:i] + "q" + w[i + 1 :]]
    text = " ".join([*(words * 4), *edited])
    rows = [(k, text) for k in range(4)]
    rng.shuffle(rows)
    got = {r[0]: r for r in check_variants(spark, rows)}
    assert got["vérité"][4] >= 15
    assert all(got[w][2] in got for w in got)


def test_variants_of_documents(spark, docs, texts):
    got = as_rows(queries.op13_spelling_variants(spark, sf_of(docs)))
    assert set(got) == slow_variants(texts.items()) and len(got) == len(set(got))


def test_variants_equal_their_sql(spark, duck, sf_dir):
    got = as_rows(queries.op13_spelling_variants(spark, sf_dir).select("word", "form", "root", "n", "n_near", "form_n"))
    assert sorted(got, key=str) == sorted(duck.execute(f"SELECT word, form, root, n, n_near, form_n FROM ({variants.ORACLE_SQL})").fetchall(), key=str)


def sf_of(docs) -> str:
    return docs.inputFiles()[0].rpartition("/")[0].removeprefix("file://")


def test_chains_of_forms(spark):
    """Roots follow forms over many steps."""
    words = ["abcdefgh" + "z" * k for k in range(9)]
    rows = [(1, " ".join(w for k, w in enumerate(words) for _ in range(3 * 2**k)))]
    got = {r[0]: r for r in check_variants(spark, rows)}
    assert got[words[0]][2] == words[-1]


def test_variants_broadcast_no_words(spark):
    """No join sends a table to the driver, however small Spark takes it to be: keys are sized by the small files of their words."""
    words = ["abcdefgh" + "z" * k for k in range(9)]
    rows = [(1, " ".join(w for k, w in enumerate(words) for _ in range(3 * 2**k)))]
    most = "spark.sql.maxBroadcastTableSize"
    spark.conf.set(most, "1b")
    try:
        assert any(r[1] for r in check_variants(spark, rows))
    finally:
        spark.conf.unset(most)


def test_pivots_are_disjoint_and_least():
    rng = random.Random(7)
    for _ in range(400):
        ranks = rng.choices(range(12), k=rng.randint(4, 12))
        prefix = variants.first_grams(ranks)
        got = variants.pivots(ranks, prefix)
        choices = [p for p in itertools.combinations(prefix, 2) if p[1] - p[0] >= 2]
        assert got[1] - got[0] >= 2 and sum(ranks[i] for i in got) == min(sum(ranks[i] for i in p) for p in choices)


def test_variants_of_odd_rows(spark, odd_docs, no_docs):
    got = as_rows(variants.spelling_variants(odd_docs))
    assert set(got) == slow_variants([(r.doc_id, r.text) for r in odd_docs.collect()])
    empty = variants.spelling_variants(no_docs)
    assert empty.columns == ["word", "form", "root", "n", "n_near", "form_n"] and empty.isEmpty()


def test_keys_meet_only_in_a_region(spark):
    """A gram that all words share doesn't bring them together: what meets grows with the words, not with their square."""
    rng = random.Random(8)
    made = {}
    for n in (1000, 4000):
        words = spark.createDataFrame([("xq" + "".join(rng.choices("abcdefghijklmnop", k=10)), 3) for _ in range(n)], "word string, n bigint").distinct()
        order = variants.gram_order(words)
        asks, has = variants.keyed(words, order, True), variants.keyed(words, order, False)
        made[n] = asks.join(has.toDF("key", "b", "n_b", "last_b"), "key").filter("word <> b").count()
    assert made[4000] <= 16 * 1000 and made[4000] <= 20 * max(made[1000], 50)


# --- the audit


def slow_audit(rows, labels) -> set[tuple]:
    """Every order over every document."""
    good, toxic = defaultdict(bool), defaultdict(bool)
    for doc_id, quality, bad in labels:
        good[doc_id] |= quality == 1
        toxic[doc_id] |= bad == 1
    marks = []
    for doc_id, text, lang in rows:
        t = text or ""
        words = [w for w in re.split("[ \t-\r]+", t) if w]
        fails = {
            "A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words), "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t), "D": any(c in t for c in "#$%&*|"),
            "E": doc_id is not None and any(x is not None and x < doc_id and (y or "") == t for x, y, _ in rows),
        }
        marks.append((lang or "", fails, good.get(doc_id, False) if doc_id is not None else False, toxic.get(doc_id, False) if doc_id is not None else False))
    out, share = [], Counter()
    for part in {m[0] for m in marks}:
        own = [m for m in marks if m[0] == part]
        for order in map("".join, itertools.permutations("ABCDE")):
            left = own
            for i, f in enumerate(order):
                gone = [m for m in left if m[1][f]]
                passed = [m for m in left if not m[1][f]]
                before = sum(m[1][f] for m in own) - len(gone)
                unique = sum(m[1][f] and sum(m[1].values()) == 1 for m in own)
                out.append((part, order, i + 1, f, len(passed), len(gone), before, unique, sum(m[2] for m in gone), sum(m[3] for m in gone)))
                share[part, f] += len(gone)
                left = passed
    return {(*r[:3], *r[4:], share[r[0], r[3]]) for r in out}


def audit_rows(df) -> list[tuple]:
    return as_rows(df.select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"))


def test_audit_of_documents(spark, docs, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    got = audit_rows(queries.op12_filter_audit(spark, sf_dir))
    rows = [(r.doc_id, r.text, r.lang) for r in docs.collect()]
    assert len(got) == 600 * len({r[2] for r in rows})
    assert set(got) == slow_audit(rows, [(r.doc_id, r.quality, r.toxic) for r in labels.collect()])


def test_audit_equals_its_sql(spark, duck, sf_dir):
    got = audit_rows(queries.op12_filter_audit(spark, sf_dir))
    names = "part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley"
    assert sorted(got) == sorted(duck.execute(f"SELECT {names} FROM ({filter_audit.ORACLE_SQL})").fetchall())


def test_audit_of_odd_rows(spark, odd_docs, no_docs):
    labels = [(1, 1, 0), (1, 0, None), (5, None, 1), (6, 1, 1), (None, 1, 1), (99, 1, 1)]
    table = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    more = odd_docs.select("doc_id", "text", "lang", "source", "n_chars").unionByName(spark.createDataFrame([(11, "\x0b\x0c words\x1c here", None, None, 1), (12, "ABC & DEF", "", None, 1), (13, "", None, None, 0)], "doc_id bigint, text string, lang string, source string, n_chars bigint"))
    got = audit_rows(filter_audit.audit(more.withColumn("failed", more.n_chars), table))
    assert len(got) == len(set(got)) and set(got) == slow_audit([(r.doc_id, r.text, r.lang) for r in more.collect()], labels)
    assert filter_audit.audit(no_docs, table).isEmpty() and filter_audit.audit(odd_docs, table.limit(0)).count() > 0


def test_audit_of_other_filters(spark):
    """The fold takes any set of filters."""
    counted = spark.createDataFrame([("p", "XY", 3, 1, 0), ("p", "X", 2, 0, 1), ("p", "", 5, 2, 0)], "part string, failed string, n bigint, good bigint, toxic bigint")
    got = {(r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in filter_audit.fold_orders(counted, "XY").collect()}
    assert got == {("XY", 1): (5, 5, 0, 2, 1, 1, 7), ("XY", 2): (5, 0, 3, 0, 0, 0, 3), ("YX", 1): (7, 3, 0, 0, 1, 0, 3), ("YX", 2): (5, 2, 3, 2, 0, 1, 7)}


# --- language identification


def slow_language(train, rows, most: int) -> dict:
    """Straight from the definition, in logs of plain counts."""
    find = lambda t: regex.findall(r"\p{L}[\p{L}\p{M}]*", (t or "").lower())
    grams = lambda w, n: [g for i in range(len(w) + 3 - n) if (g := f" {w} "[i : i + n]) != " "]
    words, pieces = defaultdict(Counter), defaultdict(Counter)
    for text, lang in train:
        for w in find(text):
            words[lang].update([w] if len(w) <= 40 else [])
            for n in range(1, 6):
                if len(w) + 2 >= n:
                    pieces[lang].update(grams(w, n))
    langs = list(words)
    size = {x: words[x].total() for x in langs}
    cut = lambda t: {x: dict(sorted(t[x].items(), key=lambda e: (-e[1], e[0]))[: most // len(langs)]) for x in langs}
    words, pieces = cut(words), cut(pieces)

    def logs(table, piece):
        if not any(piece in table[x] for x in langs):
            return None
        total = {x: sum(table[x].values()) for x in langs}
        return {x: math.log10(table[x][piece] / total[x]) if piece in table[x] else math.log10(0.5 / max(total.values())) for x in langs}

    def word_score(w):
        if found := (logs(words, w) if len(w) <= 40 else None):
            return found
        for n in range(min(5, len(w) + 2), 0, -1):
            if known := [f for g in grams(w, n) if (f := logs(pieces, g))]:
                return {x: sum(f[x] for f in known) / len(known) for x in langs}
        return dict.fromkeys(langs, 0.0)

    out = {}
    for doc_id, text in rows:
        found = [word_score(w) for w in find(text)]
        if not found:
            out[doc_id] = ("und", 0.0)
            continue
        mean = {x: sum(f[x] for f in found) / len(found) for x in langs}
        best = max(langs, key=lambda x: (mean[x], size[x]))
        out[doc_id] = (best, 1 / sum(10 ** (mean[x] - mean[best]) for x in langs))
    return out


@pytest.fixture(scope="module")
def languages(spark, sf_dir):
    return {r.doc_id: r for r in queries.op11_language_id(spark, sf_dir).collect()}


def test_language_of_held_out_documents(languages, docs):
    rows = docs.collect()
    assert len(languages) == len(rows)
    assert all(languages[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    asked = [r for r in rows if languages[r.doc_id].held_out and len(regex.findall(r"\p{L}+", r.text or "")) >= 20]
    right = sum(languages[r.doc_id].lang_pred == r.lang for r in asked)
    assert len(asked) > 20 and right >= 0.95 * len(asked)
    assert all(0 <= r.score <= 1 for r in languages.values())


def test_language_against_slow_version(spark, docs):
    rows = docs.limit(60).collect()
    train = [(r.text, r.lang) for r in rows if zlib.crc32(str(r.doc_id).encode()) % 4 != 2]
    asked = [(r.doc_id, r.text) for r in rows] + [(-1, "Zqxv jkwz"), (-2, "éé ñandú"), (-3, "語 слово"), (-4, "1 2 3"), (-5, None), (-6, "the " * 9 + "y" * 3000)]
    for most in (200_000, 400):
        model = langid.fit(spark.createDataFrame(train, "text string, lang string"), words=most, grams=most)
        got = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(spark.createDataFrame(asked, "doc_id bigint, text string"), model).collect()}
        want = slow_language(train, asked, most)
        assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in want.items()}
        assert all(math.isclose(got[k][1], want[k][1], rel_tol=1e-6, abs_tol=1e-9) for k in want)


def test_unseen_words_fall_back(spark):
    """Words that training never saw are told by their letters."""
    train = [("walking talking jumping reading", "en"), ("gehen laufen sprechen lesen", "de")] * 5
    model = langid.fit(spark.createDataFrame(train, "text string, lang string"))
    seen = langid.Remembered()
    assert model.predict("hopping", seen)[0] == "en" and model.predict("machen", seen)[0] == "de"
    assert "hopping" not in model.words and "hopping" in seen.places
    long = "walking" * 40
    assert model.predict(f"{long} hopping", seen)[0] == "en" and long not in seen.places
    assert model.predict("42 !", seen) == ("und", 0.0) and model.predict("", seen) == ("und", 0.0)


def test_words_are_runs_of_letters():
    """Both ways of finding words agree on every character, in context."""
    for block in range(0, 0x300, 16):
        text = "".join(f"x{chr(c)}y {chr(c)} " for c in range(block, block + 16))
        assert langid.LATIN.findall(text) == langid.WORD.findall(text) and not langid.HIGH.search(text)
    assert langid.words_of("naïve e\u0301t\u0301 語言x 1²½ _a") == ["naïve", "e\u0301t\u0301", "語言x", "a"]


def test_remembered_rows_start_anew(spark, monkeypatch):
    """More unseen words than are remembered, in one text and over many."""
    train = [("walking talking jumping reading", "en"), ("gehen laufen sprechen lesen", "de")] * 5
    model = langid.fit(spark.createDataFrame(train, "text string, lang string"))
    texts = [" ".join(f"{a}{b}ing" for a in "bcdfg" for b in "aeiou"), "machen kochen", "hopping singing"] * 3
    want = [model.predict(t, langid.Remembered()) for t in texts]
    monkeypatch.setattr(langid, "FLUSH", 7)
    seen = langid.Remembered()
    assert [model.predict(t, seen) for t in texts] == want


def test_language_of_odd_rows(spark, odd_docs, no_docs):
    rows = langid.identify(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    kinds = {(r.doc_id, r.lang_pred) for r in rows}
    assert {(2, "und"), (3, "und"), (7, "und"), (None, "und")} <= kinds
    assert all(not r.held_out for r in rows if r.doc_id is None)
    assert langid.identify(no_docs).isEmpty()
    unlabelled = langid.identify(odd_docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in unlabelled.collect()} == {"und"}


def test_language_ignores_other_columns(spark, languages, docs):
    """Neither language, source nor id of a document decides its prediction."""
    model = langid.fit(docs.filter(docs.lang.isNotNull() & ~langid.held_out()))
    again = langid.predict(docs.selectExpr("-doc_id as doc_id", "text", "'xx' as lang"), model)
    assert {-r.doc_id: r.lang_pred for r in again.collect()} == {k: r.lang_pred for k, r in languages.items()}


def test_most_frequent_are_exact(spark):
    rng = random.Random(9)
    rows = [(lang, f"p{k}", rng.randint(1, 30)) for lang in ("a", "b") for k in range(700)]
    got = {tuple(r) for r in langid.most_frequent(spark.createDataFrame(rows, "lang string, piece string, n bigint"), 37).collect()}
    want = {r for lang in ("a", "b") for r in sorted((r for r in rows if r[0] == lang), key=lambda r: (-r[2], r[1]))[:37]}
    assert got == want
