"""HTML text, WARC records, fingerprints, licenses and personal data."""

import hashlib
import html as entities
import json
import math
import random
import re
import textwrap
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import fingerprints, html_text, licenses, pii, queries, warc

PAGES = [
    ("<p>one<p>two<br>three", "one\n\ntwo\nthree"),
    ("<ul><li>a<li>b<ol><li>x<li>y</ol></ul>z", "* a\n* b\n 1. x\n 2. y\n\nz"),
    ("<table><tr><th>n<th>price<tr><td>apple<td>10</table>", "n     | price\napple | 10"),
    ("<table><tr><td colspan=2>wide title<tr><td>a<td>b</table>", "wide title\na | b"),
    ("a<script>x<b>1</b></script>b<style>p{}</style><!-- no --><noscript>q</noscript>c", "abc"),
    ("<div hidden>no<p>no</div>yes<span style='display: none'>no</span> <b>bold</b>", "yes bold"),
    ("<div hidden><table><tr><td>no</table></div><table><tr><td>in</table>", "in"),
    ("x &lt;y&gt; &amp;amp; &nbsp;z", "x <y> &amp;  z"),
    ("1 < 2 and <3", "1 < 2 and <3"), ("<pre>a\n  b</pre>c", "a\n  b\n\nc"), ("", ""), (None, ""), ("plain", "plain"), ("<p>unclosed <b>tags</p><i>go on", "unclosed tags\n\ngo on"), ("</div></p>stray", "stray"), ("<!-- open", ""), ("<script>never ends", ""),
    ("<h1>T</h1>x<hr>y <img alt='pic'>", "T\n\nx\n\ny pic"),
    ("<dl><dt>t<dd>d</dl>", "t\n  d"),
    ("<html><head><title>T</title><p>Hello", "Hello"), ("<head><meta charset=x><title>T</title>Hello", "Hello"), ("<head><noscript><img alt=no></noscript><title>T</title></head>Hello", "Hello"), ("<head><link rel=x>\n<style>p{}</style><h1>H</h1>x", "H\n\nx"),
    ("a <svg viewBox='0 0 1 1'/>b<p>c", "a b\n\nc"), ("a <svg><title/><path d='m'/><text>one</text><g><text>two</text></g><defs><text>no</text></defs>no</svg> b", "a one two b"), ("a <svg><path><p>b", "a\n\nb"),
    ("x <math><mi>y</mi><mo>=</mo><mn>2</mn></math> z", "x y=2 z"), ("<svg><foreignObject><p>in</p></foreignObject></svg>out", "in\n\nout"),
    ("pick <select><option>one<option>two<optgroup label=g><option>three</select> now", "pick\none\ntwo\nthree\nnow"), ("<datalist><option>no</datalist>yes", "yes"),
    ("<div style='visibility:hidden'>no<p style='visibility: visible'>shown</p>no</div>c", "shown\n\nc"), ("<table style='visibility:hidden'><tr><td>a<td>b</table>z", "z"), ("<ul><li style='visibility:hidden'>no<li>v</ul>z", "* v\n\nz"),
    ("<table><tr><td rowspan=2>A<td>B<tr><td>C<tr><td>D<td>E</table>", "A | B\n  | C\nD | E"), ("<table><tr><td>1<td rowspan=0>Z<tr><td>2</table>", "1 | Z\n2 |"), ("<table><tr><td colspan=2>a wide heading<td>x<tr><td>1<td>2<td>y</table>", "a wide heading | x\n1 | 2          | y"),
    ("<table><tr><td><table><tr><td>in1<td>in2<tr><td>in3 long<td>q</table><td>right<tr><td>left<td>r2</table>", "in1      | in2 | right\nin3 long | q   |\nleft           | r2"),
    ("<ol start=5><li>x<li value=9>y<li>z</ol><ul><li></ul>p", "5. x\n9. y\n10. z\n\np"), ("<input type=submit value='Send it'><input type=hidden value=no><input value=typed><input type=password value=no><button>Go</button>", "Send it typed Go"),
]


@pytest.mark.parametrize(("html", "text"), PAGES)
def test_rendering(html, text):
    assert html_text.render(html) == text


@pytest.mark.parametrize("html", ["a<textarea></textarea>b", "a&#1;b<p>&#1;</p>", "a<xmp></xmp><noembed></noembed><noframes></noframes>b"])
def test_empty_texts(html):
    assert html_text.render(html).replace("\n", "").startswith("a") and "b" in html_text.render(html)


@pytest.mark.parametrize("html,text", [
    ("<ruby>a<rp>(</rp><rt>b</rt><rp>)</rp></ruby>", "ab"), ("x<noembed>no</noembed><noframes>no</noframes>y", "xy"),
    ("a<dialog>no</dialog>b<dialog open>yes</dialog>", "ab\nyes"), ("<details>no<p>no</p><summary>s<b>t</b></summary><summary>no</summary><img alt=no></details>z", "st\nz"),
    ("<details open><summary>s</summary>body</details>", "s\nbody"), ("<details><summary>a</summary><details open><summary>no</summary></details></details>b", "a\nb"),
    ("<style>.a{display:none} #i, p.b {color:red;display: none !important}</style><p class='x a'>no</p><p id=i>no</p><p class=b>no</p><div class=b>d</div>", "d"),
    ("<style>.a{display:none}</style><style>/* .a{display:block} */ .c{display:none}.c{display:block}</style><p class=a style='display:block'>yes</p><p class=c>too</p>", "yes\n\ntoo"),
    ("<style>@media print{.a{display:none}} @media screen { .b{display:none} } @import 'x'; i{display:none}</style><p class=a>yes</p><p class=b>no</p>a<i>no</i>", "yes\n\na"),
    ("<style>span{display:none}.k{display:inline}#n{display:none}</style><span>no</span><span class=k>yes</span><span class=k id=n>no</span>", "yes"),
    ("<style>div p{display:none} a:hover{display:none} {} .z{display:none</style><div><p>yes</p></div><a>a</a><b class=z>no</b>", "yes\n\na"),
])
def test_hidden_by_default_and_by_rules(html, text):
    assert html_text.render(html) == text


def test_nested_pages_below_a_bound_are_linear():
    """Implied ends and end tags cost the same however deep the page is."""
    start = time.time()
    for page in ("<p><td>" + "<div>" * 100_000, "<table><tr><td>" + "<li>" * 100_000, "<ul><li>" + "<b>" * 100_000 + "</i></li>" * 1000, "<p><td>" + "<div></p>" * 50_000, "<dl>" + "<dt><div>" * 50_000 + "</dl>" * 100, "<style>" + "{" * 50_000 + ".a{display:none}" * 5000, "<details>" * 50_000 + "x"):
        html_text.render(page)
    assert time.time() - start < 20


def test_links_follow_the_base_and_lists_of_images():
    page = "<a href=' x '>a</a><base target=t><base href='/d/e/'><base href='/f/'><img src=i.png srcset='a.png 1x, b.png 2x,c.png' alt=c><source srcset='m.webp, https://o.example/n.webp 480w'>"
    links = warc.page_facts(list(html_text.tokens(page)), "https://h.example/p/q")[1]
    assert [x["url"].removeprefix("https://h.example") for x in links] == ["/d/e/x", "/d/e/i.png", "/d/e/a.png", "/d/e/b.png", "/d/e/c.png", "/d/e/m.webp", "https://o.example/n.webp"]
    assert warc.srcset_urls(" , ,") == [] and warc.srcset_urls("data:image/png,x 1x") == ["data:image/png,x"]


def test_deep_and_long_pages():
    assert html_text.render("<div>" * 20_000 + "x") == "x"
    assert html_text.render("<a " + "x" * 200_000) == ""
    assert len(html_text.render("<p>" + "word " * 100_000)) == 499_999


def test_all_visible_words_of_pages_are_kept(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    html = {r.page_id: r.html for r in pages.collect()}
    rows = html_text.extract_pages(pages.selectExpr("*", "1 as text")).collect()
    assert len(rows) == len(html)
    for r in rows:
        body = re.sub(r"(?s)<head.*?</head>|<script.*?</script>|<style.*?</style>|<!--.*?-->", " ", html[r.page_id])
        body = re.sub(r"<img[^>]*?\balt=(?:\"([^\"]*)\"|'([^']*)')[^>]*>", lambda m: m[1] or m[2] or "", body)
        body = re.sub(r"(?s)<ol[^>]*>.*?</ol>", lambda m: "".join(f" {i}. {x}" if i else x for i, x in enumerate(re.split(r"<li[^>]*>", m[0]))), body)
        words = entities.unescape(re.sub(r"<[^>]+>", " ", body)).replace("*", " ").replace("|", " ").split()
        kept = r.text.replace("*", " ").replace("|", " ").split()
        assert "".join(words) == "".join(kept), r.page_id


def test_derivatives(spark):
    url = "http://a.example/x/"
    pages = spark.createDataFrame([(1, url, "<title>T &amp; U</title><a href='b?c=1&amp;d'>l</a><p>hi"), (2, None, None), (1, url, "<title>T &amp; U</title><a href='b?c=1&amp;d'>l</a><p>hi"), (None, "bad\r\nX: y", "x")], "page_id int, url string, html string").selectExpr("*", "1 as block")
    sources = {(r.page_id, r.record_id): r for r in warc.responses(pages).collect()}
    rows = warc.derivatives(warc.responses(pages)).collect()
    assert len(rows) == 8 and len({r.record_id for r in rows}) == 6
    by_id = {r.record_id: r for r in rows}
    for r in rows:
        source = sources[r.page_id, r.refers_to]
        assert r.source_payload_digest == warc.digest(source.payload.encode()) and r.source_headers == source.http_headers
        assert by_id[r.linked_id].linked_id == r.record_id and by_id[r.linked_id].record_type != r.record_type
        assert r.block_digest == warc.digest(r.block.encode()) and r.content_length == len(r.block.encode())
        assert f"WARC-Refers-To: {r.refers_to}\r\n" in r.warc_headers and "\nX:" not in r.warc_headers
        record = warc.record_bytes(r.warc_headers, r.block)
        head, _, rest = record.partition(b"\r\n\r\n")
        length = int(re.search(rb"Content-Length: (\d+)", head)[1])
        assert rest[:length].decode() == r.block and rest[length:] == b"\r\n\r\n"
    meta = json.loads(next(r.block for r in rows if r.page_id == 1 and r.record_type == "metadata"))
    assert meta["html"] == {"title": "T & U", "links": [{"path": "a@/href", "url": "http://a.example/x/b?c=1&d"}]}
    assert ["Content-Type", "text/html; charset=utf-8"] in meta["source"]["headers"]
    assert next(r.block for r in rows if r.page_id == 1 and r.record_type == "conversion") == "l\n\nhi"
    assert warc.derivatives(warc.responses(pages.limit(0))).count() == 0


def test_record_identifiers_are_unique(spark):
    rows = [(None, "5", "x"), ("5", None, "x"), (None, None, "x"), ("5", "5", "x"), ("5", "5", "y"), ("5", "5", None), ("5", "5", ""), ("1 2", "3", "x"), ("1", "2 3", "x"), (None, None, None)]
    pages = spark.createDataFrame(rows, "page_id string, url string, html string").selectExpr("*", "'q' as record_id", "'q' as payload", "1 as block", "1 as shard")
    found = warc.derivatives(warc.responses(pages)).collect()
    assert len({r.record_id for r in found}) == len({r.refers_to for r in found}) * 2 == 2 * len(rows)
    assert all(re.fullmatch(r"<urn:uuid:[0-9a-f]{8}-[0-9a-f]{4}-5[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}>", r.refers_to) for r in found)


def test_dates_statuses_and_repeated_headers(spark):
    pages = spark.createDataFrame([(1, "http://a/", "x", "2025-05-05T05:05:05Z", "404 Not Found"), (2, "http://a/", "x", None, None)], "page_id int, url string, html string, at string, status string")
    by_id = {r.page_id: r for r in warc.responses(pages, date_col="at", status_col="status").collect()}
    assert by_id[1].warc_date == "2025-05-05T05:05:05Z" and by_id[1].http_headers.startswith("HTTP/1.1 404 Not Found\r\n") and by_id[2].http_headers.startswith("HTTP/1.1 200 OK")
    status, fields = warc.parse_headers("HTTP/1.1 200 OK\r\nSet-Cookie: a=1\r\nX: y\r\nSet-Cookie: b=2\r\n\r\n")
    assert status == "HTTP/1.1 200 OK" and fields == [["Set-Cookie", "a=1"], ["X", "y"], ["Set-Cookie", "b=2"]]
    long = warc.derive("<urn:uuid:1>", None, None, "", "<p>" + "word " * 300_000)
    assert long[1]["content_length"] == 1_499_999


# Fingerprints


M64 = (1 << 64) - 1


def slow_mix(x):
    x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 & M64
    x = (x ^ (x >> 27)) * 0x94D049BB133111EB & M64
    return x ^ (x >> 31)


def slow_level(names, level):
    """One level of the parsing, name by name."""
    runs = []
    for x in names:
        if runs and runs[-1][0] == x:
            runs[-1][1] += 1
        else:
            runs.append([x, 1])
    names = []
    for x, n in runs:
        if n > 1:
            x = slow_mix((x + n * 0x94D049BB133111EB) & M64)
            x = x >> 32 | 1 << 21 if level == 1 else x
        names.append(x)
    labels = names
    for _ in range(4):
        tossed = []
        for i, x in enumerate(labels):
            differs = x ^ labels[i - 1] if i else 1
            k = (differs & -differs).bit_length() - 1
            tossed.append(2 * k + (x >> k & 1))
        labels = tossed
    starts = [0] + [i for i in range(2, len(labels)) if labels[i] > labels[i - 1] and (i + 1 == len(labels) or labels[i] > labels[i + 1])]
    phrases = [names[a:b] for a, b in zip(starts, [*starts[1:], len(names)])]
    out = []
    for phrase in phrases:
        total = len(phrase)
        for k, x in enumerate(phrase):
            v = (x + 1) * 0xBF58476D1CE4E5B9 & M64
            v = (v ^ v >> 29) * pow(0x9E3779B97F4A7C15, k + 1, 1 << 64) & M64
            total += v
        out.append(slow_mix(total & M64))
    return out


def slow_sketch(text):
    names, kept = [ord(c) for c in text], set()
    for level in range(1, fingerprints.LAST_LEVEL + 1):
        names = slow_level(names, level) if names else []
        if level >= fingerprints.FIRST_LEVEL:
            kept |= {slow_mix(x) for x in names}
    return sorted(kept)[: fingerprints.SKETCH]


def test_parsing_equals_a_slow_one():
    rng = random.Random(3)
    texts = ["".join(rng.choice(a) for _ in range(rng.randint(0, 1500))) for a in ("ab", "aab c", "abcdefghijklmnop .", "é😀中a") for _ in range(12)] + ["", "a", "aa", "ab", "aba", "a" * 500, "ab" * 300]
    for text, got in zip(texts, fingerprints.sketches(texts), strict=True):
        assert got.tolist() == slow_sketch(text)


def test_interior_phrases_do_not_depend_on_the_offset():
    rng = random.Random(1)
    middle = "".join(rng.choice("abcdefgh ") for _ in range(4000))
    a, b = fingerprints.sketches(["start of one " + middle, "xx" + middle + " another end"])
    assert fingerprints.likeness(a, b) > 0.85
    plain, shifted = (set(fingerprints.next_level(np.frombuffer(t.encode("utf-32-le"), "<u4").copy(), np.array([0]))[0].tolist()) for t in (middle, "zq" + middle))
    assert len(plain & shifted) >= len(plain) - 6


def test_parsing_of_a_batch_equals_parsing_alone():
    rng = random.Random(2)
    texts = ["".join(rng.choice("aab c") for _ in range(rng.randint(0, 300))) for _ in range(80)] + ["", "a", "aaaa", "ab" * 500, "é😀" * 40]
    together = fingerprints.sketches(texts)
    for t, s in zip(texts, together, strict=True):
        assert (fingerprints.sketches([t])[0] == s).all()


def test_likeness_estimates_resemblance():
    rng = np.random.default_rng(4)
    for share in (0.2, 0.5, 0.9):
        pool = rng.permutation(np.unique(rng.integers(0, 1 << 62, 6000).astype(np.uint64)))
        both, rest = pool[: int(3000 * share)], pool[int(3000 * share) :]
        a, b = np.sort(np.concatenate([both, rest[:1000]])), np.sort(np.concatenate([both, rest[1000:2000]]))
        want = len(both) / (len(both) + 2000)
        assert abs(fingerprints.likeness(a[:96], b[:96]) - want) < 0.2
    assert fingerprints.likeness(np.empty(0), np.empty(0)) == 1.0 and fingerprints.likeness(np.empty(0), a[:96]) == 0.0


def check_fingerprints(found, ordered):
    """Rows against a plain walk over (id, text) in order."""
    own = {}
    for i, (doc, text) in enumerate(ordered):
        following = ordered[(i + 1) % len(ordered)][1]
        changed = fingerprints.edited(text, following)
        a, e, n = fingerprints.sketches([text, changed, following])
        own.setdefault((doc, fingerprints.encode(a)), []).append((len(text), hashlib.sha256(changed.encode()).hexdigest(), fingerprints.encode(e), round(fingerprints.likeness(a, e), 9), round(fingerprints.likeness(a, n), 9)))
    got = {}
    for r in found:
        got.setdefault((r.doc_id, r.fingerprint), []).append((r.n_chars, r.edited_sha256, r.edited_fingerprint, round(r.near_edited, 9), round(r.near_next, 9)))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in own.items()}


@pytest.mark.parametrize("size", [20_000, 1 << 22])
def test_fingerprints_of_a_table(docs, texts, size):
    rows = fingerprints.fingerprint_documents(docs, range_bytes=size).collect()
    check_fingerprints(rows, sorted((d, t or "") for d, t in texts.items()))  # no id twice
    assert np.mean([r.near_edited for r in rows]) > 0.25 > 0.1 > np.mean([r.near_next for r in rows])


def in_order(df):
    rows = df.select("doc_id", F.coalesce("text", F.lit("")).alias("t")).withColumn("h", F.xxhash64("t")).collect()
    return [(r.doc_id, r.t) for r in sorted(rows, key=lambda r: (r.doc_id is not None, r.doc_id or type(r.doc_id)(), r.h) if r.doc_id is not None else (False, 0, r.h))]


def test_few_keys_reach_the_driver(spark):
    """However many rows there are, ranges are at most about as many as asked for."""
    for n in (2_000, 20_000):
        rows = spark.range(n).select("id", F.repeat(F.lit("x"), 50).alias("text"), F.xxhash64("id").alias("hash"), F.col("id").alias("number"))
        assert 16 <= len(fingerprints.range_starts(rows, 64, 32)) <= 45


def test_fingerprints_of_odd_rows(odd_docs, no_docs):
    for size in (50, 1 << 22):
        check_fingerprints(fingerprints.fingerprint_documents(odd_docs, range_bytes=size).collect(), in_order(odd_docs))
    assert fingerprints.fingerprint_documents(no_docs).count() == 0


def test_skewed_repeated_and_named_ids_spread_over_tasks(spark):
    rng = random.Random(6)
    ids = [f"doc-{i}" for i in range(150)] + ["z"] * 100 + [None] * 250
    rows = [(d, "one text of all " * 4 if d in ("z", None) else " ".join(rng.choice("ab cd ef gh ij".split()) for _ in range(20))) for d in ids]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id string, text string").repartition(5)
    out = fingerprints.fingerprint_documents(df, range_bytes=4000)
    check_fingerprints(out.collect(), in_order(df))
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 500 and max(sizes) < 60
    wide = spark.createDataFrame([(1 << 60 if i == 0 else i % 7, f"t {i}") for i in range(90)], "doc_id bigint, text string")
    check_fingerprints(fingerprints.fingerprint_documents(wide, range_bytes=600).collect(), in_order(wide))


# Licenses

WORD = re.compile(licenses.WORD)
A_Z = str.maketrans(licenses.ascii_lower.__globals__["UPPER"], licenses.ascii_lower.__globals__["UPPER"].lower())


def brute_scan(text):
    lower = (text or "").translate(A_Z)
    words = WORD.findall(lower)
    places, base = [], set()
    for phrase, label in licenses.PHRASES.items():
        parts = phrase.split()
        at = [i for i in range(len(words)) if words[i : i + len(parts)] == parts]
        places += at
        base |= {label} if at else set()
    extra, best = set(), 0.0
    for block in re.split(licenses.BLOCK_END, lower):
        own = set(WORD.findall(block))
        shares = [(len(own & set(t)) / len(t), label) for label, t in licenses.template_sets(licenses.TEMPLATES)]
        hits = [(s, label) for s, label in shares if s >= licenses.CONTAINMENT - 1e-9]
        if hits:
            top = max(hits)[0]
            extra |= {label for s, label in hits if s == top}
            best = max(best, top)
    return (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(base | extra)), round(1.0 if places else best, 6))


def test_license_scan_equals_brute_force(spark, docs, texts):
    more = ["This work is licensed under the GNU Lesser General Public License.", "Released under an MIT license", "cc by cc by. CC  BY", "all rights  reserved all rights reserved", "Permission is hereby granted free of charge to any person obtaining a copy of this software and files", None, "", "license"]
    cases = {**texts, **{10_000_000 + i: t for i, t in enumerate(more)}}
    df = docs.select("doc_id", "text").unionByName(spark.createDataFrame([(10_000_000 + i, t) for i, t in enumerate(more)], "doc_id bigint, text string"))
    rows = licenses.scan_documents(df).collect()
    assert len(rows) == len(cases)
    for r in rows:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, round(r.score, 6)) == brute_scan(cases[r.doc_id]), r.doc_id


def test_license_templates_verbatim_and_wrapped(spark):
    rows = []
    for label, text in licenses.TEMPLATES:
        for width in (1000, 40, 24):
            rows.append((len(rows), label, "Some words\n\n" + "\n * ".join(textwrap.wrap(text, width)) + "\n\nmore words"))
    strewn = "all " + "one two three four five " * 20 + "rights " + "six seven eight nine ten " * 20 + "reserved"
    df = spark.createDataFrame([*((i, t) for i, _, t in rows), (-1, strewn)], "doc_id bigint, text string")
    got = {r.doc_id: (r.labels or "").split(",") for r in licenses.scan_documents(df).collect()}
    assert not [(label, t) for i, label, t in rows if label not in got[i]] and got[-1] == [""]


def test_all_licenses_of_a_block_count(spark):
    cases = {
        "All rights reserved, redistribution and use in source and binary forms, with or without modification, are allowed": "bsd,reserved", "Licensed under CC BY 4.0.": "cc-by", "Licensed under CC BY-SA 4.0.": "cc-by,cc-by-sa", "Licensed under CC BY-NC-SA 4.0.": "cc-by,cc-by-nc-sa",
        "all the rights we reserved": "", "Distributed under the Boost Software License, Version 1.0.": "bsl-1.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License v2.0": "epl",
        "Released under the MIT License, licensed under the Apache License, Version 2.0": "apache-2.0,mit", "Licensed under the GNU Affero General Public License": "agpl,gpl",
    }
    df = spark.createDataFrame(list(enumerate(cases)), "doc_id bigint, text string")
    assert [r.labels for r in licenses.scan_documents(df).orderBy("doc_id").collect()] == list(cases.values())


def test_every_block_over_the_threshold_is_reported(spark, docs, texts):
    """``set_labels`` are the exact set-similarity join, without windows or kin."""
    far = "permission is hereby granted " + "x " * 60 + "free of charge to any person obtaining a copy of this software and associated documentation files"
    cases = {**texts, 10_000_000: far, 10_000_001: "Licensed under the GNU Lesser General Public License", 10_000_002: None}
    df = spark.createDataFrame(list(cases.items()), "doc_id bigint, text string")
    for r in licenses.scan_documents(df).collect():
        want = set()
        for block in re.split(licenses.BLOCK_END, (cases[r.doc_id] or "").translate(A_Z)):
            own = set(WORD.findall(block))
            want |= {label for label, t in licenses.template_sets(licenses.TEMPLATES) if len(own & set(t)) >= licenses.CONTAINMENT * len(t) - 1e-9}
        assert r.set_labels == ",".join(sorted(want)), r.doc_id
    got = {r.doc_id: r for r in licenses.scan_documents(df.filter("doc_id >= 10000000")).collect()}
    assert got[10_000_000].set_labels == "mit" and got[10_000_000].labels == "" and got[10_000_001].labels == "gpl,lgpl" and "agpl" in got[10_000_001].set_labels


def test_license_scan_of_odd_rows(odd_docs, no_docs):
    rows = licenses.scan_documents(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    one = next(r for r in rows if r.doc_id == 1)
    assert (one.base_labels, one.n_base, one.first_word, one.last_word) == ("cc-by,gpl,reserved", 3, 2, 7)
    assert licenses.scan_documents(no_docs).count() == 0


# Personal data

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def brute_spans(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {"email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in m[0].split(".")), "card": 13 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if good:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


HARD = [
    "a@b.c%d@e.f x@@y.z a@b a@b. é.x@y.zz", "1.2.3.4.5.6.7.8 256.1.1.1 001.02.3.4 1.2.3 999999999999.1.1.1", "4111 1111 1111 1111 4111-1111-1111-1111 4111  1111 1111 1111 41111111111111112 1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6",
    "+1 (555) 123-4567 +1 23 +12345678901234567 ++1 555 555 5555. +1.555.555.5555)", "😀😀 me@x.org 中 1.2.3.4", "1" * 3000, "1-" * 3000, "+1 " + "2 " * 2000, "a." * 3000 + "@", None, "",
]


def test_base_spans_equal_plain_patterns(spark, docs, texts):
    cases = {**texts, **{10_000_000 + i: t for i, t in enumerate(HARD)}}
    df = docs.select("doc_id", "text").unionByName(spark.createDataFrame([(10_000_000 + i, t) for i, t in enumerate(HARD)], "doc_id bigint, text string"))
    found = pii.find_spans(df).collect()
    assert len(found) == len(cases)
    for r in found:
        assert [f"{s.kind}:{s.start}:{s.end}" for s in r.base] == brute_spans(cases[r.id]), r.id


def test_query_digest(spark, sf_dir, texts):
    for r in queries.op7_personal_data(spark, sf_dir).collect():
        want = brute_spans(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert r.n_email == sum(s.startswith("email") for s in want) and (r.spans or "").startswith(",".join(want))


def brute_terms(texts):
    """Term places by counting each pair of entity and near term over different texts."""
    texts = sorted({t or "" for t in texts})
    base = {t: [(k, int(a), int(b)) for k, a, b in (x.split(":") for x in brute_spans(t))] for t in texts}
    every = {t: {m[0].lower() for m in re.finditer(r"[^\W_]+", t)} for t in texts}
    words = {t: [(m[0].lower(), m.start(), m.end()) for m in re.finditer(r"[^\W_]+", t) if not any(x < m.end() and y > m.start() for _, x, y in base[t])] if base[t] else [] for t in texts}
    entities, near = {}, {}
    for t in texts:
        entities[t], near[t] = set(), set()
        places = sorted({a for _, a, _ in words[t]} | {a for _, a, _ in base[t]})
        for kind, a, b in base[t]:
            value = t[a:b].lower()
            digits = re.sub("[^0-9]", "", value)
            group = {"email": value.rpartition("@")[2], "ip": ".".join(value.split(".")[:2]), "card": digits[:6], "phone": digits[:4]}[kind]
            own = {(kind, value), (kind, "in", group)}
            entities[t] |= own
            near[t] |= {(e, w) for w, x, _ in words[t] if abs(places.index(x) - places.index(a)) <= pii.NEAR for e in own}
    df_term = Counter(w for t in texts for w in every[t])
    df_entity = Counter(e for t in texts for e in entities[t])
    co = Counter(pair for t in texts for pair in near[t])
    n, z, out = len(texts), pii.Z, {}

    def strong(e, w):
        m, p = df_term[w], co[e, w] / df_term[w]
        low = (p + z * z / (2 * m) - z * math.sqrt(p * (1 - p) / m + z * z / (4 * m * m))) / (1 + z * z / m)
        content = math.log2(n / df_entity[e])
        return content > 0 and math.log2(low) + content >= pii.DISCLOSURE * content

    for t in texts:
        told = {w for e, w in near[t] if strong(e, w)}
        out[t] = [(a, b) for w, a, b in words[t] if w in told]
    return out


def test_terms_equal_counting(spark, docs, texts):
    rng = random.Random(8)
    rare = ["okapi", "zebra", "quokka", "tapir", "Lemur"]
    more = [" ".join([rng.choice(rare), "writes", "mail", "to", f"p{rng.randint(0, 3)}@{rng.choice('ab')}.org", "and", rng.choice(rare), "10.0.0." + str(rng.randint(0, 2))]) for _ in range(30)]
    cases = {**texts, **{10_000_000 + i: t for i, t in enumerate(more)}}
    df = docs.select("doc_id", "text").unionByName(spark.createDataFrame([(10_000_000 + i, t) for i, t in enumerate(more)], "doc_id bigint, text string"))
    want, found = brute_terms(cases.values()), pii.find_spans(df).collect()
    assert len(found) == len(cases) and sum(len(r.terms) for r in found) > 20
    for r in found:
        assert [(t.start, t.end) for t in r.terms] == want[cases[r.id] or ""], r.id


def test_many_matches_in_one_text(spark):
    parts = [f"u{i}@mail.example 中😀 okapi{i % 900}" for i in range(20_000)]
    rows = [(0, " ".join(parts)), (1, "nothing here"), (2, None)] + [(3 + i, f"filler {i}") for i in range(80)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    start = time.time()
    one = pii.redact(df).filter("doc_id = 0").first().text
    assert time.time() - start < 60 and "@" not in one and one.count("[EMAIL]") == one.count("😀 okapi") + one.count("😀 [TERM]") == 20_000


def test_disclosing_terms(spark):
    rows = [(i, f"number {i} the zebrafish lab writes to boss@lab.example about item{i} today") for i in range(5)]
    rows += [(100 + i, f"the quick text number {i} writes about today and other{i} things") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r.id: [rows[r.id][1][t.start : t.end] for t in r.terms] for r in pii.find_spans(df).collect() if r.id < 100}
    assert all({"zebrafish", "lab"} <= set(t) for t in found.values())
    assert not any({"the", "about", "number", "item1"} & set(t) for t in found.values())
    clean = {r.doc_id: r.text for r in pii.redact(df).collect()}
    assert len(clean) == 65 and "boss@" not in clean[0] and "zebrafish" not in clean[0] and "[EMAIL]" in clean[0] and clean[0].startswith("number 0 the [TERM]")
    assert clean[100] == rows[5][1]


def test_support_counts_different_texts(spark):
    rows = [(i, "only zebrafish knows spy@lab.example well") for i in range(6)] + [(50 + i, f"filler {i}") for i in range(30)]
    found = pii.find_spans(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert all(not r.terms for r in found)


def test_terms_beside_an_entity_of_one_text(spark):
    rows = [(0, "mail the okapi breeder at solo@lab.example for more")] + [(1 + i, f"mail the quick text at number {i} for more") for i in range(200)]
    df = spark.createDataFrame(rows + [(999, rows[0][1])], "doc_id bigint, text string")
    for r in pii.find_spans(df).collect():
        got = {rows[0][1][t.start : t.end] for t in r.terms}
        assert got == ({"okapi", "breeder"} if r.id in (0, 999) else set())
    assert {r.text for r in pii.redact(df).filter("doc_id in (0, 999)").collect()} == {"mail the [TERM] [TERM] at [EMAIL] for more"}


def test_terms_are_marked_in_the_whole_text(spark):
    """A term beside an entity goes wherever it stands; words far from every entity stay, however rare."""
    text = "Okapi walrus. " + "mail the quick text for more " * 40 + "the okapi breeder solo@lab.example " + "mail the quick text for more " * 40 + "okapi heron"
    rows = [(0, text)] + [(1 + i, f"mail the quick text at number {i} for more") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r.id: [text[t.start : t.end] for t in r.terms] for r in pii.find_spans(df).collect()}
    assert found.pop(0) == ["Okapi", "okapi", "breeder", "okapi"] and not any(found.values())
    clean = pii.redact(df).filter("doc_id = 0").first().text
    assert clean.startswith("[TERM] walrus. mail the") and clean.endswith("for more [TERM] heron") and "kapi" not in clean


def test_few_words_go_and_names_beside_addresses_do(spark, docs, texts):
    """On the test documents less than one word in fifty of texts with an entity, all of planted names."""
    rng = random.Random(3)
    names = ["".join(rng.choices("bcdfghjklm", k=6)) + "owitsch" for _ in range(60)]
    planted = {10_000_000 + i: f"{texts[d] or ''} as {names[i]} ({names[i]}.{i}@firm{i % 7}.example) wrote" for i, d in enumerate(sorted(texts)[:60])}
    df = docs.select("doc_id", "text").unionByName(spark.createDataFrame(list(planted.items()), "doc_id bigint, text string"))
    found = {r.id: r for r in pii.find_spans(df).collect()}
    with_base = [r for r in found.values() if r.base and r.id in texts]
    gone = sum(len(r.terms) for r in with_base)
    assert gone < sum(len(re.findall(r"[^\W_]+", texts[r.id])) for r in with_base) / 50
    caught = [any(planted[i][t.start : t.end] == names[k] for t in found[i].terms) for k, i in enumerate(planted)]
    assert all(caught)


def test_shared_entities_of_long_texts(spark):
    """Two near copies with ten thousand addresses: work is linear in the matches."""
    parts = [f"u{i}@mail{i % 50}.example okapi{i % 900}" for i in range(10_000)]
    rows = [(0, " ".join(parts)), (1, " ".join([*parts, "more"]))] + [(3 + i, f"filler {i}") for i in range(80)]
    start = time.time()
    found = {r.id: r for r in pii.find_spans(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert time.time() - start < 60 and len(found[0].base) == len(found[1].base) == 10_000


def test_redaction_of_odd_rows(odd_docs, no_docs):
    out = pii.redact(odd_docs)
    assert out.columns == odd_docs.columns and out.count() == odd_docs.count()
    got = sorted((r.doc_id or 0, r.text or "") for r in out.collect())
    assert any("[EMAIL]" in t for d, t in got if d == 1) and pii.redact(no_docs).count() == 0
    extra = [c for c in odd_docs.columns if c not in ("doc_id", "text")]
    assert {tuple(r) for r in out.select(*extra).collect()} == {tuple(r) for r in odd_docs.select(*extra).collect()}
    joined = odd_docs.sparkSession.createDataFrame([(1, "a +378282246310005 x")], "doc_id bigint, text string")
    assert pii.redact(joined).first().text == "a [PHONE] x"  # a phone and, inside it, a card


def test_other_corpora_of_terms(odd_docs):
    assert pii.term_counts(odd_docs).filter("term = 'word'").first().df_term == 1
