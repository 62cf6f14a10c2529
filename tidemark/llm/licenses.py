"""License scans: an exact set-similarity join of text blocks with license templates.

Templates and blocks (sentences of each paragraph, over its joined lines) are sets
of words. Tokens are
ordered by how rarely they occur in the corpus. A block holds at least the share
``CONTAINMENT`` of a template's tokens only if it has one of the template's
rarest tokens (prefix filter), enough of its tokens at all (length filter) and
enough of them after the first common one (positional filter); what passes is
verified exactly, in the block's windows of the template's length and half of it more
(and ``SLACK`` words), so that words strewn over a long block make no statement.

The templates are a fixed list, so their tokens, the token counts and the prefix
index are small whatever the corpus; blocks without a prefix token are never
expanded. Built-in expressions only.

Cases: a null text counts as empty (no words, no labels, score 0); repeated rows
and null ids give a row each; extra columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, slim

CONTAINMENT = 0.8
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BLOCK_END = r"\n\s*\n|(?<=[.!?])\s"
SLACK = 4

#: Fixed phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Opening statements of licenses and single sentences of their texts. Statements of three words are left to ``PHRASES``: as sets they'd fit other sentences.
TEMPLATES = [
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "You may not use this file except in compliance with the License; you may obtain a copy of the License at apache.org"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("lgpl", "Licensed under the GNU Lesser General Public License"),
    ("agpl", "Licensed under the GNU Affero General Public License"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related rights to this work"),
    ("cc-by-nc-sa", "Licensed under CC BY-NC-SA 4.0."),
    ("cc-by-nd", "Licensed under CC BY-ND 4.0."),
    ("mit", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("bsd", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."),
    ("bsd", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("bsl-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("bsl-1.0", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license"),
    ("epl", "This program and the accompanying materials are made available under the terms of the Eclipse Public License"),
    ("zlib", "This software is provided 'as-is', without any express or implied warranty."),
    ("zlib", "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely"),
    ("unlicense", "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("wtfpl", "Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and changing it is allowed as long as the name is changed."),
    ("ofl-1.1", "This Font Software is licensed under the SIL Open Font License, Version 1.1."),
    ("artistic-2.0", "This is free software, licensed under the Artistic License 2.0."),
]

#: Words without which a block isn't of a label's license: its kin share all others.
REQUIRED = {"lgpl": ["lesser"], "agpl": ["affero"], "cc-by-nc": ["nc"], "cc-by-sa": ["sa"], "cc-by-nd": ["nd"], "cc-by-nc-sa": ["nc", "sa"]}
#: Kin of which only the likest in a block count.
FAMILY = {"gpl": "gpl", "lgpl": "gpl", "agpl": "gpl"} | dict.fromkeys(("cc-by-nc", "cc-by-sa", "cc-by-nd", "cc-by-nc-sa"), "cc")


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def template_sets(templates: list[tuple[str, str]]) -> list[tuple[str, list[str]]]:
    """Label and distinct tokens of each template."""
    return [(label, sorted({w for w in re.findall(r"[a-z0-9]+", text.lower())})) for label, text in templates]


def window_share(words: Column, tokens: Column, length: Column) -> Column:
    """The largest share of a template's tokens in ``length`` consecutive words of a block."""
    at = F.filter(F.sequence(F.lit(1), F.size(words)), lambda i: F.array_contains(tokens, F.get(words, i - 1)))
    return F.array_max(F.transform(at, lambda i: F.size(F.array_intersect(F.slice(words, i, length), tokens)))) / F.size(tokens)


def phrase_places(lower: Column, words: Column, phrase: str) -> Column:
    """Starts (words from 0) of all places where a phrase's words stand consecutively."""
    parts = phrase.split()
    gap = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"
    near = lower.contains(parts[-1]) & F.rlike(lower, F.lit(rf"(?:^|{gap}){(gap + '++').join(parts)}(?:$|{gap})"))
    at = F.filter(F.sequence(F.lit(0), F.size(words) - len(parts)), lambda i: _all([F.get(words, i + k) == w for k, w in enumerate(parts)]))
    return F.when(near, at).otherwise(F.array().cast("array<int>"))


def _all(tests: list[Column]) -> Column:
    out = tests[0]
    for t in tests[1:]:
        out = out & t
    return out


def token_counts(words: DataFrame, tokens: list[str]) -> dict[str, int]:
    """In how many documents each template token occurs; a row for each token reaches the driver."""
    hit = words.select(F.explode(F.array_intersect("words", F.array(*map(F.lit, tokens)))).alias("token"))
    return {r["token"]: r["n"] for r in hit.groupBy("token").agg(F.count("*").alias("n")).collect()}


def scan_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: list[tuple[str, str]] | None = None, containment: float = CONTAINMENT) -> DataFrame:
    """Base places and labels, and the labels of all templates that a block holds.

    ``labels`` are those of blocks that also pass the windows and the rules about kin;
    ``set_labels`` those of every block that meets the containment threshold as a set of words.
    """
    spark = docs.sparkSession
    sets = template_sets(templates or TEMPLATES)
    vocabulary = sorted({t for _, s in sets for t in s})
    rows = slim(docs, id_col, text_col).select(F.col(f"`{id_col}`").alias("id"), ascii_lower(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))).alias("lower"))
    worded = rows.withColumn("words", words_of(F.col("lower")))
    counts = token_counts(worded, vocabulary)
    rank = {t: i for i, t in enumerate(sorted(vocabulary, key=lambda t: (counts.get(t, 0), t)))}
    lengths = [n + n // 2 + SLACK for n in (len(re.findall(r"[a-z0-9]+", text.lower())) for _, text in templates or TEMPLATES)]
    index, prefix_tokens = [], set()
    for n, (label, tokens) in enumerate(sets):
        ordered = sorted(tokens, key=rank.__getitem__)
        need = math.ceil(containment * len(ordered) - 1e-9)
        for at, token in enumerate(ordered[: len(ordered) - need + 1]):
            prefix_tokens.add(token)
            index.append((token, n, label, at, need, lengths[n], ordered, REQUIRED.get(label), FAMILY.get(label, label)))
    prefixes = spark.createDataFrame(index, "token string, template int, label string, at int, need int, length int, tokens array<string>, required array<string>, family string")
    least = min((x[4] for x in index), default=1)

    gap = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"
    starts = F.lit(rf"(?:^|{gap})(?:{'|'.join(sorted(prefix_tokens))})(?:$|{gap})")
    places = {label: phrase_places(F.col("lower"), F.col("words"), phrase) for phrase, label in PHRASES.items()}
    blocks = F.when(F.arrays_overlap("words", F.array(*map(F.lit, sorted(prefix_tokens)))), F.filter(F.split("lower", BLOCK_END), lambda b: F.rlike(b, starts))).otherwise(F.array().cast("array<string>"))
    order = F.create_map(*[F.lit(x) for t in vocabulary for x in (t, rank[t])])
    found = worded.select("id", F.size("words").cast("long").alias("n_words"), blocks.alias("blocks"), *(p.alias(f"p_{label}") for label, p in places.items())).withColumn("rid", F.monotonically_increasing_id())
    every = F.concat(*(F.col(f"`p_{label}`") for label in places))
    base = F.filter(F.array(*(F.when(F.size(F.col(f"`p_{label}`")) > 0, label) for label in places)), lambda x: x.isNotNull())
    found = found.select("rid", "id", "n_words", "blocks", F.size(every).cast("long").alias("n_base"), F.array_min(every).cast("long").alias("first_word"), F.array_max(every).cast("long").alias("last_word"), base.alias("base"))
    block = found.select("*", F.posexplode_outer("blocks").alias("number", "block")).drop("blocks")
    known = F.transform(F.array_intersect(words_of(F.col("block")), F.array(*map(F.lit, vocabulary))), lambda t: F.struct(F.element_at(order, t).alias("rank"), t.alias("token")))
    ranked = block.withColumn("words", words_of(F.col("block"))).withColumn("known", F.array_sort(F.coalesce(known, F.array().cast("array<struct<rank:int,token:string>>"))))
    # Length filter before expanding: too few known tokens can't reach any template.
    ranked = ranked.withColumn("known", F.when(F.size("known") >= least, F.transform("known", lambda k: k["token"])).otherwise(F.array().cast("array<string>")))
    tokens = ranked.select("rid", "id", "n_words", "n_base", "first_word", "last_word", "base", "number", "known", "words", F.posexplode_outer("known").alias("pos", "token"))
    joined = tokens.join(F.broadcast(prefixes), "token", "left")
    likely = F.least(F.size("tokens") - F.col("at"), F.size("known") - F.col("pos")) + F.least("at", "pos") >= F.col("need")
    reached = likely & (F.size("known") >= F.col("need")) & (F.size(F.array_intersect("known", "tokens")) >= F.col("need"))
    share = F.when(reached, window_share(F.col("words"), F.col("tokens"), F.col("length"))).otherwise(0.0)
    verified = joined.withColumns({"share": share, "reached": reached}).withColumn("hit", (F.col("share") * F.size("tokens") >= F.col("need") - 1e-6) & (F.col("required").isNull() | (F.size(F.array_except("required", "known")) == 0)))
    pair = F.struct(F.col("number").alias("block"), "share", "label", "family", F.size("tokens").alias("n"))
    one = verified.groupBy("rid").agg(*(F.first(c).alias(c) for c in ("id", "n_words", "n_base", "first_word", "last_word", "base")), F.collect_set(F.when(F.col("hit"), pair)).alias("pairs"), F.collect_set(F.when(F.col("reached"), F.col("label"))).alias("reached"))
    # All licenses of a block count, but of kin, which share most words, only the likest, and of these the longest.
    extra = F.transform(F.filter("pairs", lambda p: ~F.exists("pairs", lambda q: (q["block"] == p["block"]) & (q["family"] == p["family"]) & ((q["share"] > p["share"]) | (q["share"] == p["share"]) & (q["n"] > p["n"])))), lambda p: p["label"])
    joined_labels = F.array_join(F.array_sort(F.array_union("base", extra)), ",")
    score = F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce(F.array_max(F.transform("pairs", lambda p: p["share"])), F.lit(0.0)))
    return one.select(F.col("id").alias(id_col), "n_words", "n_base", "first_word", "last_word", F.array_join(F.array_sort("base"), ",").alias("base_labels"), joined_labels.alias("labels"), score.alias("score"), F.array_join(F.array_sort("reached"), ",").alias("set_labels"))
