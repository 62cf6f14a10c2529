"""Spelling variants: words one edit apart, found by pivotal grams.

Bigrams are ordered from rare to frequent (by the number of words that hold them). With
one edit allowed, a word's gram prefix is its three first grams in that order, and two
disjoint grams of the prefix of least total frequency, chosen by dynamic programming, are
its pivots. One edit can't touch both pivots, so of two near words the one whose prefix
ends earlier has a pivot that stands in the other's prefix. Pivots are joined with
prefixes on the gram.

Position limits: around a gram that survives, the edit lies on one side of it, so the other
side is equal, and the gram is as far from that end in either word. The side with the edit
is cut in two halves, one of which is equal too. What is equal (the gram, its place, the two
outer pieces) is hashed to the key of the join, so words meet only if they agree but for
one region of at most half a side, with lengths one apart at most. This replaces a list
of all words of a gram: no key gathers a share of the words. Every meeting is verified by
the edit distance itself, so hashes can't add a pair.

Words are counted in tasks and summed; the order of bigrams is broadcast (at most 90^2 rows,
as the alphabet has 90 letters) and no table else: joins are merges by hint, because Spark
sizes keys by the files of the words they are made from, a hundredth of what keys hold, and
would send them through the driver. Forms lead from a word to one that is at least twice as
frequent, so a chain of forms is never longer than log2 of the largest count, and roots are found by
doubling in as many steps as that number has bits.

Cases: a null text has no words; a null id reads as an empty string; repeated rows count
each; runs and words may be of any length; ties between forms go to the smaller word in
code-point order; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import UPPER, Scratch, slim, stored

RUN = re.compile("[A-Za-zÀ-ÿ]+")
#: One run in so many loses a letter; shortest word, fewest occurrences.
NOISE, LEAST_LETTERS, LEAST_COUNT = 97, 5, 3
#: Bigrams, and grams of a prefix for one edit (2 * 1 + 1).
Q, PREFIX = 2, 3
#: Distinct words that a task counts before it passes them on.
FLUSH = 200_000

_LOWER = str.maketrans(UPPER, UPPER.lower())


def runs(text: str) -> Counter:
    """Runs of letters with A-Z in lower case."""
    return Counter(RUN.findall(text.translate(_LOWER)))


def noisy(doc_id: str, run: str) -> str:
    """The run, or for one in ``NOISE`` by checksum the run without one letter."""
    h = zlib.crc32(f"{doc_id}:{run}".encode())
    if h % NOISE:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST_COUNT) -> DataFrame:
    """(word, n) over all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"word": pa.array(found.keys(), pa.string()), "n": pa.array(found.values(), pa.int64())})

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for run, n in runs(text or "").items():
                    word = noisy(doc_id or "", run)
                    if len(word) >= LEAST_LETTERS:
                        found[word] += n
                if len(found) >= FLUSH:
                    yield out()
                    found.clear()
        yield out()

    rows = slim(docs, id_col, text_col).select(F.col(id_col).cast("string"), text_col)
    return rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


def gram_order(words: DataFrame) -> dict[str, int]:
    """Rank of each bigram, the rarest first. At most 90^2 rows reach the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in batches:
            for word in batch.column(0).to_pylist():
                found.update({word[i : i + Q] for i in range(len(word) - Q + 1)})
        yield pa.RecordBatch.from_pydict({"gram": pa.array(found.keys(), pa.string()), "n": pa.array(found.values(), pa.int64())})

    summed = words.select("word").mapInArrow(count, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    return {gram: k for k, (n, gram) in enumerate(sorted((n, gram) for gram, n in summed.collect()))}


def first_grams(ranks: list[int]) -> list[int]:
    """Places of the three first grams in the order (equal ones by place), by place."""
    return sorted(sorted(range(len(ranks)), key=lambda i: (ranks[i], i))[:PREFIX])


def prefix_grams(ranks: list[int]) -> list[int]:
    """Places where a pivot of a near word may stand: those of grams up to the third in the order.

    Of equal grams a pivot is one of the first three, and one edit makes two new grams at
    most, so the first five hold it.
    """
    last, seen = max(ranks[i] for i in first_grams(ranks)), Counter()
    out = []
    for i, r in enumerate(ranks):
        if r <= last and seen[r] < PREFIX + Q:
            seen[r] += 1
            out.append(i)
    return out


def pivots(ranks: list[int], prefix: list[int], k: int = 2) -> list[int]:
    """Places of ``k`` disjoint grams of the prefix with the least total rank.

    best[j]: least total of j grams among those before the one at hand, with their places;
    a gram joins the best choice that ends at least Q places before it.
    """
    choices: list[list[tuple[int, list[int]] | None]] = [[(0, [])] + [None] * k]
    for i, at in enumerate(prefix):
        before = choices[i]
        free = choices[next((x for x in range(i, 0, -1) if prefix[x - 1] + Q <= at), 0)]
        now = list(before)
        for j in range(1, k + 1):
            if free[j - 1] is not None:
                with_it = (free[j - 1][0] + ranks[at], [*free[j - 1][1], at])
                if now[j] is None or with_it < now[j]:
                    now[j] = with_it
        choices.append(now)
    return choices[-1][k][1]


def regions(at: int, length: int) -> list[tuple[int, int]]:
    """Where an edit may be in a word of that length whose gram at ``at`` survives: halves of either side."""
    out = []
    for start, end in ((0, at), (at + Q, length)):
        middle = (start + end) // 2
        out += [(start, middle), (middle, end)] if end - start > 2 else [(start, end)]
    return out


def _key(word: str, at: int, left_side: bool, head: int, tail: int) -> int:
    """What two words share outside of a region: a gram, its place from the nearer end, and both outer pieces."""
    place = len(word) - at if left_side else at
    text = f"{word[at : at + Q]}{'<' if left_side else '>'}{place}/{head}/{word[:head]}/{word[len(word) - tail :] if tail else ''}"
    return xxhash.xxh3_64_intdigest(text) - (1 << 63)


def pivot_keys(word: str, places: list[int]) -> set[int]:
    """Keys of a word's pivots: one for each region that may hold the edit."""
    n = len(word)
    return {_key(word, at, end <= at, start, n - end) for at in places for start, end in regions(at, n)}


def prefix_keys(word: str, places: list[int]) -> set[int]:
    """Keys under which a near word of length one less, equal or one more would ask for this word by a gram of its prefix."""
    n, out = len(word), set()
    for other in (n - 1, n, n + 1):
        for at in places:
            # on the left of an edit places are counted from the start, on its right from the end
            for place, left_side in ((at, False), (at + other - n, True)):
                if 0 <= place <= other - Q:
                    for start, end in regions(place, other):
                        if (end <= place) == left_side and start + other - end <= n:
                            out.add(_key(word, at, left_side, start, other - end))
    return out


def keyed(words: DataFrame, order: dict[str, int], asking: bool) -> DataFrame:
    """(key, word, n, last) of the pivots (asking) or of the prefixes; ``last`` is the rank at which the prefix ends."""
    shared = words.sparkSession.sparkContext.broadcast(order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = shared.value
        for batch in batches:
            keys, owners, lasts = [], [], []
            for at, word in enumerate(batch.column(0).to_pylist()):
                ranks = [rank[word[i : i + Q]] for i in range(len(word) - Q + 1)]
                first = first_grams(ranks)
                own = pivot_keys(word, pivots(ranks, first)) if asking else prefix_keys(word, prefix_grams(ranks))
                keys += own
                owners += [at] * len(own)
                lasts += [max(ranks[i] for i in first)] * len(own)
                if len(keys) >= FLUSH:
                    yield out(batch, keys, owners, lasts)
                    keys, owners, lasts = [], [], []
            yield out(batch, keys, owners, lasts)

    def out(batch: pa.RecordBatch, keys: list[int], owners: list[int], lasts: list[int]) -> pa.RecordBatch:
        own = batch.take(pa.array(owners, pa.int64()))
        return pa.RecordBatch.from_pydict({"key": pa.array(keys, pa.int64()), "word": own.column(0), "n": own.column(1), "last": pa.array(lasts, pa.int32())})

    return words.select("word", "n").mapInArrow(run, "key long, word string, n long, last int")


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, n_a, b, n_b), each two words one edit apart once, in the direction in which the index found them."""
    order = gram_order(words)
    asks = keyed(words, order, True).toDF("key", "a", "n_a", "last_a")
    has = keyed(words, order, False).toDF("key", "b", "n_b", "last_b")
    # the word whose prefix ends earlier asks; where both end alike, the smaller one
    directed = (F.col("last_a") < F.col("last_b")) | (F.col("last_a") == F.col("last_b")) & (F.col("a") < F.col("b"))
    met = asks.join(has.hint("merge"), "key").filter(directed & (F.levenshtein("a", "b", 1) == 1))
    return met.select("a", "n_a", "b", "n_b").distinct()


def roots_of(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(word, root) by doubling: each step replaces a word's pointer by its pointer's pointer."""
    ahead = scratch.stored(links.select("word", F.col("form").alias("root")), "variant-roots")
    while True:
        step = ahead.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = scratch.stored(ahead.join(step.hint("merge"), "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "variant-roots")
        if moved.filter("moved").isEmpty():
            return moved.select("word", "root")
        ahead = moved.select("word", "root")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST_COUNT) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word."""
    with Scratch(docs.sparkSession) as scratch:
        words = scratch.stored(count_words(docs, id_col, text_col, least), "variant-words")
        one = lambda x, y: F.struct(F.col(x).alias("word"), (-F.col(f"n_{y}")).alias("minus"), F.col(y).alias("other"))
        both = near_pairs(words).select(F.inline(F.array(one("a", "b"), one("b", "a"))))
        best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct("minus", "other")).alias("best"))
        enough = -F.col("best.minus") >= 2 * F.col("n")
        forms = words.join(best.hint("merge"), "word", "left").select("word", F.when(enough, F.col("best.other")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(enough, -F.col("best.minus")).alias("form_n"))
        forms = scratch.stored(forms, "variant-forms")
        ends = roots_of(forms.filter("form IS NOT NULL"), scratch)
        found = forms.join(ends.hint("merge"), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
        return stored(found, "variants")


#: The same in SQL: words one edit apart agree when a letter of each, at the same place, or of one of them, is cut out.
ORACLE_SQL = """
WITH RECURSIVE
found AS (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents),
runs AS (SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n FROM found GROUP BY ALL),
hexed AS (SELECT run, n, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS x FROM runs),
hashed AS (SELECT run, n, xor(list_reduce(
    list_transform(range(1, length(x), 2), lambda i: (16 * (instr('0123456789ABCDEF', substr(x, i, 1)) - 1) + instr('0123456789ABCDEF', substr(x, i + 1, 1)) - 1)::BIGINT),
    lambda c, b: list_reduce([xor(c, b), 1, 1, 1, 1, 1, 1, 1, 1], lambda v, k: xor(v >> 1, 3988292384 * (v & 1))), 4294967295::BIGINT), 4294967295) AS h FROM hexed),
words AS (SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word, n FROM hashed),
counted AS (SELECT word, sum(n)::BIGINT AS n FROM words WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
cuts AS (SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM (SELECT word, n, unnest(range(0, length(word))) AS i FROM counted)),
near AS (
    SELECT DISTINCT a.word, a.n, b.word AS other, b.n AS other_n FROM cuts a JOIN cuts b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
    UNION SELECT a.word, a.n, b.word, b.n FROM cuts a JOIN counted b ON a.rest = b.word
    UNION SELECT b.word, b.n, a.word, a.n FROM cuts a JOIN counted b ON a.rest = b.word),
best AS (SELECT word, count(*) AS n_near, arg_min(other, row(-other_n, other)) AS other, max(other_n) AS other_n FROM near GROUP BY word),
forms AS (SELECT c.word, CASE WHEN other_n >= 2 * n THEN other END AS form, n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 2 * n THEN other_n END AS form_n FROM counted c LEFT JOIN best b ON c.word = b.word),
chain AS (SELECT word, word AS last_word, form AS next FROM forms UNION ALL SELECT chain.word, forms.word, forms.form FROM chain JOIN forms ON chain.next = forms.word)
SELECT forms.word, form, last_word AS root, n, n_near, form_n FROM forms JOIN chain ON forms.word = chain.word AND chain.next IS NULL
"""
