"""Filter interaction audit: what each filter removes in every order of application.

A document is reduced to its cell: the part it belongs to and the letters of the filters
it fails. Cells are counted over all documents; there are at most 2^k of them in a part,
however many documents. Each cell then folds across the array of all k! orders
(``aggregate`` over an order's letters, ``transform`` over the orders) to an array of
k! * k structs weighted by its counts, and the arrays of a part's cells are merged by
elementwise sums. The order array is a literal of k! strings.

A text that many documents share is found by its SHA-256. The smallest id of each text is
an aggregate with partial sums; a document then asks for the pair of text and own id, so
the copies of one text, however many, are spread over all tasks.

Cases: a null text reads as empty; a null part as the empty string; a null id is smaller
than none and larger than none, so such a row never fails the copy filter; rows of one id
with one text are not copies of each other; several label rows of one id count as one that
is good (toxic) if any is; null labels count as neither; extra columns are ignored; an
empty table gives an empty result; texts may be of any length.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, slim, stored

#: Fewest words, least percentage of distinct words, largest percentage of capitals, symbols.
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS, SYMBOLS = 100, 80, 10, "[#$%&*|]"
SPACES = " \t\n\x0b\x0c\r"
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def text_failures(text: Column) -> dict[str, Column]:
    """The filters that look at one text: length, variety of words, capitals, symbols."""
    trimmed = F.trim(text, F.lit(SPACES))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, "[ \\t-\\r]+"))
    return {
        "A": F.size(words) < LEAST_WORDS,
        "B": 100 * F.size(F.array_distinct(words)) < LEAST_DISTINCT * F.size(words),
        "C": 100 * F.length(F.regexp_replace(text, "[^A-Z]+", "")) > MOST_CAPITALS * F.length(text),
        "D": text.rlike(SYMBOLS),
    }


def marked(docs: DataFrame, labels: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """(part, failed, good, toxic) of each document; ``failed`` holds the letters of the filters it fails.

    Texts are read once; what is shuffled afterwards is a digest and a few flags a document.
    """
    named = slim(docs, id_col, text_col, part_col).toDF("id", "text", "part").withColumns({"text": F.coalesce("text", F.lit("")), "part": F.coalesce(F.col("part").cast("string"), F.lit(""))})
    letters = [F.when(fails, letter).otherwise("") for letter, fails in text_failures(F.col("text")).items()]
    facts = scratch.stored(named.select("id", "part", F.sha2("text", 256).alias("digest"), F.concat(*letters).alias("failed")), "audit-facts")
    firsts = facts.filter("id IS NOT NULL").groupBy("digest").agg(F.min("id").alias("id")).withColumn("first", F.lit(True))
    is_one = lambda c: F.max(F.coalesce(F.col(c) == 1, F.lit(False))).cast("long")
    rated = slim(labels, "doc_id", "quality", "toxic").groupBy(F.col("doc_id").alias("id")).agg(is_one("quality").alias("good"), is_one("toxic").alias("toxic"))
    known = facts.join(firsts, ["digest", "id"], "left").join(rated, "id", "left")
    copy = F.when(F.col("id").isNotNull() & F.col("first").isNull(), "E").otherwise("")
    return known.select("part", F.concat("failed", copy).alias("failed"), F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))


def cells(rows: DataFrame) -> DataFrame:
    """Counts of each (part, failed)."""
    return rows.groupBy("part", "failed").agg(F.count("*").alias("n"), F.sum(F.col("good").cast("long")).alias("good"), F.sum(F.col("toxic").cast("long")).alias("toxic"))


def fold_orders(counted: DataFrame, filters: str = "ABCDE") -> DataFrame:
    """One row for each part, order and step from the counts of the cells."""
    orders = ["".join(p) for p in permutations(filters)]
    step = ", ".join(f"{c}: bigint" for c in COUNTS)
    listed = counted.withColumn("orders", F.array(*map(F.lit, orders)))
    # within a cell: has an earlier filter of the order removed it, and what the step at hand does
    folded = listed.selectExpr("part", f"""
        flatten(transform(orders, o -> aggregate(
            transform(sequence(1, {len(filters)}), i -> substring(o, i, 1)),
            named_struct('gone', false, 'steps', cast(array() AS array<struct<{step}>>)),
            (acc, f) -> named_struct(
                'gone', acc.gone OR contains(failed, f),
                'steps', array_append(acc.steps, named_struct(
                    'kept', if(acc.gone OR contains(failed, f), 0L, n),
                    'removed', if(contains(failed, f) AND NOT acc.gone, n, 0L),
                    'redundant', if(contains(failed, f) AND acc.gone, n, 0L),
                    'unique_fails', if(failed = f, n, 0L),
                    'good_lost', if(contains(failed, f) AND NOT acc.gone, good, 0L),
                    'toxic_lost', if(contains(failed, f) AND NOT acc.gone, toxic, 0L)))),
            acc -> acc.steps))) AS steps""")  # fmt: skip
    zero = "named_struct(" + ", ".join(f"'{c}', 0L" for c in COUNTS) + ")"
    sums = "named_struct(" + ", ".join(f"'{c}', a.{c} + b.{c}" for c in COUNTS) + ")"
    merged = folded.groupBy("part").agg(F.expr(f"aggregate(collect_list(steps), array_repeat({zero}, {len(orders) * len(filters)}), (acc, x) -> zip_with(acc, x, (a, b) -> {sums}))").alias("steps"))
    # a filter's share: what it removes, summed over all orders
    named = merged.withColumn("orders", F.array(*map(F.lit, orders))).selectExpr("part", f"""
        transform(steps, (s, i) -> named_struct('order', orders[i div {len(filters)}], 'step', cast(i % {len(filters)} + 1 AS int),
            'f', substring(orders[i div {len(filters)}], i % {len(filters)} + 1, 1), 's', s)) AS steps""")  # fmt: skip
    shares = named.withColumn("shares", F.expr(f"""
        map_from_arrays({_texts(filters)}, transform({_texts(filters)}, l -> aggregate(steps, 0L, (acc, x) -> acc + if(x.f = l, x.s.removed, 0L))))"""))  # fmt: skip
    rows = shares.select("part", "shares", F.explode("steps").alias("x"))
    return rows.select("part", F.col("x.order").alias("filter_order"), F.col("x.step").alias("step"), *(F.col(f"x.s.{c}").alias(c) for c in COUNTS), F.expr("shares[x.f]").alias("shapley"))


def _texts(letters: str) -> str:
    return "array(" + ", ".join(f"'{x}'" for x in letters) + ")"


def audit(docs: DataFrame, labels: DataFrame, **columns: str) -> DataFrame:
    """The whole audit; only the counts of the cells are kept in the shared folder."""
    with Scratch(docs.sparkSession) as scratch:
        counted = stored(cells(marked(docs, labels, scratch, **columns)), "audit-cells")
    return fold_orders(counted)


#: The audit in SQL, by windows in place of folds. ``part`` is the language.
ORACLE_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
rated AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
marks AS (
    SELECT d.doc_id, part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
        CASE WHEN len(words) < {LEAST_WORDS} THEN 'A' ELSE '' END
        || CASE WHEN 100 * len(list_distinct(words)) < {LEAST_DISTINCT} * len(words) THEN 'B' ELSE '' END
        || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > {MOST_CAPITALS} * length(t) THEN 'C' ELSE '' END
        || CASE WHEN regexp_matches(t, '{SYMBOLS}') THEN 'D' ELSE '' END
        || CASE WHEN d.doc_id > min(d.doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END AS failed
    FROM d LEFT JOIN rated ON d.doc_id = rated.doc_id),
cells AS (SELECT part, failed, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM marks GROUP BY part, failed),
l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
    SELECT a.x || b.x || c.x || d.x || e.x AS o FROM l a, l b, l c, l d, l e
    WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (SELECT o, i, substr(o, i, 1) AS f, substr(o, 1, i - 1) AS before FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS i)),
folded AS (
    SELECT part, o, i, f, failed, n, good, toxic, contains(failed, f) AS fails,
        translate(failed, before, '') <> failed AS gone
    FROM cells, steps),
summed AS (
    SELECT part, o AS filter_order, i::INTEGER AS step, f,
        sum(CASE WHEN gone OR fails THEN 0 ELSE n END)::BIGINT AS kept, sum(CASE WHEN fails AND NOT gone THEN n ELSE 0 END)::BIGINT AS removed,
        sum(CASE WHEN fails AND gone THEN n ELSE 0 END)::BIGINT AS redundant, sum(CASE WHEN failed = f THEN n ELSE 0 END)::BIGINT AS unique_fails,
        sum(CASE WHEN fails AND NOT gone THEN good ELSE 0 END)::BIGINT AS good_lost, sum(CASE WHEN fails AND NOT gone THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
    FROM folded GROUP BY part, o, i, f)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley FROM summed
"""
