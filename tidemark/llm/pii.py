"""Personal data: fixed patterns, then information-theoretic sanitisation of what surrounds them.

Patterns find protected entities: addresses and numbers, and the groups that they
belong to (a mail domain, a network, a number's prefix). Words beside an entity may
reveal it even when the entity itself is gone. The evidence is about pairs: ``co`` counts
the different texts in which a term stands at most ``NEAR`` places (words and matches, in
order) from the entity or from a member of its group. Of all D texts df_entity have the entity and df_term the
term. PMI = log2((co / df_term) / (df_entity / D)) says how much more likely the entity is where
the term is; for co / df_term the lower end of its Wilson interval is taken (``Z``), so a
pair seen once or twice weighs less than the same share of many. The entity's information
content is IC = log2(D / df_entity). A term whose PMI is at least ``DISCLOSURE`` of the IC tells the
entity apart, and all its places in the texts where it stands beside the entity become
spans of kind ``term``. Being rare is not enough: a word far from every entity is never one.
``redact`` replaces spans by general names.

Only built-in expressions. All counts are of different texts.

Work on one text grows with its length and its matches, not with their product: spans
are placed block by block, overlaps are found by windows over a text's spans, a match
meets at most 2 * ``NEAR`` words, and ``redact`` cuts its pieces from blocks of the text.

Cases: a null text counts as empty; a null id is kept; texts and their matches may be of
any number that fits a row; repeated rows (same id and text) get the same spans; spans of
different kinds may overlap and ``redact`` joins overlapping ones, under the name of the
first; extra columns are ignored or, in ``redact``, kept whatever their names; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import slim, stored

#: Share of the information content; places between a term and an entity; one-sided 90 % interval.
DISCLOSURE, NEAR, Z = 0.8, 5, 1.28
#: Matches placed in one fold, and characters of a text's blocks.
BLOCK, PIECE = 256, 4096
KINDS = ("email", "ip", "card", "phone", "term")
NAMES = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]", "term": "[TERM]"}

# Possessive repeats and look-behinds keep the matches of the plain patterns but
# need no backtracking or recursion on very long texts.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){12,}+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
TERM = r"[\p{L}\p{N}]+"
SPAN = "array<struct<kind:string,start:int,end:int,value:string>>"


def no_spans() -> Column:
    return F.array().cast(SPAN)


def matches(text: Column, pattern: str, kind: str) -> Column:
    """Spans of a pattern's matches, from the matches and the text between them."""
    found, gaps = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    pair = F.struct(found.alias("m"), gaps.alias("g"))
    return F.element_at(F.transform(F.array(pair), lambda p: _placed(p["m"], p["g"], kind)), 1)


def _placed(found: Column, gaps: Column, kind: str) -> Column:
    """Folds blocks of ``BLOCK`` matches, each from where the one before it ends: a fold copies what it has at each step."""
    n = F.size(found)
    step_of = lambda i: F.length(F.get(gaps, i)) + F.length(F.get(found, i))
    upto = lambda first: F.sequence(first, F.least(first + BLOCK, n) - 1)

    def ahead(acc: Column, first: Column) -> Column:
        end = acc["at"] + F.aggregate(upto(first), F.lit(0), lambda a, i: a + step_of(i))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(F.struct(first.alias("first"), acc["at"].alias("at")))).alias("out"))

    def step(acc: Column, i: Column) -> Column:
        value = F.get(found, i)
        end = acc["at"] + step_of(i)
        span = F.struct(F.lit(kind).alias("kind"), (end - F.length(value)).alias("start"), end.alias("end"), value.alias("value"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))

    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<first:int,at:int>>").alias("out"))
    blocks = F.aggregate(F.sequence(F.lit(0), n - 1, F.lit(BLOCK)), begin, ahead, lambda acc: acc["out"])
    spans = F.transform(blocks, lambda b: F.aggregate(upto(b["first"]), F.struct(b["at"].alias("at"), no_spans().alias("out")), step, lambda acc: acc["out"]))
    return F.when(n > 0, F.flatten(spans)).otherwise(no_spans())


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _small_parts(value: Column) -> Column:
    """Every dotted part is at most 255."""
    def small(part: Column) -> Column:
        core = F.regexp_replace(part, "^0+(?=[0-9])", "")
        return (F.length(core) < 3) | (F.length(core) == 3) & (core <= "255")

    return F.forall(F.split(value, "[.]"), small)


def _luhn(value: Column) -> Column:
    """13 to 19 digits whose Luhn sum ends in 0."""
    digits = F.reverse(_digits(value))
    n = F.length(digits)
    values = F.transform(F.split(digits, "(?<=.)(?=.)"), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)))
    total = F.aggregate(values, F.lit(0), lambda a, x: a + x)
    return F.when((n >= 13) & (n <= 19), total % 10 == 0).otherwise(False)


def _phone(value: Column) -> Column:
    n = F.length(_digits(value))
    return (n >= 9) & (n <= 15)


CHECKS = {"email": None, "ip": _small_parts, "card": _luhn, "phone": _phone}
#: Cheap signs without which a pattern has no match.
SIGNS = {"email": lambda t: t.contains("@"), "ip": lambda t: F.rlike(t, F.lit(r"[0-9]\.[0-9]")), "card": lambda t: F.rlike(t, F.lit(r"[0-9][0-9 -][0-9 -]?[0-9]")), "phone": lambda t: t.contains("+")}


def _passing(spans: Column, check: Callable[[Column], Column] | None) -> Column:
    return F.filter(spans, lambda s: check(s["value"])) if check else spans


def base_spans(text: Column) -> Column:
    """Spans of the fixed patterns, by kind and then by start; failing matches are dropped."""
    parts = []
    for kind, pattern in PATTERNS.items():
        found = F.when(SIGNS[kind](text), matches(text, pattern, kind)).otherwise(no_spans())
        parts.append(_passing(found, CHECKS[kind]))
    return F.concat(*parts)


def entity_keys(kind: Column, value: Column) -> Column:
    """The protected entities of a value: itself, and the group it belongs to (domain, network, prefix)."""
    value = F.lower(value)
    digits = _digits(value)
    group = F.when(kind == "email", F.substring_index(value, "@", -1)).when(kind == "ip", F.substring_index(value, ".", 2)).when(kind == "card", F.substring(digits, 1, 6)).otherwise(F.substring(digits, 1, 4))
    return F.array(F.concat_ws(":", kind, value), F.concat_ws(":", kind, F.lit("in"), group))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, h, base, words) for each row: spans of the patterns and, where there are any, all words with their places. ``h`` is a hash of the text."""
    rows = slim(docs, id_col, text_col).select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    found = rows.withColumn("base", base_spans(F.col("text")))
    words = F.transform(matches(F.col("text"), TERM, "term"), lambda s: F.struct(F.lower(s["value"]).alias("term"), s["start"].alias("start"), s["end"].alias("end")))
    return found.select("id", F.xxhash64("text").alias("h"), "base", F.when(F.size("base") > 0, words).alias("words"))


def term_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """In how many different texts each term occurs, over the whole corpus."""
    text = F.col(f"`{text_col}`")
    texts = slim(docs, text_col).filter(text.isNotNull()).groupBy(F.xxhash64(text).alias("h")).agg(F.first(text).alias("text"))
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(TERM), F.lit(0)))
    return texts.select(F.explode(words).alias("term")).groupBy("term").agg(F.count("*").alias("df_term"))


def reveals(co: Column, df_entity: Column, df_term: Column, n_texts: int, disclosure: float) -> Column:
    """Whether a term that stands beside an entity in ``co`` texts tells it apart."""
    share, z2 = co / df_term, Z * Z
    low = (share + z2 / (2 * df_term) - Z * F.sqrt(share * (1 - share) / df_term + z2 / (4 * df_term * df_term))) / (1 + z2 / df_term)
    content = F.log2(F.lit(float(n_texts)) / df_entity)
    return (content > 0) & (F.log2(low) + content >= disclosure * content)


def items(scanned: DataFrame) -> DataFrame:
    """(id, h, start, end, place, term, entities): words outside of base spans, and these, by their place in the text."""
    held = scanned.filter(F.size("base") > 0)
    # no array of a text is carried along with each of its words
    words = held.select("id", "h", F.explode("words").alias("w")).select("id", "h", "w.start", "w.end", "w.term", F.lit(None).cast("array<string>").alias("entities"))
    bases = held.select("id", "h", F.explode("base").alias("s")).select("id", "h", "s.start", "s.end", F.lit(None).cast("string").alias("term"), entity_keys(F.col("s.kind"), F.col("s.value")).alias("entities"))
    # a word is clear if no base span that begins at or before it ends after its start, and the next one begins after its end
    is_word = F.col("term").isNotNull()
    # both windows grow from their first row: one that ends at the last row would be gone through anew for each
    up, down = (Window.partitionBy("id", "h").orderBy(*o).rowsBetween(Window.unboundedPreceding, Window.currentRow) for o in (("start", F.col("term").isNotNull()), (F.desc("start"), F.col("term").isNotNull().desc())))
    ends = F.max(F.when(~is_word, F.col("end"))).over(up)
    begins = F.min(F.when(~is_word, F.col("start"))).over(down)
    clear = words.unionByName(bases).withColumns({"ends": ends, "begins": begins}).filter(~is_word | F.coalesce(F.col("ends") <= F.col("start"), F.lit(True)) & F.coalesce(F.col("begins") >= F.col("end"), F.lit(True)))
    return clear.withColumn("place", F.dense_rank().over(Window.partitionBy("id", "h").orderBy("start"))).drop("ends", "begins")


def disclosing(placed: DataFrame, counts: DataFrame, n_texts: int, disclosure: float = DISCLOSURE) -> DataFrame:
    """(id, h, terms): for each row all places of terms that reveal an entity of its text."""
    mentions = placed.filter("term IS NULL").select("h", "place", F.explode("entities").alias("entity")).distinct()
    df_entity = mentions.select("h", "entity").distinct().groupBy("entity").agg(F.count("*").alias("df_entity"))
    around = F.filter(F.sequence(F.col("place") - NEAR, F.col("place") + NEAR), lambda at: at > 0)
    beside = mentions.select("h", "entity", F.explode(around).alias("place"))
    words = placed.filter("term IS NOT NULL")
    near = stored(beside.join(words.select("h", "place", "term").distinct(), ["h", "place"]).select("h", "entity", "term").distinct(), "near")
    pairs = near.groupBy("entity", "term").agg(F.count("*").alias("co")).join(df_entity, "entity").join(counts, "term")
    strong = pairs.filter(reveals(F.col("co"), F.col("df_entity"), F.col("df_term"), n_texts, disclosure)).select("entity", "term")
    told = near.join(strong, ["entity", "term"]).select("h", "term").distinct()
    hit = words.select("id", "h", "start", "end", "term").join(told, ["h", "term"])
    return hit.groupBy("id", "h").agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("terms"))


def find_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", disclosure: float = DISCLOSURE) -> DataFrame:
    """(id, h, base, terms) for each row of ``docs``."""
    scanned = stored(scan(docs, id_col, text_col), "scanned")
    n_texts = scanned.select("h").distinct().count()
    terms = disclosing(stored(items(scanned), "items"), term_counts(docs, text_col), n_texts, disclosure)
    other = terms.select(F.col("id").alias("id2"), F.col("h").alias("h2"), "terms")
    joined = scanned.drop("words").join(other, (F.col("h") == F.col("h2")) & F.col("id").eqNullSafe(F.col("id2")), "left")
    return joined.select("id", "h", "base", F.coalesce("terms", F.array().cast("array<struct<start:int,end:int>>")).alias("terms"))


def listed(spans: Column, kind: Column | None = None) -> Column:
    """kind:start:end of spans, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"] if kind is None else kind, s["start"].cast("string"), s["end"].cast("string"))), ",")


def _without_overlaps(spans: DataFrame) -> DataFrame:
    """(id, h, pieces) of rows with spans: each kept span's kind, where it starts, and where the text before it starts; then the end."""
    every = F.concat(F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))), F.transform("terms", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit("term").alias("kind"))))
    single = spans.filter((F.size("base") > 0) | (F.size("terms") > 0)).dropDuplicates(["id", "h"]).select("id", "h", F.explode(every).alias("s")).select("id", "h", "s.*")
    order = Window.partitionBy("id", "h").orderBy("start", "end", "kind").rowsBetween(Window.unboundedPreceding, -1)
    before = single.withColumn("before", F.coalesce(F.max("end").over(order), F.lit(0)))
    kept = F.collect_list(F.when(F.col("start") >= F.col("before"), F.struct("start", "before", "kind")))
    return before.groupBy("id", "h").agg(F.array_sort(kept).alias("pieces"), F.max("end").alias("last"))


def _from_blocks(blocks: Column, start: Column, end: Column) -> Column:
    """The characters from ``start`` to ``end`` of a text in blocks of ``PIECE``."""
    first = F.floor(start / PIECE).cast("int")
    n = F.ceil(end / PIECE).cast("int") - first
    return F.when(end > start, F.substring(F.array_join(F.slice(blocks, first + 1, F.greatest(n, F.lit(1))), ""), start - first * PIECE + 1, end - start)).otherwise("")


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with every span of its text replaced by the general name of its kind."""
    hit = _without_overlaps(find_spans(docs, id_col, text_col))
    # the caller's columns stand in one struct, so that none of them can clash with ours
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    keyed = rows.select("row", F.col(f"row.`{id_col}`").alias("row_id"), F.col(f"row.`{text_col}`").alias("text"), F.xxhash64(F.coalesce(F.col(f"row.`{text_col}`"), F.lit(""))).alias("row_h"))
    names = F.create_map(*[F.lit(x) for kv in NAMES.items() for x in kv])
    joined = keyed.join(hit, (F.col("row_h") == F.col("h")) & F.col("row_id").eqNullSafe(F.col("id")), "left")
    blocks = F.regexp_extract_all("text", F.lit(rf"(?s).{{1,{PIECE}}}"), F.lit(0))
    pieces = lambda x: F.array_join(F.transform(x["pieces"], lambda p: F.concat(_from_blocks(x["blocks"], p["before"], p["start"]), F.element_at(names, p["kind"]))), "")
    # the blocks are made once for a text: they reach the lambdas as a variable
    once = F.array(F.struct(blocks.alias("blocks"), "pieces", "last", F.length("text").alias("n")))
    clean = F.element_at(F.transform(once, lambda x: F.concat(pieces(x), _from_blocks(x["blocks"], x["last"], x["n"]))), 1)
    whole = F.when(F.col("pieces").isNotNull(), clean).otherwise(F.col("text"))
    return joined.select(*(whole.alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in docs.columns))
