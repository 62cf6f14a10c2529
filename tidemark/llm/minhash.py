"""Near-duplicates by BagMinHash signatures of word-shingle multisets.

Equal texts are first folded into one representative. A representative's bag of
five-word shingles (with their counts) gets a BagMinHash signature: the counts are
discretised weights, and each shingle has Poisson processes over the hierarchy of
weight intervals (0, 1], (1, 2], (2, 4], ... The interval that holds the weight's end
is not split further; its points beyond the weight are thinned out, which gives the
same points at no more than twice the draws. A signature component is the smallest
point that falls to it, so two signatures agree in a component with the probability
of the bags' weighted Jaccard similarity. Bands of the signature propose pairs, and
the exact multiset overlap of the whole texts decides every proposed pair whose texts
are not in one class already: no estimate decides, and no bucket is cut short.

Within a band's bucket not all pairs are formed. In each of ``ROUNDS`` rounds the
members whose class differs from that of the round's leader are verified against that
leader, and linked members become one class; the first leader is the member that
shares buckets with most texts (the original among its edited copies), later ones
are other members by a hash. What still differs meets in blocks of bounded count and
size: blocks of one large class, or of small ones, and two blocks of the same class
never meet. The overlaps of two blocks are exact products of sparse rows.

Recall: bands propose a pair at similarity 0.8 with probability 0.99995. Copies with
edits fall below 0.8 soon: an edited word changes five shingles, so in a text of n words
with k edits far apart it is (n - 5k) / (n + 5k), and below 0.8 from k > n / 45 on.

Cases: null texts count as empty; texts without words are alike only if equal; a
text of fewer than five words is one shingle; null ids form classes by their
texts like others (a class is named by its smallest id that is not null);
repeated rows fold; extra columns are ignored; an empty table gives an empty
result. Texts are told apart by a 64-bit hash, and those of one hash by a second one
and their lengths.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, partitions_for, slim, stored

WORDS, THRESHOLD = 5, 0.8
#: Bands of so many signature components each.
BANDS, ROWS = 25, 5
ROUNDS = 2
#: Members verified against one leader in a group; texts of a block and shingles in it, about.
CROWD, BLOCK, BLOCK_KEYS = 128, 256, 1 << 20
#: Shingles of two blocks compared at a time.
COLUMNS = 1 << 13
#: Shingles signed at a time.
BATCH = 1 << 18
SPACES = " \t\n\r\v\f"

_GOLD, _C1, _C2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _C1
    x = (x ^ (x >> np.uint64(27))) * _C2
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct word shingles, sorted, and how often each occurs."""
    tokens = (text or "").encode("utf-8", "surrogatepass").split()
    if not tokens:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, tokens), np.uint64, len(tokens))
    span = min(words, len(h))
    key = np.full(len(h) - span + 1, np.uint64(span))
    for k in range(span):
        key = _mix(key * _GOLD + h[k : len(h) - span + 1 + k])
    return np.unique(key, return_counts=True)


def bag_keys(text: str | None, words: int = WORDS) -> np.ndarray:
    """A bag as a sorted set: a shingle's first occurrence is its hash, each further one another hash."""
    keys, counts = shingles(text, words)
    more = np.repeat(keys, counts - 1)
    nth = np.arange(len(more)) - np.repeat(np.cumsum(counts - 1) - (counts - 1), counts - 1) + 1
    return np.sort(np.concatenate([keys, _mix(more + _GOLD * nth.astype(np.uint64))]))


def overlap(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard similarity of two bags, given as their keys."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    total = len(a) + len(b) - both
    return both / total if total else 0.0


def alike(a: list[np.ndarray], b: list[np.ndarray], threshold: float) -> np.ndarray:
    """Pairs (row of ``a``, row of ``b``) of bags whose overlap meets the threshold, all counted exactly."""
    sizes_a, sizes_b = (np.fromiter(map(len, x), np.int64, len(x)) for x in (a, b))
    keys_a, keys_b = np.concatenate(a), np.concatenate(b)
    common = np.intersect1d(np.unique(keys_a), np.unique(keys_b), assume_unique=True)
    both = np.zeros((len(a), len(b)))
    if len(common):
        placed = []
        for keys, sizes in ((keys_a, sizes_a), (keys_b, sizes_b)):
            column = np.minimum(np.searchsorted(common, keys), len(common) - 1)
            hit = common[column] == keys
            row, column = np.repeat(np.arange(len(sizes)), sizes)[hit], column[hit]
            order = np.argsort(column, kind="stable")
            placed.append((row[order], column[order], len(sizes)))
        for start in range(0, len(common), COLUMNS):
            parts = []
            for row, column, n in placed:
                own = slice(*np.searchsorted(column, (start, start + COLUMNS)))
                part = np.zeros((n, min(COLUMNS, len(common) - start)), np.float32)
                part[row[own], column[own] - start] = 1
                parts.append(part)
            both += parts[0] @ parts[1].T
    total = sizes_a[:, None] + sizes_b[None, :] - both
    return np.argwhere((both / np.maximum(total, 1) >= threshold) & (total > 0))


def signatures(keys: np.ndarray, weights: np.ndarray, bag: np.ndarray, bags: int, size: int) -> np.ndarray:
    """BagMinHash signatures: an array (bags, size) of the hashes of the smallest points.

    ``bag`` numbers the bag of each (key, weight) and doesn't decrease.
    """
    # Dyadic intervals of weight: (0,1], (1,2], (2,4], ... below each weight.
    levels = np.where(weights > 1, np.ceil(np.log2(np.maximum(weights, 2))).astype(np.int64) + 1, 1)
    item = np.repeat(np.arange(len(keys)), levels)
    level = np.arange(len(item)) - np.repeat(np.cumsum(levels) - levels, levels)
    low = np.where(level > 0, 2.0 ** (level - 1), 0.0)
    width = np.where(level > 0, 2.0 ** (level - 1), 1.0)
    state = _mix(keys[item] + _GOLD * (level + 1).astype(np.uint64))
    owner, weight = bag[item], weights[item].astype(np.float64)
    point = np.zeros(len(item))
    least = np.full(bags * size, np.inf)
    name = np.zeros(bags * size, np.uint64)
    limit = np.full(bags, np.inf)
    while len(state):
        state = _mix(state + _GOLD)
        # one draw gives the gap, another the component and the place within the interval
        u = ((state >> np.uint64(11)).astype(np.float64) + 0.5) / 9007199254740992.0
        point = point - np.log(u) / (width * size)
        live = point < limit[owner]
        state, point, owner, low, width, weight = (x[live] for x in (state, point, owner, low, width, weight))
        if not len(state):
            break
        draw = _mix(state ^ _C2)
        component = ((draw >> np.uint64(40)) * np.uint64(size) >> np.uint64(24)).astype(np.int64)
        place = low + (draw & np.uint64(0xFFFFFFFFFF)).astype(np.float64) / 1099511627776.0 * width
        hit = np.flatnonzero(np.floor(place) < weight)
        slot, at = owner[hit] * size + component[hit], point[hit]
        np.minimum.at(least, slot, at)
        best = at == least[slot]
        name[slot[best]] = draw[hit[best]]
        limit = least.reshape(bags, size).max(axis=1)
    return name.reshape(bags, size)


def sign_texts(texts: list[str], words: int = WORDS, bands: int = BANDS, rows: int = ROWS) -> tuple[np.ndarray, np.ndarray]:
    """Band hashes (texts, bands) and the size of each bag; all texts must have a word."""
    out, sizes = np.empty((len(texts), bands), np.uint64), np.empty(len(texts), np.int64)
    start, held, count = 0, [], 0
    for i, text in enumerate(texts):
        held.append(shingles(text, words))
        count += len(held[-1][0])
        if count >= BATCH or i + 1 == len(texts):
            bag = np.repeat(np.arange(len(held)), [len(k) for k, _ in held])
            sig = signatures(np.concatenate([k for k, _ in held]), np.concatenate([w for _, w in held]), bag, len(held), bands * rows)
            key = np.repeat(np.arange(1, bands + 1, dtype=np.uint64)[None, :], len(held), axis=0)
            for r in range(rows):
                key = _mix(key * _GOLD + sig[:, r::rows])
            out[start : i + 1] = key
            sizes[start : i + 1] = [w.sum() for _, w in held]
            start, held, count = i + 1, [], 0
    return out, sizes


def _signed(texts: DataFrame, words: int, bands: int, rows: int) -> DataFrame:
    """(tid, bands, size) for texts with a word; copies within a batch once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, found = batch.column(0).to_numpy(), batch.column(1).to_pylist()
            once = np.unique(ids, return_index=True)[1]
            full = [i for i in once if found[i].strip(SPACES)]
            for at in range(0, len(full), 256):
                part = full[at : at + 256]
                keys, sizes = sign_texts([found[i] for i in part], words, bands, rows)
                yield pa.RecordBatch.from_pydict({"tid": pa.array(ids[part]), "bands": pa.array(list(keys.view(np.int64)), pa.list_(pa.int64())), "size": sizes})

    return texts.mapInArrow(run, "tid long, bands array<long>, size long")


def _bags(texts: DataFrame, words: int) -> DataFrame:
    """(tid, bag): the keys of each text's bag as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                yield pa.RecordBatch.from_pydict({"tid": part.column(0), "bag": pa.array([bag_keys(t, words).tobytes() for t in part.column(1).to_pylist()], pa.binary())})

    return texts.mapInArrow(run, "tid long, bag binary")


def _verified(edges: DataFrame, bags: DataFrame, threshold: float) -> DataFrame:
    """Of (tid, leader) the pairs whose bags overlap enough; members meet their leader in groups of at most about ``CROWD``."""
    crowd = edges.groupBy("leader").agg(F.ceil(F.count("*") / F.lit(CROWD)).alias("parts"))
    dealt = edges.join(crowd, "leader").withColumn("part", F.pmod(F.xxhash64("tid"), "parts"))
    members = dealt.select("leader", "part", "tid", F.lit(False).alias("lead"))
    leaders = crowd.select("leader", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), F.col("leader").alias("tid"), F.lit(True).alias("lead"))
    both = members.unionByName(leaders).join(bags, "tid").select("leader", "part", "lead", "tid", "bag")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = first = None
        for batch in batches:
            found = []
            for leader, part, lead, tid, bag in zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True):
                own = np.frombuffer(bag, np.uint64)
                if lead:
                    group, first = (leader, part), own
                elif group == (leader, part) and overlap(first, own) >= threshold:
                    found.append((tid, leader))
            yield _edge_batch(found)

    n = partitions_for(edges.sparkSession)
    return both.repartition(n, "leader", "part").sortWithinPartitions("leader", "part", F.col("lead").desc()).mapInArrow(run, "tid long, leader long")


def _block_pairs(placed: DataFrame) -> DataFrame:
    """(band, i, j, low, tid, root): which texts of buckets with several classes meet in which pair of blocks.

    ``placed`` is (band, tid, root, size). Buckets of the same texts count once. A class
    that fills a block has blocks of its own and doesn't meet itself; smaller ones are
    dealt into common blocks.
    """
    about = placed.groupBy("band").agg(F.min("root").alias("a"), F.max("root").alias("b"), F.count("*").alias("n"), F.bit_xor(F.xxhash64("tid")).alias("x"), F.bit_xor(F.xxhash64("tid", F.lit(1))).alias("y"))
    mixed = about.filter("a <> b").groupBy("n", "x", "y").agg(F.min("band").alias("band")).select("band")
    blocks = lambda n, w: F.ceil(F.greatest(F.col(n) / F.lit(BLOCK), F.col(w) / F.lit(BLOCK_KEYS), F.lit(1.0)))
    own = placed.join(mixed, "band", "left_semi")
    classes = own.groupBy("band", "root").agg(F.count("*").alias("n"), F.sum("size").alias("w")).withColumn("large", (F.col("n") >= BLOCK) | (F.col("w") >= BLOCK_KEYS))
    small = classes.filter("NOT large").groupBy("band").agg(F.sum("n").alias("sn"), F.sum("w").alias("sw")).select("band", blocks("sn", "sw").alias("small"))
    sized = classes.join(small, "band", "left").select("band", "root", "large", F.when(F.col("large"), blocks("n", "w")).otherwise(F.col("small")).alias("k"))
    # a large class has its blocks by its members, small classes share blocks by their roots
    number = F.when(F.col("large"), F.pmod(F.xxhash64("tid"), "k")).otherwise(F.pmod(F.xxhash64("root"), "k"))
    block = F.struct(F.when(F.col("large"), F.col("root")).alias("of"), number.alias("at"))
    dealt = own.join(sized, ["band", "root"]).select("band", "tid", "root", block.alias("block"))
    kept = dealt.select("band", "block").distinct()
    pairs = kept.select("band", F.col("block").alias("i")).join(kept.select("band", F.col("block").alias("j")), "band").filter("i <= j AND NOT (i.of IS NOT NULL AND i.of <=> j.of)")
    sides = pairs.select("band", F.explode(F.array(F.struct(F.col("i").alias("block"), F.lit(True).alias("low")), F.struct(F.col("j").alias("block"), F.lit(False).alias("low")))).alias("s"), F.xxhash64("i").alias("i"), F.xxhash64("j").alias("j"))
    sides = sides.filter("i <> j OR s.low").select("band", "i", "j", "s.block", "s.low")
    return dealt.join(sides, ["band", "block"]).select("band", "i", "j", "low", "tid", "root")


def _across(placed: DataFrame, bags: DataFrame, threshold: float) -> DataFrame:
    """Links between the classes that share a band's bucket, from (band, tid, root, size): enough of them to join what is alike."""
    full = _block_pairs(placed).join(bags, "tid").select("band", "i", "j", "low", "tid", "root", "bag")

    def links(key: tuple, rows: list[tuple]) -> list[tuple[int, int]]:
        sides = [[r for r in rows if r[0] == low] for low in (True, False)]
        if key[1] == key[2]:
            sides[1] = sides[0]
        if not sides[0] or not sides[1]:
            return []
        parents: dict[int, int] = {}

        def find(x: int) -> int:
            while x in parents:
                x = parents[x]
            return x

        out = []
        one, two = ([np.frombuffer(r[3], np.uint64) for r in side] for side in sides)
        for x, y in alike(one, two, threshold):
            (_, tid, root, _), (_, other, other_root, _) = sides[0][x], sides[1][y]
            a, b = find(root), find(other_root)
            if a != b:
                parents[max(a, b)] = min(a, b)
                out.append((tid, other))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        for batch in batches:
            found = []
            for row in zip(*(batch.column(k).to_pylist() for k in range(7)), strict=True):
                if row[:3] != key:
                    found += links(key, held) if len(held) > 1 else []
                    key, held = row[:3], []
                held.append(row[3:])
            yield _edge_batch(found)
        yield _edge_batch(links(key, held) if len(held) > 1 else [])

    n = partitions_for(placed.sparkSession)
    return full.repartition(n, "band", "i", "j").sortWithinPartitions("band", "i", "j").mapInArrow(run, "tid long, leader long")


def _edge_batch(found: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"tid": pa.array([x for x, _ in found], pa.int64()), "leader": pa.array([y for _, y in found], pa.int64())})


def components(links: DataFrame, most: int = 60) -> DataFrame:
    """(tid, root): the smallest member of each linked set, by alternating star contraction.

    Each step writes its table in the shared folder, drops the one before it, and
    stops when nothing changes.
    """
    spark = links.sparkSession
    edges = links.selectExpr("greatest(tid, leader) u", "least(tid, leader) v").filter("u <> v").distinct()
    before, done = None, None
    for step in range(most):
        # large star: a vertex's larger neighbours to the smallest of its neighbours and itself
        around = edges.unionByName(edges.selectExpr("v u", "u v"))
        low = around.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = around.filter("v > u").join(low, "u").selectExpr("v u", "m v").distinct()
        # small star: a vertex and its smaller neighbours to the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").selectExpr("v u", "m v").filter("u <> v").unionByName(least.selectExpr("u", "m v")).distinct()
        scratch = Scratch(spark)
        edges = scratch.stored(small, f"star{step}")
        if before:
            before.drop()
        before = scratch
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == done:
            roots = stored(edges.select(F.col("u").alias("tid"), F.col("v").alias("root")), "components")
            scratch.drop()
            return roots
        done = now
    raise RuntimeError("linked sets did not settle")


def near_duplicate_classes(texts: DataFrame, threshold: float = THRESHOLD, words: int = WORDS, bands: int = BANDS, rows: int = ROWS, rounds: int = ROUNDS) -> DataFrame:
    """(tid, root) for those of ``texts`` (tid, text; copies may repeat) that share a band with another text."""
    with Scratch(texts.sparkSession) as scratch:
        signed = scratch.stored(_signed(texts, words, bands, rows), "signed").dropDuplicates(["tid"])
        banded = signed.select(F.explode("bands").alias("band"), "tid", "size")
        shared = banded.groupBy("band").agg(F.count("*").alias("n")).filter("n > 1")
        crowded = scratch.stored(banded.join(shared, "band"), "bands")
        met = crowded.groupBy("tid").agg(F.sum("n").alias("degree"))
        roots = scratch.stored(met.select("tid", "degree", F.col("tid").alias("root")), "roots")
        # copies go before the shuffle, so that no text has more rows in it than tasks; a semi-join would be moved before the grouping
        own = texts.groupBy("tid").agg(F.first("text").alias("text")).join(roots.select("tid"), "tid")
        bags = scratch.stored(_bags(own, words), "bags")
        for k in range(rounds + 1):
            placed = crowded.select("band", "tid", "size").join(roots, "tid")
            if k < rounds:
                rank = -F.col("degree") if k == 0 else F.xxhash64("tid", F.lit(k))
                order = F.struct(rank.alias("h"), F.col("tid").alias("leader"), F.col("root").alias("lead_root"))
                lead = placed.groupBy("band").agg(F.min(order).alias("x"), F.min("root").alias("a"), F.max("root").alias("b")).filter("a <> b").select("band", "x.leader", "x.lead_root")
                pairs = scratch.stored(placed.join(lead, "band").filter("root <> lead_root").select("tid", "leader").distinct(), f"pairs{k}")
                found = _verified(pairs, bags, threshold)
            else:
                found = _across(placed, bags, threshold)
            named = roots.select("tid", "root")
            links = scratch.stored(found.join(named, "tid").select("leader", F.col("root").alias("u")).join(named.withColumnRenamed("tid", "leader"), "leader").select(F.col("u").alias("tid"), F.col("root").alias("leader")).distinct(), f"links{k}")
            if not links.isEmpty():
                joined = components(links).select(F.col("tid").alias("root"), F.col("root").alias("top"))
                roots = scratch.stored(roots.join(joined, "root", "left").select("tid", "degree", F.coalesce("top", "root").alias("root")), f"roots{k}")
        return stored(roots.select("tid", "root"), "classes")


def folded(docs: DataFrame, scratch: Scratch, id_col: str, text_col: str) -> DataFrame:
    """``docs`` with ``__text`` (null: empty) and ``__tid``, which is the same for equal texts alone.

    ``__tid`` is a 64-bit hash. Where different texts share it, those that are not the
    least by a second hash and length take a hash of all three; such texts are so few
    (a few dozen among 10^10) that their table is small.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    keyed = docs.withColumns({"__text": text, "__tid": text_hash(text)})
    other = F.struct(F.xxhash64(F.lit(1), "__text").alias("h"), F.length("__text").alias("n"))
    clash = scratch.stored(keyed.groupBy("__tid").agg(F.min(other).alias("__least"), F.max(other).alias("__most")).filter("__least <> __most").select("__tid", "__least"), "clashes")
    if clash.isEmpty():
        return keyed
    told = F.when(F.col("__least").isNotNull() & (F.col("__least") != other), F.xxhash64("__tid", other)).otherwise(F.col("__tid"))
    return keyed.join(stored(clash, "clashes"), "__tid", "left").withColumn("__tid", told).drop("__least")


def text_hash(text: F.Column) -> F.Column:
    return F.xxhash64(text)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, words: int = WORDS, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row for each document: id, class_id (smallest id of the class), class_docs, class_texts, and the class's and text's numbers root and tid."""
    with Scratch(docs.sparkSession) as scratch:
        keyed = folded(slim(docs, id_col, text_col), scratch, id_col, text_col)
        keyed = keyed.select(F.col(f"`{id_col}`").alias("id"), F.col("__tid").alias("tid"), F.col("__text").alias("text"))
        return _near_duplicates(keyed, scratch, id_col, threshold, words, bands, rows)


def _near_duplicates(keyed: DataFrame, scratch: Scratch, id_col: str, threshold: float = THRESHOLD, words: int = WORDS, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    ids = stored(keyed.select("id", "tid"), "ids")
    roots = near_duplicate_classes(keyed.select("tid", "text"), threshold, words, bands, rows)
    # Copies are counted first, then texts by class; both joins read plain tables, so a
    # text or class with very many rows is split over tasks.
    counted = ids.groupBy("tid").agg(F.min("id").alias("low"), F.count("*").alias("n")).join(roots, "tid", "left")
    per_text = scratch.stored(counted.select("tid", F.coalesce("root", "tid").alias("root"), "low", "n"), "per_text")
    classes = scratch.stored(per_text.groupBy("root").agg(F.min("low").alias("class_id"), F.sum("n").alias("class_docs"), F.count("*").alias("class_texts")), "class")
    named = stored(per_text.join(classes, "root").select("tid", "root", "class_id", "class_docs", "class_texts"), "named")
    return ids.join(named, "tid").select(F.col("id").alias(id_col), "class_id", "class_docs", "class_texts", "root", "tid")


def one_of_each_class(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each class of near-duplicates: the smallest id (null last), then text hash."""
    with Scratch(docs.sparkSession) as scratch:
        keyed = folded(docs, scratch, id_col, text_col)
        found = _near_duplicates(keyed.select(F.col(f"`{id_col}`").alias("id"), F.col("__tid").alias("tid"), F.col("__text").alias("text")), scratch, id_col, **options)
    rank = F.struct(F.col(f"`{id_col}`").isNull().alias("none"), F.col(f"`{id_col}`").alias("id"), "tid")
    # rows without an id form classes by text, which their least number names
    chosen = found.withColumn("rank", rank).groupBy("root").agg(F.min("rank").alias("r")).select(F.col("r.id").alias("__id"), F.col("r.tid").alias("__chosen"))
    kept = keyed.join(chosen, (F.col("__tid") == F.col("__chosen")) & F.col(f"`{id_col}`").eqNullSafe(F.col("__id")), "left_semi")
    return kept.dropDuplicates([id_col, "__tid"]).select(*(F.col(f"`{c}`") for c in docs.columns))
