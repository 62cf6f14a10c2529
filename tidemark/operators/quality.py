"""Data-quality checks on ticks and tables."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, LongType, StringType, StructField, StructType

from ..functions.time import MARKET_TZ, is_auction_time, local_time, minute_of_day, session_start, trading_date
from . import scan

#: Fewest rows a day, largest gap in seconds, staleness limits in minutes.
LEAST_ROWS = {"trade": 1000, "quote": 1000, "index": 500, "foreign": 10}
TICK_GAP_S = 600
STALE_AFTER = {"trade": 3, "quote": 5}


def price_band_anomalies(trades: DataFrame, bands: DataFrame, keys: list[str], ts: str = "exchange_ts", since: Column | None = None) -> DataFrame:
    """Trades above their ceiling or below their floor.

    ``bands`` (keys, ceiling_price, floor_price) is reduced to one row a key first, so
    several boards of one symbol do not multiply trades.
    """
    one = bands.filter(F.col("ceiling_price").isNotNull()).groupBy(*keys).agg(F.max("ceiling_price").alias("ceiling_price"), F.min("floor_price").alias("floor_price"))
    recent = trades if since is None else trades.filter(F.col(ts) >= since)
    return recent.join(one, keys).filter((F.col("price") > F.col("ceiling_price")) | (F.col("price") < F.col("floor_price")))


def negative_spreads(quotes: DataFrame, ts: str = "exchange_ts", since: Column | None = None) -> DataFrame:
    """The live check: a bid above zero and an ask below it."""
    recent = quotes if since is None else quotes.filter(F.col(ts) >= since)
    return recent.filter((F.col("bid_price1") > 0) & (F.col("ask_price1") - F.col("bid_price1") < 0))


def spread_sanity(quotes: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """The weekly check: counts of bids not below asks, of missing sides and of prices not above zero."""
    bid, ask = F.col("bid_price1"), F.col("ask_price1")
    out = [F.count_if(bid >= ask).alias("crossed"), F.count_if(bid.isNull() | ask.isNull()).alias("one_sided"), F.count_if((bid <= 0) | (ask <= 0)).alias("not_positive"), F.count("*").alias("n")]
    return (quotes.groupBy(*keys) if keys else quotes).agg(*out)


def row_counts(rows: DataFrame, minimum: int, ts: str = "exchange_ts", tz: str = MARKET_TZ) -> DataFrame:
    """Rows of each local day and whether they are too few."""
    return rows.groupBy(trading_date(ts, tz).alias("day")).agg(F.count("*").alias("n")).withColumn("too_few", F.col("n") < minimum)


def _in_session(ts: str, tz: str) -> Column:
    """Weekdays from 09:00 to 11:59 and from 13:00 to 14:59, as the weekly report has it."""
    now = local_time(ts, tz)
    hour = F.hour(now)
    return (F.weekday(now.cast("date")) < 5) & (hour.between(9, 11) | hour.between(13, 14))


def tick_gaps(rows: DataFrame, seconds: int = TICK_GAP_S, ts: str = "exchange_ts", tz: str = MARKET_TZ, by_session: bool = False, keys: list[str] | None = None) -> DataFrame:
    """Gaps between neighbouring ticks within a local day (or session) longer than ``seconds``.

    With ``by_session`` the lunch break is no gap. Two ticks of one span of ``seconds`` are
    never further apart, so a gap lies between the last tick of one span and the first of
    the next that has any. Spans are aggregated with partial sums, ticks are never sorted,
    and what is put in order is at most 86400 / ``seconds`` rows a day.
    """
    inside = rows.filter(_in_session(ts, tz)).withColumn("day", trading_date(ts, tz))
    parts = [*(keys or []), "day"]
    if by_session:
        inside, parts = inside.withColumn("session", F.when(minute_of_day(local_time(ts, tz)) < 720, "AM").otherwise("PM")), [*parts, "session"]
    spans = inside.groupBy(*parts, scan.slice_of(ts, seconds).alias("__span")).agg(F.min(ts).alias("lo"), F.max(ts).alias("hi"))
    between = spans.select(*parts, F.lag("hi").over(Window.partitionBy(*parts).orderBy("__span")).alias("gap_start"), F.col("lo").alias("gap_end"))
    length = (F.unix_micros(F.col("gap_end").cast("timestamp")) - F.unix_micros(F.col("gap_start").cast("timestamp"))) / 1000000
    return between.filter(F.col("gap_start").isNotNull()).withColumn("gap_s", length).filter(F.col("gap_s") > seconds)


def market_gaps(rows: DataFrame, seconds: int = TICK_GAP_S, ts: str = "exchange_ts", tz: str = MARKET_TZ) -> DataFrame:
    """Gaps over all symbols and days in one order, without one task that sorts them all.

    Within a day a lag finds them; between days the last tick of the day before meets
    the first of the next, and only those per-day extremes are put in one order.
    """
    inside = rows.filter(_in_session(ts, tz))
    within = tick_gaps(rows, seconds, ts, tz).select("gap_start", "gap_end", "gap_s")
    days = inside.groupBy(trading_date(ts, tz).alias("day")).agg(F.min(ts).alias("lo"), F.max(ts).alias("hi"))
    between = days.select(F.lag("hi").over(Window.orderBy("day")).alias("gap_start"), F.col("lo").alias("gap_end")).filter("gap_start IS NOT NULL")
    length = (F.unix_micros(F.col("gap_end").cast("timestamp")) - F.unix_micros(F.col("gap_start").cast("timestamp"))) / 1000000
    return within.unionByName(between.withColumn("gap_s", length).filter(F.col("gap_s") > seconds))


def largest_gaps(gaps: DataFrame, n: int = 10) -> DataFrame:
    return gaps.orderBy(F.desc("gap_s"), "gap_start").limit(n)


def freshness(sources: dict[str, DataFrame], as_of: Column, limits: dict[str, int] | None = None, ts: str = "exchange_ts", tz: str = MARKET_TZ) -> DataFrame:
    """(table, last_ts, gap_minutes, threshold_minutes, is_stale) of each source.

    Staleness counts from the session's start at the earliest; the reported gap does
    not. Trades are excused in auctions; a source without rows is stale.
    """
    limits = limits or STALE_AFTER
    out = None
    for name, df in sources.items():
        one = df.agg(F.max(ts).alias("last_ts")).select(F.lit(name).alias("table"), "last_ts", F.lit(limits[name]).alias("threshold_minutes"))
        out = one if out is None else out.unionByName(one)
    minutes = lambda a, b: (F.unix_micros(a.cast("timestamp")) - F.unix_micros(b.cast("timestamp"))) / 60000000
    counted = minutes(as_of, F.greatest("last_ts", session_start(as_of, tz)))
    stale = F.when(F.col("last_ts").isNull(), True).when((F.col("table") == "trade") & is_auction_time(as_of, tz), False).otherwise(counted > F.col("threshold_minutes"))
    return out.select("table", "last_ts", F.round(minutes(as_of, F.col("last_ts")), 1).alias("gap_minutes"), "threshold_minutes", stale.alias("is_stale"))


def coverage(rows: DataFrame, keys: list[str] = ("symbol",), ts: str = "exchange_ts") -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias("n"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"))


def new_anomalies(anomalies: DataFrame, marks: DataFrame, keys: list[str], ts: str = "exchange_ts", shown: int = 5, tie: list[str] = ()) -> DataFrame:
    """Per check the first rows newer than its high-water mark, with how many there are and the next mark."""
    fresh = anomalies.join(marks, keys, "left").filter(F.col("last_ts").isNull() | (F.col(ts) > F.col("last_ts")))
    w = Window.partitionBy(*keys)
    ranked = fresh.withColumn("rank", F.row_number().over(w.orderBy(ts, *tie))).withColumn("n_new", F.count("*").over(w)).withColumn("next_mark", F.max(ts).over(w))
    return ranked.filter(F.col("rank") <= shown).withColumn("not_shown", F.greatest(F.col("n_new") - shown, F.lit(0))).drop("last_ts")


def report(**checks: DataFrame) -> DataFrame:
    """(category, detail) of all checks' issues."""
    out = None
    for name, df in checks.items():
        one = df.select(F.lit(name).alias("category"), F.to_json(F.struct(*df.columns)).alias("detail"))
        out = one if out is None else out.unionByName(one)
    return out


def report_counts(issues: DataFrame) -> DataFrame:
    return issues.groupBy("category").agg(F.count("*").alias("n"))


def table_health(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, n_files, n_rows) by the files that rows come from."""
    out = None
    for name, df in tables.items():
        one = df.select(F.col("_metadata.file_path").alias("f")).agg(F.countDistinct("f").alias("n_files"), F.count("*").alias("n_rows")).withColumn("table", F.lit(name))
        out = one if out is None else out.unionByName(one)
    return out.select("table", "n_files", "n_rows", (F.col("n_files") > 0).alias("readable"))


class AlertFold:
    """The state machine of one alert key: folds of its results, and what a slice of them does to any state.

    A state is whether the key is active and when it last recovered. A key that fires while
    inactive becomes active; an ok result ends that, if the key never recovered or its last
    recovery is at least ``wait`` microseconds ago.
    """

    def __init__(self, wait: int):
        self.wait = wait

    def step(self, on: bool, us: int, active: bool, recovered: int | None) -> tuple[str | None, bool, int | None]:
        """The event of one result, if it is one, and the state after it."""
        if on and not active:
            return "FIRE", True, recovered
        if not on and active and (recovered is None or us - recovered >= self.wait):
            return "RECOVER", False, us
        return None, active, recovered

    def summary(self, ons: list[bool], times: list[int]) -> tuple[list[int], list[bool], list[int], bool, int]:
        """What the results of a slice, in order, do to any state before it.

        From the ok result at which a key first recovers, all follows from the slice alone, so
        the state after the slice is worked out for each ok result, the last ones first. A key
        that comes in active recovers at the first ok result a ``wait`` after its last
        recovery, which lies before the slice: results after the first one a ``wait`` into
        the slice are never it. A key that comes in inactive must fire first; ``first`` is the
        place of the first ok result after that among those kept, -1 if there is none.
        """
        oks = [i for i, on in enumerate(ons) if not on]
        ok_times = [times[i] for i in oks]
        fires = [len(ons)] * (len(ons) + 1)
        for i in range(len(ons) - 1, -1, -1):
            fires[i] = i if ons[i] else fires[i + 1]
        after: list[tuple[bool, int]] = [(False, 0)] * len(oks)
        for k in range(len(oks) - 1, -1, -1):
            fired = fires[oks[k] + 1]
            nxt = max(bisect_left(oks, fired), bisect_left(ok_times, ok_times[k] + self.wait))
            after[k] = (False, ok_times[k]) if fired == len(ons) else after[nxt] if nxt < len(oks) else (True, ok_times[k])
        kept = list(range(min(len(oks), bisect_left(ok_times, times[0] + self.wait) + 1)))
        first = bisect_left(oks, fires[0])
        if first == len(oks):
            place = -1
        elif first < len(kept):
            place = first
        else:
            place = len(kept)
            kept.append(first)
        return [ok_times[k] for k in kept], [after[k][0] for k in kept], [after[k][1] for k in kept], fires[0] < len(ons), place

    def apply(self, summary: tuple, active: bool, recovered: int | None) -> tuple[bool, int | None]:
        """The state after a slice, from its summary and the state before it."""
        times, actives, recoveries, fires, first = summary
        if not active and not fires:
            return active, recovered
        at = 0 if active else first
        if at >= 0 and recovered is not None:
            at = max(at, bisect_left(times, recovered + self.wait))
        return (actives[at], recoveries[at]) if 0 <= at < len(times) else (True, recovered)


def _by_slice(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple[tuple, Iterator[tuple]]]:
    """Sorted rows grouped by their first columns, ``names``; a row is the tuple of all its columns."""
    rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
    return groupby(rows, key=lambda row: row[: len(names)])


def alert_transitions(states: DataFrame, keys: list[str] = ("key",), ts: str = "ts", firing: str = "firing", cooldown_s: int = 300, slice_s: int = scan.SLICE_S) -> DataFrame:
    """FIRE and RECOVER events of each key from its check results in order.

    At equal times ok comes before firing; results without a time or an outcome are left
    out. A null key is a key.

    A key's history is cut into slices of time. Each slice is summed up as a function from
    the state before it to the state after it, the functions of a key are applied in order
    (one row a slice, whose size is bounded by the results of a cooldown), and then every
    slice is folded from its own state. So one key is as many tasks as it has slices, and a
    task holds one slice of one key at most.
    """
    keys, machine = list(keys), AlertFold(cooldown_s * 1000000)
    names = [f"__k{i}" for i in range(len(keys))]
    cut = [*names, "__slice"]
    known = states.filter(F.col(ts).isNotNull() & F.col(firing).isNotNull())
    rows = known.select(*(F.col(k).alias(n) for k, n in zip(keys, names, strict=True)), scan.slice_of(ts, slice_s).alias("__slice"), F.unix_micros(F.col(ts).cast("timestamp")).alias("__us"), F.col(firing).alias("__on"), F.col(ts).alias("ts"))
    kinds = [StructField(n, states.schema[k].dataType) for k, n in zip(keys, names, strict=True)]
    place = StructField("__slice", LongType())

    def table(found: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
        columns = zip(*found, strict=True) if found else [()] * len(schema)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group, own in _by_slice(batches, cut):
            times, ons = zip(*(row[-2:] for row in own), strict=True)
            yield table([(*group, *machine.summary(list(ons), list(times)))], summary_schema)

    def started(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, own in _by_slice(batches, names):
            state: tuple[bool, int | None] = (False, None)
            for row in own:
                yield table([(*row[: len(cut)], *state)], start_schema)
                state = machine.apply(row[len(cut) :], *state)

    def events(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state = None, (False, None)
        for batch in batches:
            at, found = [], []
            for i, row in enumerate(zip(*(batch.column(c).to_pylist() for c in (*cut, "__us", "__on", "__active", "__recovered")), strict=True)):
                group, (us, on, active, recovered) = row[: len(cut)], row[len(cut) :]
                if group != last:
                    last, state = group, (active, recovered)
                if us is not None:
                    event, *state = machine.step(on, us, *state)
                    if event:
                        at.append(i)
                        found.append(event)
            taken = batch.take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([*(taken.column(n) for n in (*names, "ts")), pa.array(found, pa.string())], names=[*keys, "ts", "event"])

    from pyspark.sql.pandas.types import to_arrow_schema

    summary_type = StructType([*kinds, place, StructField("times", ArrayType(LongType())), StructField("actives", ArrayType(BooleanType())), StructField("recoveries", ArrayType(LongType())), StructField("fires", BooleanType()), StructField("first", LongType())])
    start_type = StructType([*kinds, place, StructField("__active", BooleanType()), StructField("__recovered", LongType())])
    summary_schema, start_schema = to_arrow_schema(summary_type), to_arrow_schema(start_type)
    dealt = rows.drop("ts").repartition(*cut).sortWithinPartitions(*cut, "__us", "__on")
    slices = dealt.mapInArrow(summed, summary_type)
    in_order = (slices.repartition(*names) if keys else slices.coalesce(1)).sortWithinPartitions(*cut)
    starts = in_order.mapInArrow(started, start_type)
    # a slice's state stands before its results, whose times aren't null
    both = rows.unionByName(starts, allowMissingColumns=True).repartition(*cut).sortWithinPartitions(*cut, F.col("__us").asc_nulls_first(), "__on")
    out = StructType([*(states.schema[k] for k in keys), StructField("ts", states.schema[ts].dataType), StructField("event", StringType())])
    return both.mapInArrow(events, out)
