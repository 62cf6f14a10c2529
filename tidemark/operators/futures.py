"""Rolling futures: which contract a rolling symbol stands for on each day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.time import MARKET_TZ, utc_time
from .dedup import runs

#: Months with a quarterly expiry, and the physical prefix of each rolling family.
QUARTER_MONTHS = (3, 6, 9, 12)
PREFIXES = {"VN30": "41I1", "V100": "41I2"}


def candidates(instruments: DataFrame, family: str = "VN30", market: str = "DVX", group: str = "FU") -> DataFrame:
    """(symbol, expiry) of a family's contracts."""
    own = F.col("symbol").startswith(PREFIXES[family]) & (F.col("market_id") == market) & (F.col("security_group_id") == group)
    return instruments.filter(own & F.col("final_trade_date").isNotNull()).select("symbol", F.col("final_trade_date").alias("expiry"))


def roll_periods(contracts: DataFrame, keys: tuple[str, ...] = (), quarter_months: tuple[int, ...] = QUARTER_MONTHS) -> DataFrame:
    """(keys, code, symbol, after, until): the days after one date and up to another on which a code means a contract.

    A contract is alive up to its expiry day. The months' codes are the first two
    alive ones; the quarters' are the first two quarterly expiries after F2M's. Each
    contract's days follow from its neighbours by expiry, so no days are joined.
    """
    order = Window.partitionBy(*keys).orderBy("expiry", "symbol")
    placed = contracts.select(*keys, "symbol", "expiry", F.datediff("expiry", F.lit("1970-01-01").cast("date")).alias("n"))
    quarter = F.when(F.month("expiry").isin(*quarter_months), F.struct("expiry", "symbol"))
    later = Window.partitionBy(*keys).orderBy("n").rangeBetween(1, Window.unboundedFollowing)
    row = placed.withColumns({"one": F.lag("expiry", 1).over(order), "two": F.lag("expiry", 2).over(order), "q1": F.min(quarter).over(later)})
    first = row.select(*keys, F.lit("F1M").alias("code"), "symbol", F.col("one").alias("after"), F.col("expiry").alias("until"))
    second = row.filter("one IS NOT NULL").select(*keys, "symbol", F.col("two").alias("after"), F.col("one").alias("until"), "q1")
    ranked = placed.filter(F.month("expiry").isin(*quarter_months)).withColumn("next", F.lead("symbol").over(order)).select(*keys, F.col("symbol").alias("__s"), "next")
    quarters = second.filter("q1 IS NOT NULL").select(*keys, F.col("q1.symbol").alias("__s"), "after", "until")
    nexts = quarters.join(ranked, [*keys, "__s"])
    out = first.unionByName(second.select(*keys, F.lit("F2M").alias("code"), "symbol", "after", "until"))
    out = out.unionByName(quarters.select(*keys, F.lit("F1Q").alias("code"), F.col("__s").alias("symbol"), "after", "until"))
    out = out.unionByName(nexts.filter("next IS NOT NULL").select(*keys, F.lit("F2Q").alias("code"), F.col("next").alias("symbol"), "after", "until"))
    return out.filter(F.col("after").isNull() | (F.col("after") < F.col("until")))


def roll_daily(contracts: DataFrame, start: Column, end: Column, keys: tuple[str, ...] = (), quarter_months: tuple[int, ...] = QUARTER_MONTHS) -> DataFrame:
    """(keys, day, code, symbol) for codes F1M, F2M, F1Q and F2Q on every calendar day of a range."""
    start, end = start.cast("date"), end.cast("date")
    spans = roll_periods(contracts, keys, quarter_months).withColumns({"lo": F.greatest(start, F.date_add("after", 1)), "hi": F.least(end, F.col("until"))})
    return spans.filter("lo <= hi").select(*keys, F.explode(F.sequence("lo", "hi")).alias("day"), "code", "symbol")


def roll_intervals(daily: DataFrame, start: Column | None = None, end: Column | None = None, keys: tuple[str, ...] = (), tz: str = MARKET_TZ) -> DataFrame:
    """Runs of equal mapping as UTC intervals from local midnight to the last microsecond, clipped to the request."""
    # A day that is missing ends a run: consecutive days share (day - rank).
    w = Window.partitionBy(*keys, "code").orderBy("day")
    island = daily.withColumn("island", F.date_sub("day", F.row_number().over(w)))
    found = runs(island, [*keys, "code"], "day", ["symbol", "island"])
    begin = utc_time(F.col("first").cast("timestamp_ntz"), tz)
    finish = utc_time(F.date_add("last", 1).cast("timestamp_ntz"), tz) - F.expr("INTERVAL '0.000001' SECOND")
    out = found.select(*keys, "code", "symbol", (F.greatest(begin, start) if start is not None else begin).alias("valid_from"), (F.least(finish, end) if end is not None else finish).alias("valid_to"))
    return out.filter(F.col("valid_from") < F.col("valid_to"))


def attach_contracts(ticks: DataFrame, intervals: DataFrame, ts: str = "exchange_ts") -> DataFrame:
    """Ticks of physical contracts with the rolling codes that hold at their time."""
    spans = intervals.select(F.col("symbol").alias("__s"), "code", "valid_from", "valid_to")
    inside = (F.col("symbol") == F.col("__s")) & (F.col(ts) >= F.col("valid_from")) & (F.col(ts) <= F.col("valid_to"))
    return ticks.join(spans, inside).drop("__s", "valid_from", "valid_to")
