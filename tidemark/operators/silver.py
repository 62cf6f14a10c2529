"""Session-aware gap filling of candles on trading-minute spines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.normalize import classify_instrument
from ..functions.time import MARKET_TZ, local_time, trading_date, utc_time

#: Local minutes of the day in which a candle is expected, ends included.
#: 90 minutes from 09:00 for derivatives, 75 from 09:15 for stocks and indexes (so both
#: mornings end at 10:29, though trading goes on to 11:30), 90 from 13:00, and 14:45.
SPINES = {"DERIVATIVE": ((540, 629), (780, 869), (885, 885)), "STOCK": ((555, 629), (780, 869), (885, 885)), "INDEX": ((555, 629), (780, 869), (885, 885))}


def _minutes(kind: str) -> Column:
    return F.concat(*(F.sequence(F.lit(a), F.lit(b)) for a, b in SPINES[kind]))


def trading_minutes(days: DataFrame, kind: str | Column, tz: str = MARKET_TZ, date: str = "trading_date") -> DataFrame:
    """Each day's expected candle times in UTC (``time``): 181 for derivatives, 166 for others."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    minutes = F.when(kind == "DERIVATIVE", _minutes("DERIVATIVE")).otherwise(_minutes("STOCK"))
    local = F.col(date).cast("timestamp_ntz") + F.make_dt_interval(mins=F.col("__minute"))
    return days.withColumn("__minute", F.explode(minutes)).withColumn("time", utc_time(local, tz)).drop("__minute")


def gap_fill(bars: DataFrame, days: DataFrame, symbols: DataFrame, tz: str = MARKET_TZ) -> DataFrame:
    """1-minute candles on the spine of each symbol and day.

    ``bars`` has (symbol, time, open, high, low, close, volume), ``days`` trading_date,
    ``symbols`` symbol. A missing candle repeats the last close of its day with volume 0
    and ``is_filled``; before the day's first candle prices stay null. Candles off the
    spine are dropped; of two for one minute the one with more volume stays.
    Days without any candle at all give no rows. One shuffle serves the join (a union here) and the window.
    """
    dated = bars.withColumn("trading_date", trading_date("time", tz))
    present = dated.select("trading_date").distinct()
    open_days = days.select("trading_date").distinct().join(present, "trading_date", "left_semi")
    kinds = symbols.select("symbol").distinct().withColumn("bar_type", classify_instrument("symbol"))
    spine = trading_minutes(kinds.crossJoin(F.broadcast(open_days)), F.col("bar_type"), tz)
    own = F.struct("volume", "close", "open", "high", "low")
    both = spine.select("symbol", "trading_date", "time", "bar_type", F.lit(None).cast(dated.select(own.alias("x")).schema["x"].dataType).alias("bar")).unionByName(dated.select("symbol", "trading_date", "time", F.lit(None).cast("string").alias("bar_type"), own.alias("bar")))
    # One exchange: the grouping by minute and the window by day both accept it.
    minute = both.repartition("symbol", "trading_date").groupBy("symbol", "trading_date", "time").agg(F.max("bar_type").alias("bar_type"), F.max("bar").alias("bar")).filter(F.col("bar_type").isNotNull())
    day = Window.partitionBy("symbol", "trading_date").orderBy("time").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    missing = F.col("bar").isNull()
    return minute.withColumn("carried", F.last("bar.close", ignorenulls=True).over(day)).select(
        "symbol", "time", *(F.when(missing, F.col("carried")).otherwise(F.col(f"bar.{c}")).alias(c) for c in ("open", "high", "low", "close")), F.when(missing, F.lit(0)).otherwise(F.col("bar.volume")).cast("bigint").alias("volume"),
        "bar_type", missing.alias("is_filled"), "trading_date",
    )


def forward_fill(rows: DataFrame, keys: list[str], order: str, columns: list[str]) -> DataFrame:
    """Nulls of columns take the last known value of their key; leading ones stay."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in columns})


def enrich_daily(bars: DataFrame, tz: str = MARKET_TZ) -> DataFrame:
    """Daily candles with their kind and trading date; nothing is filled."""
    return bars.withColumn("bar_type", classify_instrument("symbol")).withColumn("is_filled", F.lit(False)).withColumn("trading_date", local_time("time", tz).cast("date"))


def silver(bronze: DataFrame, days: DataFrame, symbols: DataFrame | None = None, resolution: str = "1min", done: DataFrame | None = None, tz: str = MARKET_TZ) -> DataFrame:
    """The silver candles of any number of days and symbols as one job.

    ``done`` (symbol, resolution, date) names what is stored already and is left out.
    """
    rows = bronze.filter(F.col("resolution") == resolution)
    wanted = (symbols if symbols is not None else rows).select("symbol").distinct()
    rows = rows.join(wanted, "symbol", "left_semi")
    if resolution == "1min":
        out = gap_fill(rows, days, wanted, tz)
    else:
        inside = days.select(F.col("trading_date").alias("__d")).distinct()
        out = enrich_daily(rows, tz).join(inside, F.col("trading_date") == F.col("__d"), "left_semi").select("symbol", "time", "open", "high", "low", "close", "volume", "bar_type", "is_filled", "trading_date")
    out = out.withColumn("resolution", F.lit(resolution)).withColumn("date", F.date_format("trading_date", "yyyy-MM-dd"))
    return out.join(done.select("symbol", "resolution", "date").distinct(), ["symbol", "resolution", "date"], "left_anti") if done is not None else out


def silver_stats(silver_rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """How many symbols and rows came out, and how many wanted symbols did not."""
    per = silver_rows.groupBy("symbol").agg(F.count("*").alias("n"))
    return wanted.select("symbol").distinct().join(per, "symbol", "left").agg(F.count("n").alias("symbols"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count_if(F.col("n").isNull()).alias("skipped"))
