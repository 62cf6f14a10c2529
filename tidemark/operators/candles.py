"""Candles from ticks, index snapshots and other candles.

Names of columns are parameters; buckets are half open and start on the UTC grid,
days and weeks on the market's clock.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.time import MARKET_TZ, bucket, latency_ms, local_time

#: Widths that ``resample`` knows; others fall back to one minute.
RESAMPLED = ("1 minute", "3 minutes", "5 minutes", "15 minutes", "30 minutes", "1 hour", "day", "week")
BREADTH = ("up_count", "down_count", "steady_count", "upper_limit_count", "lower_limit_count")


def _order(ts: str, tie: tuple[str, ...]) -> Column:
    """What first and last go by. A plain time keeps the aggregation hash-based."""
    return F.struct(ts, *tie) if tie else F.col(ts)


def ohlcv(ticks: DataFrame, width: str = "1 minute", keys: tuple[str, ...] = ("symbol",), ts: str = "exchange_ts", price: str = "price", quantity: str = "quantity", side: str = "side", gateway: str | None = "gateway_ts", tie: tuple[str, ...] = (), tz: str = MARKET_TZ) -> DataFrame:
    """Open, high, low, close, volumes, turnover, tick count and mean latency of each key and bucket.

    Equal times are told apart by ``tie``, columns that order ticks within a time.
    """
    at, q = _order(ts, tie), F.col(quantity).cast("bigint")
    latency = F.avg(latency_ms(gateway, ts)) if gateway else F.lit(None).cast("double")
    return ticks.groupBy(*keys, bucket(ts, width, tz).alias("bucket")).agg(
        F.min_by(price, at).alias("open"), F.max(price).alias("high"), F.min(price).alias("low"), F.max_by(price, at).alias("close"), F.sum(q).alias("volume"), F.sum(F.col(quantity) * F.col(price)).alias("turnover"),
        F.sum(F.when(F.col(side) == 1, q).otherwise(0)).alias("buy_vol"), F.sum(F.when(F.col(side) == 2, q).otherwise(0)).alias("sell_vol"), F.count("*").alias("tick_count"), latency.alias("avg_latency_ms"),
    )


def index_ohlc(snaps: DataFrame, width: str = "1 minute", keys: tuple[str, ...] = ("index_name",), ts: str = "exchange_ts", value: str = "value", volume: str = "total_volume", turnover: str | None = "total_value", breadth: tuple[str, ...] = BREADTH, gateway: str | None = "gateway_ts", tie: tuple[str, ...] = (), tz: str = MARKET_TZ) -> DataFrame:
    """Candles of index values; volume is the rise of the cumulative one inside the bucket."""
    at = _order(ts, tie)
    out = [F.min_by(value, at).alias("open"), F.max(value).alias("high"), F.min(value).alias("low"), F.max_by(value, at).alias("close"), (F.max(volume) - F.min(volume)).alias("volume")]
    if turnover:
        out.append((F.max(turnover) - F.min(turnover)).alias("turnover"))
    out += [F.max_by(b, at).alias(b) for b in breadth]
    if gateway:
        out.append(F.avg(latency_ms(gateway, ts)).alias("avg_latency_ms"))
    return snaps.groupBy(*keys, bucket(ts, width, tz).alias("bucket")).agg(*out)


def index_volume_exact(snaps: DataFrame, width: str = "1 minute", keys: tuple[str, ...] = ("index_name",), ts: str = "exchange_ts", volume: str = "total_volume", tz: str = MARKET_TZ) -> DataFrame:
    """Volume of each bucket with the rise since the bucket before it on the same day, which ``index_ohlc`` leaves out."""
    from pyspark.sql import Window

    per = snaps.groupBy(*keys, bucket(ts, width, tz).alias("bucket")).agg(F.max(volume).alias("top"))
    day = per.withColumn("day", local_time("bucket", tz).cast("date"))
    before = F.lag("top").over(Window.partitionBy(*keys, "day").orderBy("bucket"))
    return day.select(*keys, "bucket", (F.col("top") - F.coalesce(before, F.lit(0))).alias("volume"))


def resample(bars: DataFrame, width: str, keys: tuple[str, ...] = ("symbol",), ts: str = "bucket", tz: str = MARKET_TZ) -> DataFrame:
    """Wider candles from narrower ones: first open, highest, lowest, last close, summed volumes."""
    width = {"1 day": "day", "1 week": "week"}.get(width, width)
    width = width if width in RESAMPLED else "1 minute"
    source = bars.withColumnRenamed(ts, "__at")
    sums = [c for c in ("volume", "turnover", "buy_vol", "sell_vol", "tick_count") if c in bars.columns]
    return source.groupBy(*keys, bucket("__at", width, tz).alias("bucket")).agg(F.min_by("open", "__at").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), F.max_by("close", "__at").alias("close"), *(F.sum(c).alias(c) for c in sums))


def frontier(bars: DataFrame, keys: tuple[str, ...] = ("symbol",), step: str = "1 minute") -> DataFrame:
    """First time of each key that its stored bars do not cover."""
    return bars.groupBy(*keys).agg((F.max("bucket") + F.expr(f"INTERVAL {step}")).alias("frontier"))


def ohlcv_live(bars: DataFrame, ticks: DataFrame, width: str, start: Column, end: Column, symbols: DataFrame | None = None, ts: str = "exchange_ts", tie: tuple[str, ...] = (), tz: str = MARKET_TZ) -> DataFrame:
    """Stored 1-minute bars up to each symbol's frontier and bars of newer ticks, as one series of a width.

    ``start`` is floored to the width. The frontier comes from all stored bars; only
    bars and ticks from the floored start on are read further. ``symbols`` (a
    DataFrame with that column) restricts both sides.
    """
    if symbols is not None:
        wanted = symbols.select("symbol").distinct()
        bars, ticks = bars.join(wanted, "symbol", "left_semi"), ticks.join(wanted, "symbol", "left_semi")
    first = floor_to(start, width, tz)
    edge = frontier(bars)
    stored = bars.filter(F.col("bucket") >= first).select("symbol", "bucket", "open", "high", "low", "close", "volume")
    # Every stored bar lies before its own symbol's frontier.
    newer = ticks.filter((F.col(ts) >= first) & (F.col(ts) <= end)).join(edge, "symbol", "left").filter(F.col("frontier").isNull() | (F.col(ts) >= F.col("frontier")))
    live = ohlcv(newer, "1 minute", ts=ts, tie=tie, tz=tz).select(*stored.columns)
    merged = resample(stored.unionByName(live), width, tz=tz)
    return merged.filter((F.col("bucket") >= first) & (F.col("bucket") <= end))


def floor_to(at: Column, width: str, tz: str = MARKET_TZ) -> Column:
    """A scalar time floored to its bucket."""
    if width in ("day", "week", "1 day", "1 week"):
        return bucket(at, width, tz)
    return F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'") + F.make_dt_interval(secs=(F.floor(F.unix_seconds(at.cast("timestamp")) / _seconds(width)) * _seconds(width)).cast("decimal(18,6)"))


def _seconds(width: str) -> int:
    n, unit = width.split()
    return int(n) * {"second": 1, "minute": 60, "hour": 3600}[unit.rstrip("s")]


def day_stats(bars: DataFrame, as_of: Column, tz: str = MARKET_TZ, keys: tuple[str, ...] = ("symbol",)) -> DataFrame:
    """Volume, high, low and ticks of each key since the local midnight before ``as_of``."""
    midnight = F.date_trunc("day", local_time(as_of, tz)).cast("timestamp_ntz")
    today = bars.filter((local_time("bucket", tz) >= midnight) & (F.col("bucket") <= as_of))
    return today.groupBy(*keys).agg(F.sum("volume").alias("volume"), F.max("high").alias("high"), F.min("low").alias("low"), F.sum("tick_count").alias("tick_count"))


def volume_by_side(bars: DataFrame) -> DataFrame:
    return bars.select("symbol", "bucket", "buy_vol", F.col("sell_vol"))


def latest(rows: DataFrame, keys: tuple[str, ...] = ("symbol",), ts: str = "exchange_ts", columns: tuple[str, ...] = (), tie: tuple[str, ...] = ()) -> DataFrame:
    """The newest row of each key."""
    kept = columns or tuple(c for c in rows.columns if c not in keys)
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*kept), _order(ts, tie)).alias("__row")).select(*keys, "__row.*")


def latest_board(quotes: DataFrame, trades: DataFrame, ts: str = "exchange_ts", tie: tuple[str, ...] = ()) -> DataFrame:
    """The newest quote beside the newest trade of each symbol."""
    q = latest(quotes, ts=ts, columns=("bid_price1", "ask_price1", ts), tie=tie).withColumnRenamed(ts, "quote_ts")
    t = latest(trades, ts=ts, columns=("price", "quantity", "side", ts), tie=tie).withColumnRenamed(ts, "trade_ts")
    return q.join(t, "symbol")


def series(bars: DataFrame, keys: tuple[str, ...] = ("symbol",)) -> DataFrame:
    """Candles in order of their buckets."""
    return bars.orderBy(*keys, "bucket")


def symbols(df: DataFrame, key: str = "symbol") -> DataFrame:
    return df.select(key).distinct().orderBy(key)
