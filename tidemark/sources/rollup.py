"""Stored candles that late ticks refresh.

A store has two tables below its path. ``touched`` is a log: each batch of ticks adds
one row for every key and bucket it has ticks of. ``bars`` has candles with the number
of batches they were made from (``touches``). A candle is stale while the log has
more batches of it than the candle; a refresh reads the ticks of stale buckets only,
aggregates them anew and appends the result, of which readers take the newest. A job that
dies, or is run again, leaves nothing wrong: what it didn't write is still stale.

Ticks must be in their own table before their batch is logged. ``candle`` is the function
that makes candles of ticks; any that groups by ``keys`` and ``bucket`` will do.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.time import MARKET_TZ, bucket
from . import journal

KEYS = ("symbol",)


def _dated(rows: DataFrame) -> DataFrame:
    return rows.withColumn("date", F.date_format("bucket", "yyyy-MM-dd"))


def log_touched(ticks: DataFrame, path: str, number: int, application: str = "ticks", width: str = "1 minute", keys: tuple[str, ...] = KEYS, ts: str = "exchange_ts", tz: str = MARKET_TZ) -> bool:
    """Note the buckets of a batch, once for each application and number; whether it was new."""
    rows = ticks.filter(F.col(ts).isNotNull()).select(*keys, bucket(ts, width, tz).alias("bucket")).distinct().withColumn("touches", F.lit(1).cast("bigint"))
    return journal.append_batch(_dated(rows), f"{path}/touched", ["date"], application, number)


def _stored(spark: SparkSession, path: str, name: str, since: Column | None, until: Column | None) -> DataFrame | None:
    """A table of the store, its date partitions cut to a range; None before the first row."""
    where = f"{path}/{name}"
    journal.settle(spark, where)
    if not journal.Store(spark, where).leaves("", 1):
        return None
    rows = spark.read.option("basePath", where).parquet(where).withColumn("date", F.col("date").cast("string"))
    if since is not None:
        rows = rows.filter((F.col("bucket") >= since) & (F.col("date") >= F.date_format(since, "yyyy-MM-dd")))
    if until is not None:
        rows = rows.filter((F.col("bucket") < until) & (F.col("date") <= F.date_format(until, "yyyy-MM-dd")))
    return rows


def bars(spark: SparkSession, path: str, keys: tuple[str, ...] = KEYS, since: Column | None = None, until: Column | None = None) -> DataFrame | None:
    """The newest version of every candle of a range (``until`` excluded), with ``touches``."""
    rows = _stored(spark, path, "bars", since, until)
    if rows is None:
        return None
    values = [c for c in rows.columns if c not in (*keys, "bucket", "date")]
    return rows.groupBy(*keys, "bucket").agg(F.max_by(F.struct(*values), "touches").alias("b")).select(*keys, "bucket", "b.*")


def stale(spark: SparkSession, path: str, keys: tuple[str, ...] = KEYS, since: Column | None = None, until: Column | None = None) -> DataFrame | None:
    """(keys, bucket, touches) of candles with more batches in the log than they were made from."""
    log = _stored(spark, path, "touched", since, until)
    if log is None:
        return None
    due = log.groupBy(*keys, "bucket").agg(F.sum("touches").alias("touches"))
    have = _stored(spark, path, "bars", since, until)
    if have is None:
        return due
    known = have.groupBy(*keys, "bucket").agg(F.max("touches").alias("__have"))
    return due.join(known, [*keys, "bucket"], "left").filter(F.col("touches") > F.coalesce("__have", F.lit(0))).drop("__have")


def refresh(spark: SparkSession, ticks: DataFrame, path: str, candle: Callable[[DataFrame], DataFrame], width: str = "1 minute", as_of: Column | None = None, lookback: str | None = None, lag: str | None = None, keys: tuple[str, ...] = KEYS, ts: str = "exchange_ts", tz: str = MARKET_TZ) -> int:
    """Make the stale candles anew; how many there were.

    With ``as_of``, only buckets from ``lookback`` before it to ``lag`` before it are
    looked at: others stay stale until a refresh reaches them. The first and last stale
    bucket (one row) are looked up, so that ticks are read with plain bounds on their time.
    """
    since = as_of - F.expr(f"INTERVAL {lookback}") if as_of is not None and lookback else None
    until = as_of - F.expr(f"INTERVAL {lag}") if as_of is not None and lag else as_of
    due = stale(spark, path, keys, since, until)
    if due is None:
        return 0
    due = due.persist()
    try:
        low, high, n = due.agg(F.min("bucket"), F.max("bucket"), F.count("*")).first()
        if not n:
            return 0
        span = {"day": "1 day", "week": "7 days"}.get(width, width)
        kind = ticks.schema[ts].dataType.simpleString()
        low, high = F.lit(low).cast(kind), F.lit(high).cast(kind) + F.expr(f"INTERVAL {span}")
        if width in ("day", "week", "1 day", "1 week"):  # these follow the market's clock
            low, high = low - F.expr("INTERVAL 1 DAY"), high + F.expr("INTERVAL 1 DAY")
        near = ticks.filter((F.col(ts) >= low) & (F.col(ts) < high))
        placed = near.withColumn("__bucket", bucket(ts, width, tz))
        wanted = due.select(*keys, F.col("bucket").alias("__bucket"))
        made = candle(placed.join(wanted, [*keys, "__bucket"], "left_semi").select(*ticks.columns))
        journal.append(_dated(made.join(due, [*keys, "bucket"])), f"{path}/bars", ["date"])
        return n
    finally:
        due.unpersist()


def compact_day(spark: SparkSession, path: str, day: str, keys: tuple[str, ...] = KEYS) -> None:
    """Only the newest version of a date's candles."""
    journal.recover(spark, f"{path}/bars")
    newest = bars(spark, path, keys, F.lit(day).cast("timestamp_ntz"), F.lit(day).cast("timestamp_ntz") + F.expr("INTERVAL 1 DAY"))
    if newest is not None:
        journal.swap_partitions(_dated(newest), f"{path}/bars", ["date"])
