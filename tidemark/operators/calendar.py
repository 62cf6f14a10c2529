"""Trading calendar: membership, neighbours, enumeration, chunks of ranges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.time import MARKET_TZ, trading_date


def on_trading_days(rows: DataFrame, calendar: DataFrame, ts: str = "exchange_ts", tz: str = MARKET_TZ) -> DataFrame:
    """Rows whose local day is in the calendar."""
    days = calendar.select(F.col("trading_date").alias("__day")).distinct()
    return rows.join(days, trading_date(ts, tz) == F.col("__day"), "left_semi")


def is_trading_day(dates: DataFrame, calendar: DataFrame, date: str = "date") -> DataFrame:
    days = calendar.select(F.col("trading_date").alias(date)).distinct().withColumn("is_trading_day", F.lit(True))
    return dates.join(days, date, "left").withColumn("is_trading_day", F.coalesce("is_trading_day", F.lit(False)))


def previous_trading_date(dates: DataFrame, calendar: DataFrame, date: str = "date") -> DataFrame:
    """The last trading day strictly before each date; null before the first one.

    One pass: both sides are put in order by month, and the last trading day before a
    month comes from the (small) table of months.
    """
    marks = calendar.select(F.col("trading_date").alias("at")).distinct().withColumn("mark", F.col("at"))
    asked = dates.select(F.col(date).alias("at")).distinct().withColumn("asked", F.lit(True))
    both = marks.join(asked, "at", "full").withColumn("month", F.trunc("at", "month"))
    ends = both.groupBy("month").agg(F.max("mark").alias("end"))
    carried = ends.select("month", F.max("end").over(Window.orderBy("month").rowsBetween(Window.unboundedPreceding, -1)).alias("carried"))
    before = F.last("mark", ignorenulls=True).over(Window.partitionBy("month").orderBy("at").rowsBetween(Window.unboundedPreceding, -1))
    found = both.withColumn("before", before).join(carried, "month").filter("asked").select(F.col("at").alias(date), F.coalesce("before", "carried").alias("previous_date"))
    return dates.join(found, date, "left")


def trading_dates(calendar: DataFrame, start: Column, end: Column) -> DataFrame:
    """Trading days of a range: weekdays before the calendar's first day, its own days after, and all weekdays if it has none."""
    spark = calendar.sparkSession
    days = spark.range(1).select(F.explode(F.sequence(start.cast("date"), end.cast("date"))).alias("trading_date"))
    # The bounds of the calendar within the range decide which rule holds.
    own = calendar.filter(F.col("trading_date").between(start.cast("date"), end.cast("date"))).select("trading_date").distinct()
    first = own.agg(F.min("trading_date").alias("first_day"))
    marked = days.join(own.withColumn("listed", F.lit(True)), "trading_date", "left").crossJoin(F.broadcast(first))
    weekday = F.weekday("trading_date") < 5
    return marked.filter(F.when(F.col("first_day").isNull() | (F.col("trading_date") < F.col("first_day")), weekday).otherwise(F.coalesce("listed", F.lit(False)))).select("trading_date")


def summary(calendar: DataFrame) -> DataFrame:
    """Count, first and last day; an error if the calendar is empty."""
    one = calendar.agg(F.count("*").alias("n_days"), F.min("trading_date").alias("first_day"), F.max("trading_date").alias("last_day"))
    return one.withColumn("n_days", F.when(F.col("n_days") > 0, F.col("n_days")).otherwise(F.raise_error(F.lit("the calendar is empty"))))


def days_within(calendar: DataFrame, start: Column, end: Column) -> DataFrame:
    """The days of a range as one sorted list, with the calendar's first day."""
    inside = F.col("trading_date").between(start, end)
    return calendar.agg(F.sort_array(F.collect_list(F.when(inside, F.col("trading_date")))).alias("days"), F.min("trading_date").alias("first_day"))


def time_chunks(ranges: DataFrame, days: int, start: str = "range_start", end: str = "range_end") -> DataFrame:
    """Each range cut into pieces of ``days``; the last one ends with the range."""
    step = F.make_dt_interval(days=F.lit(days))
    cut = ranges.withColumn("chunk_start", F.explode(F.sequence(F.col(start), F.col(end), step))).filter(F.col("chunk_start") < F.col(end))
    return cut.withColumn("chunk_end", F.least(F.col("chunk_start") + step, F.col(end)))
