"""Run histories, service metrics, counters and lags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.time import MARKET_TZ, local_time
from . import scan


def _duration_us(start: str = "start_date", end: str = "end_date") -> Column:
    return F.unix_micros(F.col(end).cast("timestamp")) - F.unix_micros(F.col(start).cast("timestamp"))


def _quotient(total: Column, parts: Column, places: int) -> Column:
    """Whole total / whole parts, rounded half away from zero in integers, so that ties don't hang on a double."""
    up = 10**places
    whole = F.call_function("div", F.abs(total) * (2 * up) + parts, parts * 2)
    return F.signum(total) * whole / up


def _mean_of(value: Column, unit: int, places: int) -> Column:
    """The mean of whole values in units of so many, rounded."""
    return _quotient(F.sum(value), F.count(value) * unit, places)


def run_history(runs: DataFrame, as_of: Column, hours: int = 24, keys: tuple[str, ...] = ("dag_id", "state")) -> DataFrame:
    """Runs started in the last hours by job and state: count, last end, mean seconds."""
    recent = runs.filter((F.col("start_date") >= as_of - F.make_dt_interval(hours=F.lit(hours))) & (F.col("start_date") <= as_of))
    return recent.groupBy(*keys).agg(F.count("*").alias("n"), F.max("end_date").alias("last_end"), _mean_of(_duration_us(), 1000000, 1).alias("avg_s"))


def task_history(runs: DataFrame, as_of: Column, days: int = 7, keys: tuple[str, ...] = ("dag_id", "task_id", "state")) -> DataFrame:
    """Count, mean and longest minutes of the last days by job, task and state."""
    recent = runs.filter((F.col("start_date") >= as_of - F.make_dt_interval(days=F.lit(days))) & (F.col("start_date") <= as_of))
    return recent.groupBy(*keys).agg(F.count("*").alias("n"), _mean_of(_duration_us(), 60000000, 2).alias("avg_min"), _quotient(F.max(_duration_us()), F.lit(60000000).cast("long"), 2).alias("max_min"))


def hourly_duration(runs: DataFrame, state: str = "success", keys: tuple[str, ...] = ("dag_id",)) -> DataFrame:
    hour = F.date_trunc("hour", "start_date").cast("timestamp_ntz")
    return runs.filter(F.col("state") == state).groupBy(*keys, hour.alias("hour")).agg(_mean_of(_duration_us(), 1000000, 1).alias("avg_s"))


def runs_on_day(runs: DataFrame, as_of: Column, state: str = "success", tz: str = MARKET_TZ) -> DataFrame:
    same = local_time("start_date", tz).cast("date") == local_time(as_of, tz).cast("date")
    return runs.filter((F.col("state") == state) & same).agg(F.count("*").alias("n"))


def failing_jobs(jobs: DataFrame, stats: DataFrame, key: str = "job_id") -> DataFrame:
    """Jobs without a successful last run, or without any."""
    return jobs.join(stats, key, "left").filter(F.col("last_run_status").isNull() | (F.col("last_run_status") != "Success") | (F.coalesce("total_failures", F.lit(0)) > 0))


def service_metrics(counts: DataFrame, keys: tuple[str, ...] = ("service_name",), window: str = "30 seconds", ts: str = "ts") -> DataFrame:
    """Metric rows (ts, service_name, metric_name, metric_value, label) of each window.

    ``counts`` has messages, errors, reconnects and lag of a service over ``elapsed_s``.
    """
    per = counts.groupBy(*keys, F.window(ts, window)["start"].alias("ts"), "label").agg(F.sum("messages").alias("m"), F.sum("errors").alias("error_count"), F.sum("reconnects").alias("reconnects"), F.max("lag").alias("lag"), F.sum("elapsed_s").alias("s"))
    rate = per.withColumn("msg_rate", _quotient(F.col("m"), F.greatest("s", F.lit(1)), 4))
    number = lambda c: F.col(c).cast("double")
    return rate.select("ts", *keys, "label", F.explode(F.create_map(*[x for n in ("msg_rate", "error_count", "reconnects", "lag") for x in (F.lit(n), number(n))])).alias("metric_name", "metric_value")).filter(F.col("metric_value").isNotNull())


def counted(rows: DataFrame, **counts: Column) -> tuple[DataFrame, Observation]:
    """Rows, and named counts that Spark takes as they pass: no second scan.

    ``counts`` are aggregates; the observation has them once an action on the rows has ended.
    """
    seen = Observation()
    return rows.observe(seen, *(c.alias(k) for k, c in counts.items())), seen


def metric_rows(spark: SparkSession, seen: Observation, as_of: str, service: str, label: str = "") -> DataFrame:
    """An ended observation as metric rows (ts, service_name, metric_name, metric_value, label): one for each count."""
    rows = [(service, k, float(v or 0), label) for k, v in seen.get.items()]
    return spark.createDataFrame(rows, "service_name string, metric_name string, metric_value double, label string").select(F.lit(as_of).cast("timestamp_ntz").alias("ts"), "*")


def consumer_lag(offsets: DataFrame, keys: tuple[str, ...] = ("group_id", "topic")) -> DataFrame:
    """Sum over partitions of how far the committed offset is behind; never below 0."""
    return offsets.groupBy(*keys).agg(F.sum(F.greatest(F.lit(0), F.col("end_offset") - F.coalesce("committed_offset", F.lit(0)))).alias("lag"))


def counter_increase(samples: DataFrame, keys: tuple[str, ...], ts: str = "ts", value: str = "value", slice_s: int = scan.SLICE_S) -> DataFrame:
    """The rise since the sample before; after a reset, the whole value.

    A counter's history is cut into slices (see ``scan``), so one counter is many tasks.
    """
    before = scan.lag(samples, list(keys), [ts], {"__previous": value}, slice_s)
    rise = F.when(F.col("__previous").isNull(), None).when(F.col(value) < F.col("__previous"), F.col(value)).otherwise(F.col(value) - F.col("__previous"))
    return before.withColumn("increase", rise).drop("__previous")


def counter_rate(samples: DataFrame, keys: tuple[str, ...], seconds: int, ts: str = "ts", value: str = "value", slice_s: int = scan.SLICE_S) -> DataFrame:
    """Rise a second over the trailing window, resets allowed for."""
    risen = counter_increase(samples, keys, ts, value, slice_s)
    summed = scan.trailing_sum(risen, list(keys), ts, "increase", seconds, "__risen")
    return summed.withColumn("rate", F.coalesce("__risen", F.lit(0)) / seconds).drop("__risen")


def run_totals(results: DataFrame, keys: tuple[str, ...] = ("resolution",)) -> DataFrame:
    """Fetched, inserted and skipped rows, and the failed symbols."""
    return results.groupBy(*keys).agg(F.sum("fetched").alias("fetched"), F.sum("inserted").alias("inserted"), F.sum("skipped").alias("skipped"), F.array_sort(F.collect_set(F.when(F.col("status") == "failed", F.col("symbol")))).alias("failed"))


def active_counts(instruments: DataFrame, secdef: DataFrame, as_of: Column) -> DataFrame:
    today = secdef.filter(F.col("trading_date") == as_of).agg(F.count("*").alias("secdef_today"))
    return instruments.agg(F.count_if("is_active").alias("active_instruments")).crossJoin(today)


def within_retention(ranges: DataFrame, policy: DataFrame, as_of: Column, start: str = "range_start") -> DataFrame:
    """Ranges whose start a target still keeps, by each target's days."""
    return ranges.join(policy, "target").filter(F.col(start) >= as_of - F.make_dt_interval(days=F.col("keep_days"))).drop("keep_days")
