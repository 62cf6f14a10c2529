"""One key over all rows runs in many tasks and gives what one sort gives."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import dedup, ops_metrics, quality, scan

START = dt.datetime(2024, 1, 2, 3)


def samples(spark, n=600, keys=("a", "b", None), seed=3):
    rng, rows = random.Random(seed), []
    for key in keys:
        at, value = START, 0
        for i in range(n):
            at += dt.timedelta(seconds=rng.choice([1, 30, 400, 9000]))
            value = rng.randint(0, 5) if rng.random() < 0.05 else value + rng.randint(0, 9)
            rows.append((key, at, None if rng.random() < 0.03 else value, i))
    return spark.createDataFrame(rows, "key string, ts timestamp_ntz, value bigint, n int")


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("seconds", [60, 3600, 10**9])
def test_lag_over_slices(spark, seconds):
    s = samples(spark)
    w = Window.partitionBy("key").orderBy("ts")
    want = s.withColumns({"p": F.lag("value").over(w), "q": F.lag("n").over(w)})
    assert rows_of(scan.lag(s, ["key"], ["ts"], {"p": "value", "q": "n"}, seconds)) == rows_of(want)
    one = s.filter("key = 'a'").drop("key")
    want = one.withColumn("p", F.lag("n").over(Window.orderBy("ts")))
    assert rows_of(scan.lag(one, [], ["ts"], {"p": "n"}, seconds)) == rows_of(want)


@pytest.mark.parametrize("seconds", [60, 3600])
def test_last_mark_over_slices(spark, seconds):
    s = samples(spark).withColumn("mark", F.when(F.col("n") % 17 == 5, F.col("n")))
    want = s.withColumn("m", F.last("mark", ignorenulls=True).over(Window.partitionBy("key").orderBy("ts").rowsBetween(Window.unboundedPreceding, 0)))
    assert rows_of(scan.last_mark(s, ["key"], ["ts"], "mark", "m", seconds)) == rows_of(want)


@pytest.mark.parametrize("window,slice_s", [(60, 3600), (3600, 60), (3600, 3600), (86400, 7200)])
def test_counter_rate_over_slices(spark, window, slice_s):
    s = samples(spark).filter("key IS NOT NULL AND value IS NOT NULL")
    w = Window.partitionBy("key").orderBy("ts")
    p = F.lag("value").over(w)
    risen = s.withColumn("increase", F.when(p.isNull(), None).when(F.col("value") < p, F.col("value")).otherwise(F.col("value") - p)).withColumn("us", F.unix_micros(F.col("ts").cast("timestamp")))
    back = Window.partitionBy("key").orderBy("us").rangeBetween(-window * 1_000_000, 0)
    want = risen.withColumn("rate", F.coalesce(F.sum("increase").over(back), F.lit(0)) / window).drop("us")
    assert rows_of(ops_metrics.counter_rate(s, ("key",), window, slice_s=slice_s).select(*want.columns)) == rows_of(want)


def test_rate_work_does_not_grow_with_the_window(spark, capsys):
    """No frame moves along its lower bound: such a frame adds up all its rows anew for each row."""
    ops_metrics.counter_rate(samples(spark), ("key",), 3600).explain()
    bounds = {x.split(",")[0].strip() for x in capsys.readouterr().out.split("specifiedwindowframe(RangeFrame,")[1:]}
    assert bounds == {"unboundedpreceding$()"}


@pytest.mark.parametrize("seconds", [1, 60, 3600, 10**6])
def test_trailing_sum_on_odd_rows(spark, seconds):
    """Ties, times on both ends of a window, before 1970 and missing, null values and keys, fractions, a clash of large and small values."""
    rng, rows = random.Random(seconds), []
    for key in ("a", "b", None):
        for start in (START, dt.datetime(1969, 12, 31, 23)):
            at = start
            for i in range(300):
                at += dt.timedelta(seconds=rng.choice([0, 0, 1, 59, 60, 3600]), microseconds=rng.choice([0, 0, 0, 1, -1]))
                rows.append((key, None if rng.random() < 0.03 else at, None if rng.random() < 0.1 else rng.randint(-9, 9), rng.choice([0.25, 2.0**40, -1.5]), i))
    s = spark.createDataFrame(rows, "key string, ts timestamp_ntz, v bigint, x double, n int")
    back = Window.partitionBy("key").orderBy(F.unix_micros(F.col("ts").cast("timestamp"))).rangeBetween(-seconds * 1_000_000, 0)
    want = s.withColumns({"sv": F.sum("v").over(back), "sx": F.sum("x").over(back)})
    got = scan.trailing_sum(scan.trailing_sum(s, ["key"], "ts", "v", seconds, "sv"), ["key"], "ts", "x", seconds, "sx")
    assert got.columns == want.columns and rows_of(got) == rows_of(want)
    one = s.filter("key = 'a'").drop("key")
    assert rows_of(scan.trailing_sum(one, [], "ts", "v", seconds, "sv")) == rows_of(want.filter("key = 'a'").drop("key", "sx"))


def test_runs_over_slices(spark):
    s = samples(spark, 400).withColumn("v", (F.col("n") / 23).cast("int") % 2).withColumn("v", F.when(F.col("n") % 60 < 50, F.col("v")))
    w = Window.partitionBy("key").orderBy("ts")
    fresh = s.withColumn("new", F.when(F.col("v").eqNullSafe(F.lag("v").over(w)) & F.lag("ts").over(w).isNotNull(), 0).otherwise(1))
    want = fresh.withColumn("run", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0))).groupBy("key", "v", "run").agg(F.min("ts"), F.max("ts"), F.count("*")).drop("run")
    for seconds in (60, 5000):
        assert rows_of(dedup.runs(s, ["key"], "ts", ["v"], seconds)) == rows_of(want)


def tasks_of(df, n):
    """In how many partitions of ``n`` a result's rows lie."""
    return df.select(F.spark_partition_id().alias("p")).distinct().count()


def test_one_key_is_many_tasks(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        s = samples(spark, 800, ("only",)).repartition(4)
        for df in (ops_metrics.counter_increase(s, ("key",)), ops_metrics.counter_rate(s, ("key",), 600), dedup.counter_resets(s, ["key"], ["ts"], "value"), quality.alert_transitions(s.select("key", "ts", (F.col("n") % 3 == 0).alias("firing")))):
            assert tasks_of(df, 16) >= 12
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def slow_alerts(rows, wait):
    out = []
    for key in {r[0] for r in rows}:
        active, recovered = False, None
        for _, ts, on in sorted((r for r in rows if r[0] == key and r[1] is not None and r[2] is not None), key=lambda r: (r[1], r[2])):
            if on and not active:
                active = True
                out.append((key, ts, "FIRE"))
            elif not on and active and (recovered is None or (ts - recovered).total_seconds() >= wait):
                active, recovered = False, ts
                out.append((key, ts, "RECOVER"))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", range(4))
def test_alert_slices_equal_a_loop(spark, seed):
    """Ties, nulls, flapping and quiet keys, slices shorter and longer than the cooldown."""
    rng, rows = random.Random(seed), []
    for key, chance, steps in (("flap", 0.5, (1, 20, 100)), ("calm", 0.05, (60, 900)), ("on", 0.95, (7, 300)), (None, 0.3, (0, 0, 50)), ("tie", 0.5, (0, 0, 299, 300, 301))):
        at = START
        for _ in range(260):
            at += dt.timedelta(seconds=rng.choice(steps))
            rows.append((key, None if rng.random() < 0.01 else at, None if rng.random() < 0.02 else rng.random() < chance))
    rng.shuffle(rows)
    states = spark.createDataFrame(rows, "key string, ts timestamp_ntz, firing boolean")
    want = slow_alerts(rows, 300)
    for slice_s in (60, 300, 1000, 3600, 10**7):
        got = quality.alert_transitions(states, slice_s=slice_s)
        assert got.columns == ["key", "ts", "event"] and rows_of(got) == want, slice_s
    one = [r for r in rows if r[0] == "flap"]
    got = quality.alert_transitions(states.filter("key = 'flap'").drop("key"), [], slice_s=500)
    assert rows_of(got) == sorted(((ts, e) for _, ts, e in slow_alerts(one, 300)), key=repr)
    assert quality.alert_transitions(states.limit(0)).isEmpty()


def test_gaps_without_sorting_ticks(spark):
    """Gaps of any length around the spans' bounds, by key and session."""
    rng = random.Random(1)
    at, rows = dt.datetime(2024, 1, 2, 2), []
    for _ in range(900):
        at += dt.timedelta(seconds=rng.choice([0, 1, 5, 299, 300, 301, 900]), microseconds=rng.choice([0, 0, 1, 999_999]))
        rows.append((rng.choice("ab"), at))
    t = spark.createDataFrame(rows, "symbol string, exchange_ts timestamp_ntz")
    for keys in (None, ["symbol"]):
        for by_session in (False, True):
            got = quality.tick_gaps(t, 300, by_session=by_session, keys=keys)
            inside = t.filter(quality._in_session("exchange_ts", quality.MARKET_TZ)).withColumn("local", F.col("exchange_ts") + F.expr("INTERVAL 7 HOURS"))
            parts = [*(keys or []), F.to_date("local"), *([F.hour("local") < 12] if by_session else [])]
            want = inside.select("exchange_ts", F.lag("exchange_ts").over(Window.partitionBy(*parts).orderBy("exchange_ts")).alias("p"))
            want = sorted((r.p, r.exchange_ts) for r in want.collect() if r.p and (r.exchange_ts - r.p).total_seconds() > 300)
            assert sorted((r.gap_start, r.gap_end) for r in got.collect()) == want and want
