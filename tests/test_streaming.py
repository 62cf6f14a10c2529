"""Streams give what their batch twins give; state survives a restart."""

import datetime as dt
import random
import shutil
import time

from pyspark.sql import functions as F

from tidemark.operators import candles, dedup, quality
from tidemark.sources import journal, rollup
from tidemark.streaming import streams

TICK = "symbol string, exchange_ts timestamp, price double, quantity int, side int, session_vol bigint, kafka_offset bigint"
START = dt.datetime(2024, 1, 2, 2, 0)


def ticks(spark, n=120, start=0):
    rows = [(f"S{i % 2}", START + dt.timedelta(seconds=20 * i), float(i % 13), i % 4 + 1, i % 3, i * 10 if i % 50 else 0, i) for i in range(start, start + n)]
    return spark.createDataFrame(rows, TICK)


def run(spark, df, name, tmp, mode="append", **options):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp / f"cp_{name}")).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.table(name).collect()


def source(spark, path, schema=TICK):
    return spark.readStream.schema(schema).parquet(str(path))


def test_candles_of_a_stream(spark, tmp_path):
    t = ticks(spark)
    t.write.parquet(str(tmp_path / "in"))
    # one far later tick moves the watermark past every bucket
    ticks(spark, 1, 100_000).write.mode("append").parquet(str(tmp_path / "in"))
    out = run(spark, streams.ohlcv_stream(source(spark, tmp_path / "in"), lookback="0 seconds"), "bars", tmp_path)
    want = candles.ohlcv(t, gateway=None).select("symbol", "bucket", "open", "high", "low", "close", "volume", "turnover", "buy_vol", "sell_vol", "tick_count").collect()
    assert sorted(out) == sorted(want)


def test_late_ticks_are_dropped(spark, tmp_path):
    ticks(spark, 60).write.parquet(str(tmp_path / "in"))
    stream = streams.ohlcv_stream(spark.readStream.schema(TICK).option("maxFilesPerTrigger", 100).parquet(str(tmp_path / "in")), lookback="1 minute")
    checkpoint = str(tmp_path / "cp")

    def once():
        q = stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
        q.awaitTermination()
        return streams.progress_metrics(q)

    once()
    ticks(spark, 1, 0).write.mode("append").parquet(str(tmp_path / "in"))
    late = once()
    assert sum(m["metric_value"] for m in late if m["metric_name"] == "late_rows") == 1


def test_index_candles_of_a_stream(spark, tmp_path):
    rows = [("X", START + dt.timedelta(seconds=5 * i), float(i % 7), i * 3, i % 4) for i in range(60)] + [("X", START + dt.timedelta(days=1), 0.0, 0, 0)]
    schema = "index_name string, exchange_ts timestamp, value double, total_volume bigint, up_count int"
    snaps = spark.createDataFrame(rows, schema)
    snaps.write.parquet(str(tmp_path / "in"))
    out = run(spark, streams.index_stream(source(spark, tmp_path / "in", schema), lookback="0 seconds", breadth=("up_count",)), "ix", tmp_path)
    want = candles.index_ohlc(snaps.filter(F.col("exchange_ts") < F.lit("2024-01-03")), turnover=None, breadth=("up_count",), gateway=None).collect()
    assert sorted(out) == sorted(want)


def test_resets_of_a_stream_across_a_restart(spark, tmp_path):
    ticks(spark, 60).write.parquet(str(tmp_path / "in"))
    stream = streams.reset_stream(source(spark, tmp_path / "in"))

    def once():
        q = stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).outputMode("append").trigger(availableNow=True).start()
        q.awaitTermination()

    once()
    ticks(spark, 60, 60).write.mode("append").parquet(str(tmp_path / "in"))
    once()
    out = spark.read.parquet(str(tmp_path / "out"))
    want = dedup.counter_resets(ticks(spark), ["symbol"], ["exchange_ts"], "session_vol")
    assert sorted((r.symbol, r.ts, r.previous, r.current) for r in out.filter("NOT late").collect()) == sorted((r.symbol, r.exchange_ts, r.previous, r.session_vol) for r in want.collect())
    ticks(spark, 1, 4).write.mode("append").parquet(str(tmp_path / "in"))
    once()
    assert spark.read.parquet(str(tmp_path / "out")).filter("late").count() == 1


def test_alerts_of_a_stream_across_a_restart(spark, tmp_path):
    checks = [(0, True), (1, True), (2, False), (3, True), (4, False), (6, False), (7, False)]
    schema = "key string, ts timestamp, firing boolean"
    rows = [("k", START + dt.timedelta(minutes=m), f) for m, f in checks]
    out = []
    for i, part in enumerate((rows[:3], rows[3:])):
        spark.createDataFrame(part, schema).write.mode("append").parquet(str(tmp_path / "in"))
        stream = streams.alert_stream(source(spark, tmp_path / "in", schema))
        q = stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).outputMode("append").trigger(availableNow=True).start()
        q.awaitTermination()
        out = spark.read.parquet(str(tmp_path / "out")).orderBy("ts").collect()
        assert i or len(out) == 2
    want = quality.alert_transitions(spark.createDataFrame(rows, schema), ["key"]).orderBy("ts").collect()
    assert [(r.ts, r.event) for r in out] == [(r.ts, r.event) for r in want]


def test_alert_fold_equals_a_loop(spark):
    import random

    rng = random.Random(5)
    rows = [(f"k{k}", START + dt.timedelta(seconds=61 * i), rng.random() < 0.4) for k in range(4) for i in range(80)]
    got = sorted(tuple(r) for r in quality.alert_transitions(spark.createDataFrame(rows, "key string, ts timestamp, firing boolean"), ["key"]).collect())
    want = []
    for k in range(4):
        active, recovered = False, None
        for key, ts, firing in sorted(r for r in rows if r[0] == f"k{k}"):
            if firing and not active:
                active = True
                want.append((key, ts, "FIRE"))
            elif not firing and active and (recovered is None or (ts - recovered).total_seconds() >= 300):
                active, recovered = False, ts
                want.append((key, ts, "RECOVER"))
    assert got == sorted(want)


def test_high_water_mark(spark, tmp_path):
    schema = "check_name string, ts timestamp"
    path = tmp_path / "in"
    found = []
    for minutes in ((1, 2), (2, 1), (3,)):
        spark.createDataFrame([("c", START + dt.timedelta(minutes=m)) for m in minutes], schema).write.mode("append").parquet(str(path))
        q = streams.mark_stream(source(spark, path, schema)).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).outputMode("append").trigger(availableNow=True).start()
        q.awaitTermination()
        found.append(sorted((r.ts.minute, r.n_new) for r in spark.read.parquet(str(tmp_path / "out")).collect()))
    assert found == [[(2, 2)], [(2, 2)], [(2, 2), (3, 1)]]


def test_dedup_and_anomalies_of_a_stream(spark, tmp_path):
    t = ticks(spark, 30)
    t.unionByName(t).coalesce(1).write.parquet(str(tmp_path / "in"))
    assert len(run(spark, streams.dedup_stream(source(spark, tmp_path / "in"), ["symbol", "kafka_offset"]), "dd", tmp_path)) == 30
    bands = spark.createDataFrame([("S0", 8.0, 2.0)], "symbol string, ceiling_price double, floor_price double")
    got = run(spark, streams.anomaly_stream(source(spark, tmp_path / "in"), bands, ["symbol"]), "an", tmp_path)
    assert len(got) == quality.price_band_anomalies(t.unionByName(t), bands, ["symbol"]).count() > 0


def test_route_and_sinks_of_a_stream(spark, tmp_path):
    t = ticks(spark, 40).withColumn("board_id", F.when(F.col("kafka_offset") % 4 == 0, "G3").otherwise("G1"))
    t.write.parquet(str(tmp_path / "in"))
    stream = source(spark, tmp_path / "in", TICK + ", board_id string")
    stamp = F.date_format("exchange_ts", "yyyy-MM-dd")
    for _ in range(2):  # the second run finds nothing new and must not double anything
        streams.route(stream, lambda df: df, ["G1"], str(tmp_path / "bronze"), str(tmp_path / "serving"), str(tmp_path / "cp"), stamp, application="route").awaitTermination()
    assert spark.read.parquet(str(tmp_path / "bronze")).count() == 40 and spark.read.parquet(str(tmp_path / "serving")).count() == 30
    shutil.rmtree(tmp_path / "cp")  # a lost checkpoint replays batch 0, which the ledger has
    streams.to_bronze(stream.withColumn("date", stamp), str(tmp_path / "bronze"), str(tmp_path / "cp"), application="route").awaitTermination()
    assert spark.read.parquet(str(tmp_path / "bronze")).count() == 40
    streams.to_serving(stream, str(tmp_path / "table"), str(tmp_path / "cp2"), ["symbol", "price"]).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "table")).columns == ["symbol", "price"]
    wanted = spark.createDataFrame([("S1",)], "symbol string")
    streams.with_universe(stream, lambda s: wanted, lambda batch, n: journal.append_batch(batch.withColumn("date", stamp), str(tmp_path / "uni"), ["date"], "uni", n), str(tmp_path / "cp3")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "uni")).select("symbol").distinct().collect() == wanted.collect()


def states(query):
    return [sum(s.numRowsTotal for s in p.stateOperators) for p in query.recentProgress if p.stateOperators]


def fed(spark, tmp_path, name, make, batches, schema):
    """A stream over batches that come one after another; its rows and the state after each."""
    place, seen = tmp_path / name, []
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(place / "in"))
        q = make(source(spark, place / "in", schema)).writeStream.format("parquet").option("path", str(place / "out")).option("checkpointLocation", str(place / "cp")).outputMode("append").trigger(availableNow=True).start()
        q.awaitTermination()
        seen.append(states(q)[-1])
    return spark.read.parquet(str(place / "out")).collect(), seen


def test_state_of_resets_ends_with_the_day(spark, tmp_path):
    day = lambda d, n: [(f"S{k}", START + dt.timedelta(days=d, minutes=k), k, 5) for k in range(n)]
    schema = "symbol string, exchange_ts timestamp, kafka_offset bigint, session_vol bigint"
    _, seen = fed(spark, tmp_path, "resets", lambda s: streams.reset_stream(s, lookback="1 hour"), [day(0, 40), day(1, 30), day(2, 20), day(3, 1), day(4, 1)], schema)
    assert seen[0] == 40 and max(seen) <= 70 and seen[-1] <= 2


def test_state_of_alerts_and_marks_ends(spark, tmp_path):
    at = lambda m, n, on: [(f"k{k}", START + dt.timedelta(minutes=m, seconds=k), on) for k in range(n)]
    batches = [at(0, 30, True), at(1, 25, False), at(200, 1, True), at(400, 1, False), at(600, 1, True)]
    got, seen = fed(spark, tmp_path, "alerts", lambda s: streams.alert_stream(s, lookback="10 minutes"), batches, "key string, ts timestamp, firing boolean")
    want = quality.alert_transitions(spark.createDataFrame([r for b in batches for r in b], "key string, ts timestamp, firing boolean")).collect()
    assert sorted((r.key, r.ts, r.event) for r in got) == sorted((r.key, r.ts, r.event) for r in want)
    assert seen[0] == 30 and seen[1] == 30 and seen[-1] <= 6  # five keys are still active
    found = [[(f"c{k}", START + dt.timedelta(hours=h, minutes=k)) for k in range(n)] for h, n in ((0, 12), (5, 1), (10, 1))]
    marks, seen = fed(spark, tmp_path, "marks", lambda s: streams.mark_stream(s, "10 minutes"), found, "check_name string, ts timestamp")
    assert seen[0] >= 10 and seen[-1] <= 2 and len(marks) == 14


def test_alerts_of_a_stream_with_ties_and_nulls(spark, tmp_path):
    rng = random.Random(4)
    rows = [("k", None if rng.random() < 0.05 else START + dt.timedelta(seconds=100 * rng.randrange(60)), None if rng.random() < 0.1 else rng.random() < 0.5) for _ in range(200)]
    schema = "key string, ts timestamp, firing boolean"
    got, _ = fed(spark, tmp_path, "ties", streams.alert_stream, [rows], schema)
    want = quality.alert_transitions(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r.ts, r.event) for r in got) == sorted((r.ts, r.event) for r in want) and len(want) > 10


def test_stored_candles_follow_late_ticks_of_a_stream(spark, tmp_path):
    late = ticks(spark, 20).withColumn("price", F.col("price") + 3)
    places = [str(tmp_path / n) for n in ("table", "store", "cp")]
    for part in (ticks(spark, 60, 60), ticks(spark, 60), late):
        part.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        streams.maintained_candles(source(spark, tmp_path / "in"), *places, candle=lambda t: candles.ohlcv(t, gateway=None)).awaitTermination()
    everything = spark.read.schema(TICK).parquet(str(tmp_path / "in"))
    assert everything.count() == 140
    own = rollup.bars(spark, places[1]).drop("touches", "turnover")
    assert sorted(own.collect()) == sorted(candles.ohlcv(everything.withColumn("exchange_ts", F.col("exchange_ts").cast("timestamp")), gateway=None).select(*own.columns).collect())
    assert [n for n in journal.Store(spark, places[0]).names() if not n.startswith("_")] == ["date=2024-01-02"]


def test_metrics_come_with_the_batches(spark, tmp_path):
    ticks(spark, 50).coalesce(1).write.parquet(str(tmp_path / "in"))
    listener = streams.MetricsListener(spark, str(tmp_path / "metrics"))
    spark.streams.addListener(listener)
    try:
        rows = streams.observed(source(spark, tmp_path / "in"), "trades", n=F.count("*"), skipped=F.count_if(F.col("kafka_offset") % 4 == 0))
        q = rows.filter("kafka_offset % 4 <> 0").writeStream.queryName("m").format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        q.awaitTermination()
        for _ in range(60):
            if (tmp_path / "metrics" / "_SUCCESS").exists():
                break
            time.sleep(0.5)
    finally:
        spark.streams.removeListener(listener)
    assert not listener.problems
    got = {r.metric_name: r.metric_value for r in spark.read.parquet(str(tmp_path / "metrics")).filter("service_name = 'm' AND label = '0'").collect()}
    assert got["trades.n"] == 50 and got["trades.skipped"] == 13 and got["input_rows"] == 50 and "batch_ms" in got
    assert spark.read.parquet(str(tmp_path / "out")).count() == 37
