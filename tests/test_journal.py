"""Swaps, numbered batches, refreshed candles, clustering, framed Avro and databases."""

import datetime as dt
import json
import random
import struct
import uuid

import pytest
from pyspark.sql import functions as F

from tidemark.operators import candles
from tidemark.sources import avro, journal, readers, rollup, sinks


class Killed(Exception):
    pass


def killer(after: int):
    """Raises when so many moves are done."""
    left = [after]

    def moved(_):
        left[0] -= 1
        if left[0] < 0:
            raise Killed

    return moved


def content(spark, path):
    return sorted(tuple(r) for r in spark.read.parquet(path).select("k", "v", F.col("date").cast("string"), F.col("name").cast("string")).collect())


def table(spark, path, v, keys=range(40)):
    rows = [(k, v, f"2024-01-{k % 4 + 1:02d}", ["a b", "c/d", "é=%"][k % 3]) for k in keys]
    df = spark.createDataFrame(rows, "k int, v int, date string, name string")
    if path:
        df.write.partitionBy("date", "name").parquet(path)
    return df


@pytest.mark.parametrize("after", range(0, 16, 2))
def test_a_killed_replacement_leaves_old_or_new(spark, tmp_path, after):
    path = f"{tmp_path}/t"
    table(spark, path, 1)
    old = content(spark, path)
    gone = (F.col("date") >= "2024-01-03") & (F.col("k") >= 10)
    new = table(spark, None, 2, range(12, 40)).filter("date = '2024-01-04' OR k = 39")
    kept = [r for r in old if not (r[2] >= "2024-01-03" and r[0] >= 10)]
    want = sorted(kept + [tuple(r) for r in new.collect()])
    ended = True
    try:
        sinks.replace_where(new, path, gone, ["date", "name"], killer(after))
    except Killed:
        ended = False
        assert journal.recover(spark, path) == 1
    assert content(spark, path) == want
    assert journal.recover(spark, path) == 0
    assert not any(n.startswith("_") and n != "_SUCCESS" and journal.Store(spark, path).names(n) for n in journal.Store(spark, path).names())
    assert ended or after < 20


def test_nothing_is_changed_before_the_commit(spark, tmp_path):
    path = f"{tmp_path}/t"
    table(spark, path, 1)
    old = content(spark, path)
    store = journal.Store(spark, path)
    journal.stage(table(spark, None, 2), store, ["date", "name"])
    assert content(spark, path) == old and journal.recover(spark, path) == 0


def test_readers_finish_what_a_dead_writer_left(spark, tmp_path):
    path = f"{tmp_path}/t"
    table(spark, path, 1)
    with pytest.raises(Killed):
        journal.swap_partitions(table(spark, None, 2, range(20)), path, ["date", "name"], moved=killer(3))
    journal.settle(spark, path, 0.3)
    assert {r[1] for r in content(spark, path)} == {2}


@pytest.mark.parametrize("after", range(0, 8))
def test_a_killed_whole_replacement_leaves_old_or_new(spark, tmp_path, after):
    path = f"{tmp_path}/t"
    frame_ = lambda v, n: spark.range(n).select("id", F.lit(v).alias("v")).repartition(2)
    sinks.replace_table(frame_(1, 10), path)
    try:
        sinks.replace_table(frame_(2, 20), path, killer(after))
    except Killed:
        assert journal.recover(spark, path) == 1
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == [(i, 2) for i in range(20)]
    with pytest.raises(ValueError):
        sinks.replace_table(frame_(3, 0), path)
    assert spark.read.parquet(path).count() == 20


def test_merge_updates_moves_and_adds(spark, tmp_path):
    path, schema = f"{tmp_path}/t", "k int, v int, w string, date string"
    rows = [(k, 1, f"w{k}", f"2024-01-0{k % 3 + 1}") for k in range(9)]
    sinks.merge(spark.createDataFrame(rows, schema), path, ["k"], ["date"])
    untouched = sorted(f for f in spark.read.parquet(path).inputFiles() if "date=2024-01-02" in f)
    # one changes, one moves to another date and empties nothing, one is new
    new = [(0, 2, None, "2024-01-01"), (3, 2, "x", "2024-01-03"), (20, 2, "n", "2024-01-05")]
    sinks.merge(spark.createDataFrame(new, schema), path, ["k"], ["date"])
    want = {r[0]: r for r in rows} | {r[0]: r for r in new}
    read = lambda: {r.k: (r.k, r.v, r.w, str(r.date)) for r in spark.read.parquet(path).collect()}
    assert read() == want and spark.read.parquet(path).count() == 10
    assert sorted(f for f in spark.read.parquet(path).inputFiles() if "date=2024-01-02" in f) == untouched
    # single columns, nulls keep what is stored; a date that loses its only row goes
    sinks.merge(spark.createDataFrame([(20, None, "m", "2024-01-05"), (21, 3, "o", "2024-01-01")], schema), path, ["k"], ["date"], ["v", "w"])
    assert read()[20] == (20, 2, "m", "2024-01-05") and read()[21] == (21, 3, "o", "2024-01-01")
    sinks.merge(spark.createDataFrame([(20, 4, "p", "2024-01-01")], schema), path, ["k"], ["date"])
    assert read()[20] == (20, 4, "p", "2024-01-01") and not journal.Store(spark, path).exists("date=2024-01-05")


def test_batches_are_added_once(spark, tmp_path):
    path = f"{tmp_path}/t"
    for after in (0, 1, 2):  # a commit that dies, at its start or between files, and is run again
        batch = table(spark, None, after, range(10 * after, 10 * after + 10))
        with pytest.raises(Killed):
            journal.append_batch(batch, path, ["date", "name"], "app", after, killer(after))
        journal.append_batch(batch, path, ["date", "name"], "app", after)
        assert not journal.append_batch(batch, path, ["date", "name"], "app", after)
    assert journal.append_batch(table(spark, None, 9, range(30, 40)), path, ["date", "name"], "other", 0)
    assert [r[0] for r in content(spark, path)] == list(range(40))
    store = journal.Store(spark, path)
    assert [n for n in store.names() if not n.startswith("_")] == [f"date=2024-01-0{d}" for d in range(1, 5)]  # no folder for a batch
    assert store.names(journal.LEDGER + "/app") == ["2"]
    assert journal.append_batch(table(spark, None, 0, []), path, ["date", "name"], "app", 3)


def test_insert_absent_within_the_incoming_times(spark, tmp_path):
    path = f"{tmp_path}/t"
    rows = lambda days, v: spark.createDataFrame([(f"s{k}", dt.datetime(2024, 1, d), v, f"2024-01-{d:02d}") for d in days for k in range(3)], "symbol string, time timestamp_ntz, v int, date string")
    sinks.append_partitioned(rows(range(1, 20), 1), path, ["date"])
    sinks.insert_absent(rows(range(15, 25), 2), path, ["symbol", "time"], ["date"], ts="time")
    sinks.insert_absent(rows([], 3), path, ["symbol", "time"], ["date"], ts="time")
    found = spark.read.parquet(path)
    assert found.count() == 72 and found.filter("v = 2").agg(F.min("time")).first()[0] == dt.datetime(2024, 1, 20)


def test_clustering_by_two_columns_skips_files(spark, tmp_path):
    path, rng = f"{tmp_path}/t", random.Random(2)
    rows = [(f"s{rng.randrange(50):02d}", rng.random() * 100, dt.datetime(2024, 1, 2) + dt.timedelta(seconds=i), "2024-01-02") for i in range(20_000)]
    spark.createDataFrame(rows, "symbol string, price double, exchange_ts timestamp_ntz, date string").repartition(8).write.partitionBy("date").parquet(path)
    before = sorted(spark.read.parquet(path).collect())
    size = sinks.folder_bytes(spark, path)
    files = sinks.compact(spark, path, "2024-01-02", ["symbol", "price"], file_bytes=size // 24)
    assert 20 <= files <= 30
    now = spark.read.parquet(path)
    assert sorted(now.collect()) == before
    ranges = now.groupBy("_metadata.file_path").agg(*(f(c).alias(f"{n}_{c}") for c in ("symbol", "price") for n, f in (("lo", F.min), ("hi", F.max)))).collect()
    assert len(ranges) >= 16
    # files whose ranges a filter on either column can't exclude
    assert sum(r.lo_symbol <= "s07" <= r.hi_symbol for r in ranges) <= len(ranges) // 2
    assert sum(r.lo_price <= 42 and r.hi_price >= 41 for r in ranges) <= len(ranges) // 2
    assert sinks.compact(spark, path, "2024-01-02") == 1 and sorted(spark.read.parquet(path).collect()) == before


# --- refreshed candles


def ticks(spark, n, first=0, minutes=30):
    rng = random.Random(first)
    rows = [(f"S{k % 3}", 10.0 + rng.random(), k % 7 + 1, k % 2 + 1, dt.datetime(2024, 1, 2, 3) + dt.timedelta(seconds=rng.randrange(minutes * 60), microseconds=k), None, "2024-01-02") for k in range(first, first + n)]
    return spark.createDataFrame(rows, "symbol string, price double, quantity int, side int, exchange_ts timestamp_ntz, gateway_ts timestamp_ntz, date string")


def same(spark, store, all_ticks):
    own, want = (df.withColumn("turnover", F.round("turnover", 6)) for df in (rollup.bars(spark, store).drop("touches"), candles.ohlcv(all_ticks)))
    assert sorted(own.collect()) == sorted(want.select(*own.columns).collect())


def test_late_ticks_refresh_only_their_candles(spark, tmp_path):
    table_, store = f"{tmp_path}/ticks", f"{tmp_path}/store"
    assert rollup.refresh(spark, ticks(spark, 1), store, candles.ohlcv) == 0 and rollup.bars(spark, store) is None
    first, late = ticks(spark, 300), ticks(spark, 5, 1000)
    for number, batch in enumerate((first, late)):
        journal.append_batch(batch, table_, ["date"], "t", number)
        assert rollup.log_touched(batch, store, number) and not rollup.log_touched(batch, store, number)
        n = rollup.refresh(spark, spark.read.parquet(table_), store, candles.ohlcv)
        assert n == candles.ohlcv(batch).count()
    same(spark, store, first.unionByName(late))
    assert rollup.refresh(spark, spark.read.parquet(table_), store, candles.ohlcv) == 0
    # a refresh that dies after its rows are written, and runs again, changes nothing
    rollup.compact_day(spark, store, "2024-01-02")
    same(spark, store, first.unionByName(late))
    assert rollup.stale(spark, store).isEmpty()


def test_refresh_within_a_lookback(spark, tmp_path):
    """Older buckets stay stale until a refresh reaches them; those too new wait."""
    table_, store = f"{tmp_path}/ticks", f"{tmp_path}/store"
    t = ticks(spark, 400)
    journal.append_batch(t, table_, ["date"], "t", 0)
    rollup.log_touched(t, store, 0)
    as_of = F.lit("2024-01-02 03:20:00").cast("timestamp_ntz")
    stored = spark.read.parquet(table_)
    rollup.refresh(spark, stored, store, candles.ohlcv, as_of=as_of, lookback="10 minutes", lag="1 minute")
    got = rollup.bars(spark, store).agg(F.min("bucket"), F.max("bucket")).first()
    assert tuple(got) == (dt.datetime(2024, 1, 2, 3, 10), dt.datetime(2024, 1, 2, 3, 18))
    assert rollup.stale(spark, store).filter("bucket < timestamp_ntz '2024-01-02 03:10:00'").count() > 0
    rollup.refresh(spark, stored, store, candles.ohlcv)
    same(spark, store, t)


def test_refresh_reads_only_stale_buckets(spark, tmp_path):
    """The bounds of what is stale reach the scan of ticks."""
    store = f"{tmp_path}/store"
    t = ticks(spark, 200)
    t.write.parquet(f"{tmp_path}/ticks")
    rollup.log_touched(t.filter("exchange_ts < timestamp_ntz '2024-01-02 03:05:00'"), store, 0)
    seen = []

    def candle(rows):
        seen.append(rows._jdf.queryExecution().executedPlan().toString())
        return candles.ohlcv(rows)

    rollup.refresh(spark, spark.read.parquet(f"{tmp_path}/ticks"), store, candle)
    assert "GreaterThanOrEqual(exchange_ts" in seen[0] and "LessThan(exchange_ts" in seen[0]


def test_other_candles_are_kept_up_to_date(spark, tmp_path):
    """Any function of ticks: index candles of five minutes."""
    snaps = ticks(spark, 200).selectExpr("symbol AS index_name", "price AS value", "CAST(quantity AS bigint) AS total_volume", "quantity AS up_count", "exchange_ts", "date")
    make = lambda rows: candles.index_ohlc(rows, "5 minutes", turnover=None, breadth=("up_count",), gateway=None)
    store, half = f"{tmp_path}/store", snaps.filter("up_count % 2 = 0")
    for number, (batch, there) in enumerate(((half, half), (snaps.filter("up_count % 2 = 1"), snaps))):
        rollup.log_touched(batch, store, number, width="5 minutes", keys=("index_name",))
        rollup.refresh(spark, there, store, make, "5 minutes", keys=("index_name",))
    own = rollup.bars(spark, store, ("index_name",)).drop("touches")
    assert sorted(own.collect()) == sorted(make(snaps).select(*own.columns).collect())


# --- Avro

OLD = json.dumps({"type": "record", "name": "R", "fields": [{"name": "a", "type": "int"}, {"name": "b", "type": ["null", "string"]}, {"name": "gone", "type": {"type": "array", "items": "double"}}, {"name": "when", "type": {"type": "long", "logicalType": "timestamp-millis"}}]})
NEW = json.dumps({"type": "record", "name": "R", "fields": [
    {"name": "a", "type": "double"}, {"name": "c", "aliases": ["b"], "type": ["string", "null"]}, {"name": "when", "type": {"type": "long", "logicalType": "timestamp-millis"}},
    {"name": "levels", "type": {"type": "array", "items": {"type": "record", "name": "L", "fields": [{"name": "p", "type": "double"}, {"name": "q", "type": ["null", "int"]}]}}, "default": []},
    {"name": "m", "type": {"type": "map", "values": "long"}, "default": {}}, {"name": "e", "type": {"type": "enum", "name": "E", "symbols": ["X", "Y"]}, "default": "X"}, {"name": "f", "type": ["null", "boolean"], "default": None}, {"name": "d", "type": {"type": "int", "logicalType": "date"}, "default": 0},
]})


def frame(number: int, raw: bytes) -> bytes:
    return b"\0" + struct.pack(">I", number) + raw


def test_two_schema_versions_are_one_table(spark):
    when = dt.datetime(2024, 1, 2, 3, 4, 5, 678000, dt.timezone.utc)
    old = [avro.write(avro.parse(OLD), {"a": a, "b": b, "gone": [1.0] * (a % 3), "when": when}) for a, b in ((1, "é"), (-70000, None), (2**31 - 1, ""))]
    new = [avro.write(avro.parse(NEW), {"a": 0.5, "c": "z", "when": when, "levels": [{"p": 1.5, "q": None}, {"p": -2.0, "q": -300}], "m": {"k": -(2**40)}, "e": "Y", "f": True, "d": dt.date(2024, 2, 3)})]
    whole = new[0]
    values = [*(frame(7, x) for x in old), frame(300, whole), None, b"", b"{}json", frame(9, whole), frame(7, old[0][:-1]), frame(300, whole + b"\1"), frame(7, b"\x02\x06")]
    messages = spark.createDataFrame([(0, i, v) for i, v in enumerate(values)], "partition int, offset bigint, value binary")
    rows = readers.decode_topic(messages, "trade", {7: OLD, 300: NEW}, NEW).orderBy("kafka_offset").collect()
    naive = when.replace(tzinfo=None)
    assert [(r.a, r.c, r.when, r.m if r.levels else None, r.e, r.problem) for r in rows[:4]] == [(1.0, "é", naive, None, "X", None), (-70000.0, None, naive, None, "X", None), (2**31 - 1.0, "", naive, None, "X", None), (0.5, "z", naive, {"k": -(2**40)}, "Y", None)]
    assert [(x.p, x.q) for x in rows[3].levels] == [(1.5, None), (-2.0, -300)] and rows[3].f is True and rows[3].d == dt.date(2024, 2, 3) and rows[0].levels == []
    assert [r.problem for r in rows[4:8]] == ["no frame", "no frame", "no frame", "no schema 9"]
    assert all(r.problem and r.a is None for r in rows[4:]) and len(rows) == len(values)


def test_avro_round_trip_of_a_feed(spark):
    rows = ticks(spark, 50).select("symbol", "price", "quantity", F.col("exchange_ts").cast("timestamp").alias("exchange_ts"), F.when(F.col("side") == 1, "G1").alias("board"))
    schema = json.dumps({"type": "record", "name": "T", "fields": [{"name": "symbol", "type": "string"}, {"name": "price", "type": "double"}, {"name": "quantity", "type": "long"}, {"name": "board", "type": ["null", "string"]}, {"name": "exchange_ts", "type": {"type": "long", "logicalType": "timestamp-micros"}}]})
    back = avro.decode(avro.encode(rows, schema, 5), {5: schema}, schema, keep=())
    assert sorted(back.select(*rows.columns).collect(), key=str) == sorted(rows.select("symbol", "price", F.col("quantity").cast("bigint"), "exchange_ts", "board").collect(), key=str)
    assert back.filter("problem IS NOT NULL").isEmpty()


def test_schemas_that_do_not_fit(spark):
    no_default = json.dumps({"type": "record", "name": "R", "fields": [{"name": "z", "type": "int"}]})
    messages = spark.createDataFrame([(0, 0, frame(1, b"\x02"))], "partition int, offset bigint, value binary")
    got = avro.decode(messages, {1: json.dumps({"type": "record", "name": "R", "fields": [{"name": "y", "type": "int"}]})}, no_default).collect()
    assert got[0].z is None and "no z" in got[0].problem
    with pytest.raises(ValueError, match="unions"):
        avro.spark_type(["null", "int", "string"])
    assert avro.resolver(["null", "int"], ["null", "double"])(b"\x02\x06", 0) == (3.0, 2)


# --- databases


def test_a_database_is_read_between_its_own_bounds(spark):
    url, properties = f"jdbc:derby:memory:{uuid.uuid4().hex};create=true", {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    rows = spark.range(500).select((F.col("id") * 3).alias("n"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 3).cast("int")).alias("trading_date"), F.col("id").cast("string").alias("s"))
    rows = rows.unionByName(spark.createDataFrame([(None, dt.date(2024, 1, 1), "none")], "n bigint, trading_date date, s string"))
    readers.write_jdbc(rows, url, "t", properties, "overwrite", 2)
    got = readers.read_jdbc(spark, url, "t", properties, key="n", partitions=5)
    assert got.rdd.getNumPartitions() == 5 and got.count() == 501
    sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 5 and max(sizes) <= 105
    day = readers.read_jdbc(spark, url, "t", properties, "2024-01-02", "trading_date", partitions=3)
    assert day.count() == 167 and readers.read_jdbc(spark, url, "t", properties).count() == 501
    readers.write_jdbc(rows.limit(0), url, "empty", properties, "overwrite")
    assert readers.read_jdbc(spark, url, "empty", properties, key="n").count() == 0
