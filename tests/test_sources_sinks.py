"""Readers and writers on files."""

import json

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import normalize as N
from tidemark.sources import readers, sinks


def candles(spark, *rows):
    return spark.createDataFrame([(s, r, 1.0, 1.0, 1.0, c, 1, None, d) for s, r, c, d in rows], schemas.CANDLE)


def test_bronze_scan_prunes_and_tolerates_a_missing_table(spark, tmp_path):
    path = str(tmp_path / "bronze")
    assert readers.read_bronze(spark, path, ["2024-01-02"], "1min").count() == 0
    sinks.append_partitioned(candles(spark, ("A", "1min", 1.0, "2024-01-02"), ("B", "1min", 1.0, "2024-01-03"), ("A", "1D", 1.0, "2024-01-02")), path, ["date", "resolution"])
    one = readers.read_bronze(spark, path, ["2024-01-02"], "1min", spark.createDataFrame([("A",)], "symbol string"))
    assert [r.symbol for r in one.collect()] == ["A"]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan or "PartitionFilters: [(date" in plan or "date" in plan.split("PartitionFilters")[1][:200]


def test_replace_where_keeps_the_rest(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = candles(spark, ("A", "1min", 1.0, "2024-01-02"), ("B", "1min", 2.0, "2024-01-02"), ("A", "1min", 3.0, "2024-01-03"), ("C", "1min", 4.0, "2024-01-04"))
    sinks.append_partitioned(rows, path, ["date"])
    new = candles(spark, ("A", "1min", 9.0, "2024-01-02"))
    for _ in range(2):
        sinks.replace_where(new, path, (F.col("symbol").isin("A", "C")) & (F.col("date") != "2024-01-03"), ["date"])
        got = sorted((r.symbol, r.close, str(r.date)) for r in spark.read.parquet(path).collect())
        assert got == [("A", 3.0, "2024-01-03"), ("A", 9.0, "2024-01-02"), ("B", 2.0, "2024-01-02")]
    assert not [p for p in tmp_path.iterdir() if "staging" in p.name]


def test_insert_absent_snapshot_and_replace(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = candles(spark, ("A", "1min", 1.0, "2024-01-02"))
    for _ in range(2):
        sinks.insert_absent(rows, path, ["symbol", "resolution"], ["date"])
    assert spark.read.parquet(path).count() == 1
    day = str(tmp_path / "days")
    for close in (1.0, 2.0):
        sinks.daily_snapshot(candles(spark, ("A", "1D", close, None)).drop("date"), day, "2024-01-05")
    assert [r.close for r in spark.read.parquet(day).collect()] == [2.0]
    calendar = spark.createDataFrame([("2024-01-02",)], "d string")
    sinks.replace_table(calendar, str(tmp_path / "cal"))
    with pytest.raises(ValueError, match="empty"):
        sinks.replace_table(calendar.limit(0), str(tmp_path / "cal"))
    sinks.replace_table(spark.read.parquet(str(tmp_path / "cal")), str(tmp_path / "cal"))
    assert spark.read.parquet(str(tmp_path / "cal")).count() == 1


def test_compaction_and_retention(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(200).select(F.concat(F.lit("S"), F.col("id") % 7).alias("symbol"), F.timestamp_seconds("id").alias("exchange_ts"), F.when(F.col("id") % 2 == 0, "2024-01-02").otherwise("2024-01-03").alias("date"))
    sinks.append_partitioned(rows.repartition(20), path, ["date"])
    sinks.compact(spark, path, "2024-01-02", files=2)
    assert spark.read.parquet(path).count() == 200
    assert len(list((tmp_path / "t" / "date=2024-01-02").glob("*.parquet"))) <= 2
    assert sinks.drop_old_partitions(spark, path, "2024-01-03") == 1 and spark.read.parquet(path).count() == 100


def test_ledger(spark):
    ranges = spark.createDataFrame([("A", "trade"), ("B", "trade")], "symbol string, data_type string").withColumns({"range_start": F.lit("2024-01-01").cast("timestamp"), "range_end": F.lit("2024-01-05").cast("timestamp")})
    entries = ranges.withColumns({"page": F.lit(2), "next_token": F.lit("t2"), "done": F.col("symbol") == "A"})
    ledger = sinks.empty_ledger(spark).unionByName(entries).unionByName(entries.withColumns({"page": F.lit(1), "next_token": F.lit("t1"), "done": F.lit(False)}))
    assert [(r.symbol, r.resume_token) for r in sinks.pending(ranges, ledger).collect()] == [("B", "t2")]
    asked = ranges.filter("symbol = 'A'").withColumns({"range_start": F.lit("2024-01-05").cast("timestamp"), "range_end": F.lit("2024-01-09").cast("timestamp")})
    assert [r.symbol for r in sinks.clear_overlapping(ledger, asked).distinct().select("symbol").distinct().collect()] == ["B"]


def test_landed_json(spark, tmp_path):
    page = {"trades": [{"symbol": "A", "time": "2024-01-02 09:00:00.123", "matchPrice": 1.5, "matchQtty": 3, "side": "SELL"}, {"symbol": "A", "time": "bad"}], "nextPageToken": "x"}
    (tmp_path / "trades.json").write_text(json.dumps(page))
    raw = readers.landed_pages(spark, str(tmp_path / "trades.json"), readers.TRADE_ITEM, ("trades", "data"))
    r = N.normalize_rest_trades(raw).collect()
    assert len(r) == 1 and (r[0].side, r[0].date, r[0].is_backfill, r[0].exchange_ts.microsecond) == (2, "2024-01-02", True, 123000)
    quotes = {"quotes": [{"symbol": "A", "time": "2024-01-02 09:00:00", "bid": [{"price": 1.0, "quantity": 2}], "offer": [{"price": 1.2, "quantity": 2}]}]}
    (tmp_path / "quotes.json").write_text(json.dumps(quotes))
    q = N.normalize_rest_quotes(readers.landed_pages(spark, str(tmp_path / "quotes.json"), readers.QUOTE_ITEM, ("quotes",))).first()
    assert q.bid_price1 == 1.0 and q.bid_price2 is None and round(q.spread, 4) == 0.2
    for i, days in enumerate((["2024-01-02", "2024-01-03"], {"data": [{"date": "2024-01-02T00:00:00"}, {"tradingDate": "2024-01-03"}]}, [{"workingDate": "2024-01-02"}, "2024-01-03"])):
        (tmp_path / f"days{i}.json").write_text(json.dumps(days))
        assert readers.landed_days(spark, str(tmp_path / f"days{i}.json")).count() == 2, days


def test_archive_of_a_day(spark, tmp_path):
    raw = spark.createDataFrame([("A", "1704160800123"), ("B", "oops")], "symbol string, exchange_ts string")
    sinks.archive_day(raw, str(tmp_path / "b"), ["exchange_ts"], "exchange_ts", "Asia/Ho_Chi_Minh")
    got = {r.symbol: r.exchange_ts for r in spark.read.parquet(str(tmp_path / "b")).collect()}
    assert got["B"] is None and got["A"].microsecond == 123000


def test_archive_of_a_day_again(spark, tmp_path):
    records = lambda *ids: spark.createDataFrame([(0, i, "1704160800123") for i in ids], "partition int, offset int, exchange_ts string")
    for ids in ((1, 2, 2), (1, 2, 3)):
        sinks.archive_day(records(*ids), str(tmp_path / "b"), ["exchange_ts"], "exchange_ts", "Asia/Ho_Chi_Minh", keys=["partition", "offset"])
    assert sorted(r.offset for r in spark.read.parquet(str(tmp_path / "b")).collect()) == [1, 2, 3]


def test_decoded_messages(spark):
    m = spark.createDataFrame([(b'{"symbol": "A", "price": 2.5}', 3, 7)], "value binary, partition int, offset bigint")
    r = readers.decode(m, schemas.TRADE).first()
    assert (r.symbol, r.price, r.kafka_partition, r.kafka_offset) == ("A", 2.5, 3, 7)
