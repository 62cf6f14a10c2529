"""Queries that write tables or run streams over the test tables and read back what was stored, each with its SQL.

Tables go to the shared folder (``sinks.new_place``). Streams read the events' files as
they would land and stop when these are used up. Their watermarks and states follow the
order in which files come; the SQL holds for a table in one file.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import normalize as N
from ..functions.time import MARKET_TZ, partition_stamp
from ..operators import candles, ops_metrics
from ..schemas import CANDLE
from ..sources import avro, journal, readers, rollup, sinks
from ..streaming import streams
from . import market
from . import views as V
from .registry import FOUND, query

_DATE = "strftime(exchange_ts + INTERVAL 7 HOUR, '%Y-%m-%d')"


def _dated(rows: DataFrame) -> DataFrame:
    return rows.withColumn("date", partition_stamp("exchange_ts", MARKET_TZ))


def _ntz(rows: DataFrame, *names: str) -> DataFrame:
    return rows.withColumns({n: F.col(n).cast("timestamp_ntz") for n in names})


def _trades(rows: DataFrame) -> DataFrame:
    """Ticks as trades of the feed: the event's number is the offset."""
    return _dated(rows).select("symbol", "board_id", "price", "quantity", "side", F.col("exchange_ts").cast("timestamp").alias("exchange_ts"), F.col("event_id").alias("kafka_offset"), "date")


# Scans and sinks


@query(V.with_views(("ticks",), f"SELECT event_id AS kafka_offset, symbol, price, quantity, CASE WHEN side = 1 THEN board_id END AS board_id, exchange_ts, {_DATE} AS date FROM ticks"))
def scan_trades(spark, sf_dir):
    """Trades appended by day, those of one side before the table had boards."""
    path, t = sinks.new_place(spark, "trades"), _trades(V.ticks(spark, sf_dir))
    sinks.append_partitioned(t.filter("side = 2").drop("board_id"), path, ["date"])
    sinks.append_partitioned(t.filter("side = 1"), path, ["date"])
    return _ntz(readers.read_table(spark, path, "trade").select("kafka_offset", "symbol", "price", "quantity", "board_id", "exchange_ts", "date"), "exchange_ts")


@query(V.with_views(("quotes",), "SELECT event_id AS kafka_offset, bid_price1, ask_price1, len(bid_levels) AS n_levels, bid_levels[1].price AS first_price, bid_levels[1].qtty AS first_qtty FROM quotes"))
def scan_quotes(spark, sf_dir):
    """Quotes with their depth."""
    path = sinks.new_place(spark, "quotes")
    sinks.append_partitioned(_dated(V.quotes(spark, sf_dir)).withColumnRenamed("event_id", "kafka_offset"), path, ["date"])
    rows = readers.read_table(spark, path, "quote")
    return rows.select("kafka_offset", "bid_price1", "ask_price1", F.size("bid_levels").cast("bigint").alias("n_levels"), F.get("bid_levels", F.lit(0))["price"].alias("first_price"), F.get("bid_levels", F.lit(0))["qtty"].alias("first_qtty"))


#: Other feeds: the columns each takes from the ticks, as Spark and as DuckDB name them.
_FEEDS = {
    "index": {"index_name": "symbol", "value": "price", "up_count": "k", "total_volume": "CAST(quantity AS BIGINT)"},
    "foreign": {"symbol": "symbol", "board_id": "board_id", "buy_volume": "CAST(quantity AS BIGINT)", "total_buy_volume": "event_id"},
    "expected_price": {"symbol": "symbol", "board_id": "board_id", "expected_price": "price", "expected_qty": "event_id"},
}


def _scan_feed(kind: str, columns: dict[str, str]):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        path, time = sinks.new_place(spark, kind), "producer_ts" if kind == "expected_price" else "exchange_ts"
        rows = _dated(V.ticks(spark, sf_dir)).selectExpr(*(f"{e} AS {n}" for n, e in columns.items()), f"CAST(exchange_ts AS timestamp) AS {time}", "date")
        sinks.append_partitioned(rows, path, ["date"])
        return readers.read_table(spark, path, kind).select(*columns, F.col(time).cast("timestamp_ntz").alias(time), "date")

    run.__doc__ = f"S3: records of the {kind} feed."
    return run


for _kind, _columns in _FEEDS.items():
    _select = ", ".join(f"{e} AS {n}" for n, e in _columns.items())
    _time = "producer_ts" if _kind == "expected_price" else "exchange_ts"
    FOUND[f"scan_{_kind}"] = (_scan_feed(_kind, _columns), V.with_views(("ticks",), f"SELECT {_select}, exchange_ts AS {_time}, {_DATE} AS date FROM ticks"))


def _bars(spark: SparkSession, sf_dir: str, width: str, name: str) -> DataFrame:
    b = candles.ohlcv(V.ticks(spark, sf_dir), width).withColumnRenamed("bucket", "time")
    return b.select("symbol", F.lit(name).alias("resolution"), "open", "high", "low", "close", "volume", "time", F.date_format("time", "yyyy-MM-dd").alias("date"))


def _bars_sql(width: str) -> str:
    return f"SELECT symbol, time_bucket(INTERVAL '{width}', exchange_ts) AS time, arg_max(price, exchange_ts) AS close, CAST(sum(quantity) AS BIGINT) AS volume, strftime(time_bucket(INTERVAL '{width}', exchange_ts), '%Y-%m-%d') AS date FROM ticks GROUP BY ALL"


@query(V.with_views(("ticks",), "SELECT symbol, time, close, volume, date FROM bars WHERE date IN ('2024-01-09', '2024-01-16') AND symbol IN (SELECT symbol FROM ticks WHERE board_id = 'G3')", bars=_bars_sql("15 minutes")))
def bronze_scan(spark, sf_dir):
    """Candles of two days and one resolution, by partition."""
    path = sinks.new_place(spark, "bronze")
    for width, name in (("15 minutes", "15min"), ("1 hour", "1H")):
        sinks.append_partitioned(_bars(spark, sf_dir, width, name), path, ["date", "resolution"])
    found = readers.read_bronze(spark, path, ["2024-01-09", "2024-01-16"], "15min", V.ticks(spark, sf_dir).filter("board_id = 'G3'"))
    return _ntz(found.select("symbol", "time", "close", "volume", "date"), "time")


@query(V.with_views(("secdef",), f"SELECT symbol, market_id, board_id, security_status FROM secdef WHERE trading_date = DATE '{V.SECDEF_DAY}'"))
def snapshot_scan(spark, sf_dir):
    """One day of a dated table."""
    path = sinks.new_place(spark, "secdef")
    V.secdef(spark, sf_dir).write.partitionBy("trading_date").parquet(path)
    rows = readers.snapshot(readers.read_table(spark, path, "secdef"), F.lit(V.SECDEF_DAY).cast("date"))
    return rows.select("symbol", "market_id", "board_id", "security_status")


@query(V.with_views(("ticks",), "SELECT symbol, price, quantity, side, date_trunc('millisecond', exchange_ts) AS exchange_ts, event_id AS session_vol, true AS is_backfill FROM ticks"))
def landed_trades(spark, sf_dir):
    """Trades of landed API pages of at most 100 records."""
    path, t = sinks.new_place(spark, "pages"), V.ticks(spark, sf_dir)
    local = F.date_format(F.date_trunc("millisecond", F.col("exchange_ts") + F.expr("INTERVAL 7 HOURS")), "yyyy-MM-dd HH:mm:ss.SSS")
    record = F.struct("symbol", local.alias("time"), F.col("price").alias("matchPrice"), F.col("quantity").alias("matchQtty"), F.when(F.col("side") == 1, "BUY").otherwise("SELL").alias("side"), F.col("event_id").alias("totalVolumeTraded"))
    t.groupBy(F.expr("event_id div 100")).agg(F.collect_list(record).alias("data")).select("data").write.json(path)
    rows = N.normalize_rest_trades(readers.landed_pages(spark, path, readers.TRADE_ITEM))
    return _ntz(rows.select("symbol", "price", "quantity", "side", "exchange_ts", "session_vol", "is_backfill"), "exchange_ts")


@query(V.with_views(("ticks",), "SELECT symbol, time, CASE WHEN symbol IN ('click', 'view') AND date >= '2024-01-15' THEN close + 1 ELSE close END AS close, volume, date FROM bars WHERE NOT (symbol = 'view' AND date >= '2024-01-15' AND volume < 40)", bars=_bars_sql("1 hour")))
def replaced_range(spark, sf_dir):
    """K2: the candles of two symbols from a day on written anew, some of them no more."""
    path, b = sinks.new_place(spark, "bars"), _bars(spark, sf_dir, "1 hour", "1H").drop("resolution")
    sinks.append_partitioned(b, path, ["date"])
    there = F.col("symbol").isin("click", "view") & (F.col("date") >= "2024-01-15")
    new = b.filter(there & ~((F.col("symbol") == "view") & (F.col("volume") < 40))).withColumn("close", F.col("close") + 1)
    sinks.replace_where(new, path, there, ["date"])
    rows = spark.read.schema(CANDLE).parquet(path)
    return rows.select("symbol", F.col("time").cast("timestamp_ntz").alias("time"), "close", "volume", "date")


@query(V.with_views(("ticks",), "SELECT symbol, time, CASE WHEN symbol = 'click' THEN close ELSE close + 1 END AS close, volume, date FROM bars", bars=_bars_sql("1 hour")))
def inserted_absent(spark, sf_dir):
    """K3: candles whose keys the table has stay as they are."""
    path, b = sinks.new_place(spark, "bars"), _bars(spark, sf_dir, "1 hour", "1H").drop("resolution")
    sinks.append_partitioned(b.filter("symbol = 'click'"), path, ["date"])
    for _ in range(2):
        sinks.insert_absent(b.withColumn("close", F.col("close") + 1), path, ["symbol", "time"], ["date"])
    return spark.read.schema(CANDLE).parquet(path).select("symbol", F.col("time").cast("timestamp_ntz").alias("time"), "close", "volume", "date")


@query(V.with_views(("instruments", "secdef"), "SELECT coalesce(i.symbol, s.symbol) AS symbol, coalesce(s.market_id, i.market_id) AS market_id, CASE WHEN s.symbol IS NULL THEN i.is_active ELSE true END AS is_active FROM instruments i FULL JOIN (SELECT symbol, max(market_id) AS market_id FROM secdef GROUP BY symbol) s ON i.symbol = s.symbol"))
def merged_master(spark, sf_dir):
    """K2, K3: definitions merged into a stored master, by market; what is known is updated, what is new is added."""
    path, master = sinks.new_place(spark, "masters"), V.instruments(spark, sf_dir).select("symbol", "is_active", "market_id")
    sinks.append_partitioned(master, path, ["market_id"])
    new = V.secdef(spark, sf_dir).groupBy("symbol").agg(F.max("market_id").alias("market_id")).select("symbol", F.lit(True).alias("is_active"), "market_id")
    sinks.merge(new, path, ["symbol"], ["market_id"])
    return spark.read.schema("symbol string, is_active boolean, market_id string").parquet(path)


@query(V.with_views(("instruments",), "SELECT symbol, market_id, is_active, '1997-06-27' AS date FROM instruments UNION ALL SELECT symbol, market_id, true, '1997-06-30' FROM instruments WHERE is_active"))
def daily_snapshots(spark, sf_dir):
    """K6: a master on two days, the second written twice."""
    path, i = sinks.new_place(spark, "masters"), V.instruments(spark, sf_dir).select("symbol", "market_id", "is_active")
    sinks.daily_snapshot(i, path, "1997-06-27")
    sinks.daily_snapshot(i, path, "1997-06-30")
    sinks.daily_snapshot(i.filter("is_active"), path, "1997-06-30")
    return spark.read.schema("symbol string, market_id string, is_active boolean, date string").parquet(path)


@query(V.with_views(("ticks",), "SELECT event_id AS kafka_offset, symbol, CASE WHEN k <> 13 THEN date_trunc('millisecond', exchange_ts) END AS exchange_ts, CASE WHEN k <> 13 THEN strftime(exchange_ts + INTERVAL 7 HOUR, '%Y-%m-%d') END AS date FROM ticks"))
def archived_days(spark, sf_dir):
    """K7: replayed records with epoch milliseconds, some of them unreadable, archived twice."""
    path = sinks.new_place(spark, "archive")
    ms = F.unix_millis(F.convert_timezone(F.lit("UTC"), F.current_timezone(), "exchange_ts").cast("timestamp")).cast("string")
    raw = V.ticks(spark, sf_dir).select("symbol", F.col("event_id").alias("kafka_offset"), F.when(F.col("k") == 13, "none").otherwise(ms).alias("exchange_ts"))
    for part in (raw.filter("symbol = 'click'"), raw):
        sinks.archive_day(part, path, ["exchange_ts"], "exchange_ts", MARKET_TZ, ["kafka_offset"])
    return _ntz(spark.read.parquet(path).select("kafka_offset", "symbol", "exchange_ts", F.col("date").cast("string").alias("date")), "exchange_ts")


@query(V.with_views(("calendar",), "SELECT CAST(trading_date AS VARCHAR) AS trading_date FROM calendar"))
def replaced_calendar(spark, sf_dir):
    """K8: a calendar that took the place of one with all days."""
    path = sinks.new_place(spark, "calendar")
    sinks.replace_table(V.table(spark, sf_dir, "events").select(F.to_date("ts").alias("trading_date")).distinct(), path)
    sinks.replace_table(V.calendar(spark, sf_dir), path)
    return readers.read_table(spark, path, "calendar").select(F.col("trading_date").cast("string").alias("trading_date"))


@query(V.with_views(("ticks",), f"SELECT event_id AS kafka_offset, symbol, price, {_DATE} AS date, {_DATE} = '2024-01-16' AS compacted FROM ticks"))
def compacted_day(spark, sf_dir):
    """K9: one day of trades in few files by symbol, the others as they were."""
    path, t = sinks.new_place(spark, "trades"), _trades(V.ticks(spark, sf_dir))
    sinks.append_partitioned(t.filter("side = 1"), path, ["date"])
    sinks.append_partitioned(t.filter("side = 2"), path, ["date"])
    before = set(spark.read.parquet(path).inputFiles())
    sinks.compact(spark, path, "2024-01-16")
    kept = [f for f in spark.read.parquet(path).inputFiles() if f in before]
    days = sorted({f.split("date=")[1].split("/")[0] for f in kept})
    rows = readers.read_table(spark, path, "trade")
    return rows.select("kafka_offset", "symbol", "price", "date", (~F.col("date").isin(*days)).alias("compacted"))


@query(V.with_views(("ticks",), "SELECT row_number() OVER (ORDER BY symbol, time) AS n, symbol, time, close FROM bars", bars=_bars_sql("1 hour")))
def candle_series(spark, sf_dir):
    """Candles in order, numbered by what is before them in their range of the order."""
    ordered = candles.series(candles.ohlcv(V.ticks(spark, sf_dir), "1 hour"))
    placed = ordered.select("symbol", F.col("bucket").alias("time"), "close", F.monotonically_increasing_id().alias("m"))
    table = sinks.new_place(spark, "series")
    placed.withColumn("part", F.shiftright("m", 33)).write.parquet(table)
    rows = spark.read.parquet(table)
    # as many rows as the order has ranges
    sizes = rows.groupBy("part").agg(F.count("*").alias("size"))
    ahead = sizes.withColumn("ahead", F.sum("size").over(Window.orderBy("part")) - F.col("size"))
    return rows.join(ahead, "part").select((F.col("ahead") + F.col("m") - F.shiftleft("part", 33) + 1).alias("n"), "symbol", "time", "close")


def _batch_of(event: str = "event_id") -> str:
    """The batch in which a tick comes: a tenth each comes late, in two batches."""
    return f"CASE {event} % 10 WHEN 0 THEN 2 WHEN 1 THEN 1 ELSE 0 END"


def _fed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    """A table of ticks and a store of their candles, fed in three batches with a refresh after each."""
    table, store = sinks.new_place(spark, "ticks"), sinks.new_place(spark, "candles")
    t = V.ticks(spark, sf_dir).withColumn("date", F.date_format("exchange_ts", "yyyy-MM-dd"))
    for number in range(3):
        batch = t.filter(F.expr(_batch_of()) == number)
        journal.append_batch(batch, table, ["date"], "ticks", number)
        rollup.log_touched(batch, store, number)
        rollup.refresh(spark, spark.read.parquet(table), store, candles.ohlcv)
    return spark.read.parquet(table), store


@query(V.with_views(("ticks",), f"SELECT * FROM ({market._OHLCV.format(w='1 minute')}) JOIN (SELECT symbol, time_bucket(INTERVAL '1 minute', exchange_ts) AS bucket, count(DISTINCT {_batch_of()}) AS touches FROM ticks GROUP BY 1, 2) USING (symbol, bucket)"))
def refreshed_candles(spark, sf_dir):
    """Stored candles after two late batches, and from how many batches each was made."""
    _, store = _fed(spark, sf_dir)
    return rollup.bars(spark, store).withColumn("turnover", F.round("turnover", 4))


@query(V.with_views(("ticks",), f"SELECT symbol, bucket, open, high, low, close, volume FROM ({market._OHLCV.format(w='15 minutes')}) WHERE bucket >= TIMESTAMP '2024-01-10' AND bucket < TIMESTAMP '2024-01-16'"))
def refreshed_live(spark, sf_dir):
    """A4: wider candles of a range from refreshed ones and newer ticks."""
    table, store = _fed(spark, sf_dir)
    start, end = (F.lit(d).cast("timestamp_ntz") for d in ("2024-01-10", "2024-01-16"))
    middle = F.lit("2024-01-13").cast("timestamp_ntz")
    kept = rollup.bars(spark, store, until=middle)
    live = candles.ohlcv_live(kept, table.filter(F.col("exchange_ts") < end), "15 minutes", start, end)
    return live.filter(F.col("bucket") < end).select("symbol", "bucket", "open", "high", "low", "close", "volume")


@query(V.with_views(("secdef",), f"SELECT symbol, market_id, board_id, security_status, trading_date::VARCHAR AS trading_date FROM secdef WHERE trading_date = DATE '{V.SECDEF_DAY}'"))
def jdbc_snapshot(spark, sf_dir):
    """One day of a database's table, read in parallel between bounds that the database gives.

    The database lives in one process, so only a local session, whose tasks share it, can run this.
    """
    url, properties = f"jdbc:derby:memory:{uuid.uuid4().hex};create=true", {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver", "queryTimeout": "120"}
    readers.write_jdbc(V.secdef(spark, sf_dir).withColumn("hashed", F.crc32("symbol")), url, "secdef", properties, "overwrite", 4)
    rows = readers.read_jdbc(spark, url, "secdef", properties, V.SECDEF_DAY, "hashed", partitions=4)
    found = rows.select("symbol", "market_id", "board_id", "security_status", F.col("trading_date").cast("string").alias("trading_date"))
    path = sinks.new_place(spark, "secdef")
    found.write.parquet(path)
    return spark.read.parquet(path)


_AVRO_1 = """{"type": "record", "name": "Trade", "fields": [{"name": "symbol", "type": "string"}, {"name": "price", "type": "float"}, {"name": "quantity", "type": "int"}, {"name": "board", "type": ["null", "string"], "default": null}, {"name": "exchange_ts", "type": {"type": "long", "logicalType": "timestamp-micros"}}]}"""
_AVRO_2 = """{"type": "record", "name": "Trade", "fields": [{"name": "exchange_ts", "type": {"type": "long", "logicalType": "timestamp-micros"}}, {"name": "symbol", "type": "string"}, {"name": "price", "type": "double"}, {"name": "quantity", "type": "long"}, {"name": "board_id", "type": ["null", "string"], "default": null, "aliases": ["board"]}, {"name": "side", "type": "int", "default": 0}]}"""


@query(V.with_views(("ticks",), "SELECT event_id AS kafka_offset, CASE WHEN k % 3 = 0 THEN 1 WHEN k % 31 <> 1 THEN 2 END AS schema_id, CASE WHEN k % 3 = 0 OR k % 31 <> 1 THEN symbol END AS symbol, CASE WHEN k % 3 = 0 THEN CAST(CAST(price AS FLOAT) AS DOUBLE) WHEN k % 31 <> 1 THEN price END AS price, CASE WHEN k % 3 = 0 OR k % 31 <> 1 THEN CAST(quantity AS BIGINT) END AS quantity, CASE WHEN k % 3 = 0 OR k % 31 <> 1 THEN board_id END AS board_id, CASE WHEN k % 3 = 0 THEN 0 WHEN k % 31 <> 1 THEN side END AS side, CASE WHEN k % 3 = 0 OR k % 31 <> 1 THEN exchange_ts END AS exchange_ts, CASE WHEN NOT (k % 3 = 0 OR k % 31 <> 1) THEN 'no frame' END AS problem FROM ticks"))
def avro_topic(spark, sf_dir):
    """Messages of two schema versions framed for a registry, and some without a frame, as one table."""
    t = V.ticks(spark, sf_dir).withColumns({"exchange_ts": F.col("exchange_ts").cast("timestamp"), "offset": F.col("event_id"), "partition": F.lit(0)})
    old = avro.encode(t.filter("k % 3 = 0").withColumnRenamed("board_id", "board"), _AVRO_1, 1, keep=("partition", "offset"))
    new = avro.encode(t.filter("k % 3 <> 0 AND k % 31 <> 1"), _AVRO_2, 2, keep=("partition", "offset"))
    bad = t.filter("k % 3 <> 0 AND k % 31 = 1").select("partition", "offset", F.encode(F.lit("{}"), "UTF-8").alias("value"))
    rows = readers.decode_topic(old.unionByName(new).unionByName(bad), "trade", {1: _AVRO_1, 2: _AVRO_2}, _AVRO_2)
    return _ntz(rows.select("kafka_offset", "schema_id", "symbol", "price", "quantity", "board_id", "side", "exchange_ts", "problem"), "exchange_ts")


@query(V.with_views(("ticks",), f"SELECT event_id AS kafka_offset, symbol, price, {_DATE} AS date, {_DATE} = '2024-01-16' AS clustered FROM ticks"))
def clustered_day(spark, sf_dir):
    """K9: one day of trades in files of a size, by the Z-order of symbol and price."""
    path, t = sinks.new_place(spark, "trades"), _trades(V.ticks(spark, sf_dir))
    sinks.append_partitioned(t, path, ["date"])
    before = set(spark.read.parquet(path).inputFiles())
    sinks.compact(spark, path, "2024-01-16", ["symbol", "price"], file_bytes=4096)
    kept = [f for f in spark.read.parquet(path).inputFiles() if f in before]
    days = sorted({f.split("date=")[1].split("/")[0] for f in kept})
    rows = readers.read_table(spark, path, "trade")
    return rows.select("kafka_offset", "symbol", "price", "date", (~F.col("date").isin(*days)).alias("clustered"))


@query(V.with_views(("ticks",), f"SELECT TIMESTAMP '{V.AS_OF}' AS ts, 'archiver' AS service_name, unnest(['fetched', 'skipped', 'no_price']) AS metric_name, unnest([count(*), count(*) FILTER (board_id <> 'G1'), count(*) FILTER (k % 17 = 0)])::DOUBLE AS metric_value, '' AS label FROM ticks"))
def counts_in_flight(spark, sf_dir):
    """Rows of a board appended to a table, with counts of what came and what was left out, from the one scan."""
    path, t = sinks.new_place(spark, "trades"), _dated(V.ticks(spark, sf_dir))
    seen_rows, seen = ops_metrics.counted(t, fetched=F.count("*"), skipped=N.skipped_boards(t, ["G1"]), no_price=F.count_if(F.col("k") % 17 == 0))
    sinks.append_partitioned(N.filter_boards(seen_rows, ["G1"]), path, ["date"])
    return ops_metrics.metric_rows(spark, seen, V.AS_OF, "archiver")


# Streams


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events' files as a stream of ticks."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    raw = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return V.as_ticks(raw)


def _finished(spark: SparkSession, stream: DataFrame, name: str) -> DataFrame:
    """All that a stream appends by the time its source is used up."""
    path = sinks.new_place(spark, name)
    streams.to_serving(stream, path, sinks.new_place(spark, "offsets"), stream.columns).awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


_CLOSED = "bucket + INTERVAL 1 MINUTE <= (SELECT date_trunc('millisecond', max(exchange_ts)) FROM ticks) - INTERVAL 10 MINUTE"


@query(V.with_views(("ticks",), f"SELECT * FROM ({market._OHLCV.format(w='1 minute').replace(', avg(k) AS avg_latency_ms', '')}) WHERE {_CLOSED}"))
def stream_candles(spark, sf_dir):
    """1-minute candles of a stream, closed by the watermark."""
    bars = _finished(spark, streams.ohlcv_stream(_events(spark, sf_dir)), "bars")
    return _ntz(bars, "bucket").withColumn("turnover", F.round("turnover", 4))


@query(V.with_views(("ticks",), f"SELECT *, CAST(1 AS BIGINT) AS touches FROM ({market._OHLCV.format(w='1 minute')})"))
def stream_maintained(spark, sf_dir):
    """A stream into a table of ticks and a store of refreshed candles."""
    table, store = sinks.new_place(spark, "ticks"), sinks.new_place(spark, "candles")
    rows = _events(spark, sf_dir).drop("user_id")
    streams.maintained_candles(rows, table, store, sinks.new_place(spark, "offsets")).awaitTermination()
    return rollup.bars(spark, store).withColumn("turnover", F.round("turnover", 4))


@query(V.with_views(("ticks",), f"SELECT * FROM (SELECT symbol AS index_name, time_bucket(INTERVAL '1 minute', exchange_ts) AS bucket, arg_min(price, exchange_ts) AS open, max(price) AS high, min(price) AS low, arg_max(price, exchange_ts) AS close, max(event_id) - min(event_id) AS volume, arg_max(k, exchange_ts) AS up_count FROM ticks GROUP BY 1, 2) WHERE {_CLOSED}"))
def stream_index(spark, sf_dir):
    """Index candles of a stream."""
    snaps = _events(spark, sf_dir).select(F.col("symbol").alias("index_name"), F.col("price").alias("value"), F.col("event_id").alias("total_volume"), F.col("k").alias("up_count"), "exchange_ts")
    return _ntz(_finished(spark, streams.index_stream(snaps, breadth=("up_count",)), "index"), "bucket")


@query(V.with_views(("ticks",), "SELECT event_id, symbol FROM ticks"))
def stream_dedup(spark, sf_dir):
    """A source that sends a fifth of its records twice."""
    t = _events(spark, sf_dir).select("event_id", "symbol", "exchange_ts")
    once = streams.dedup_stream(t.unionByName(t.filter("event_id % 5 = 0")), ["event_id"])
    return _finished(spark, once.select("event_id", "symbol"), "once")


@query(V.with_views(("ticks",), f"SELECT event_id, symbol, price, {_DATE} AS date FROM ticks"))
def stream_bronze(spark, sf_dir):
    """K4: a stream into partitioned files."""
    path = sinks.new_place(spark, "bronze")
    rows = _dated(_events(spark, sf_dir)).select("event_id", "symbol", "price", "date")
    streams.to_bronze(rows, path, sinks.new_place(spark, "offsets")).awaitTermination()
    return spark.read.parquet(path).select("event_id", "symbol", "price", F.col("date").cast("string").alias("date"))


@query(V.with_views(("ticks",), "SELECT symbol, price, quantity, side, exchange_ts FROM ticks"))
def stream_serving(spark, sf_dir):
    """K5: a stream's fixed projection in a serving table."""
    return _finished(spark, _events(spark, sf_dir).select("symbol", "price", "quantity", "side", "exchange_ts"), "serving")


@query(V.with_views(("ticks",), f"SELECT event_id, 'bronze' AS place, price * 1000 AS price, {_DATE} AS date FROM ticks UNION ALL SELECT event_id, 'serving', price * 1000, {_DATE} FROM ticks WHERE board_id = 'G1'"))
def stream_route(spark, sf_dir):
    """A mapper of the caller, then all rows to one table and those of a board to another."""
    bronze, serving = sinks.new_place(spark, "bronze"), sinks.new_place(spark, "serving")
    mapper = lambda d: d.withColumn("price", F.col("price") * 1000)
    streams.route(_events(spark, sf_dir), mapper, ["G1"], bronze, serving, sinks.new_place(spark, "offsets"), partition_stamp("exchange_ts", MARKET_TZ)).awaitTermination()
    table = lambda path, name: spark.read.schema("event_id bigint, price double, date string").parquet(path).select("event_id", F.lit(name).alias("place"), "price", "date")
    return table(bronze, "bronze").unionByName(table(serving, "serving"))


@query(V.with_views(("uticks",), "SELECT event_id, symbol FROM uticks WHERE symbol IN (SELECT 'U' || c_custkey FROM customer WHERE c_acctbal > 0)"))
def stream_universe(spark, sf_dir):
    """A stream's rows of the symbols that a table lists when a batch comes."""
    path = sinks.new_place(spark, "wanted")
    wanted = lambda s: V.table(s, sf_dir, "customer").filter("c_acctbal > 0").select(F.concat(F.lit("U"), F.col("c_custkey").cast("string")).alias("symbol"))
    rows = _events(spark, sf_dir).select("event_id", F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("symbol"))
    write = lambda batch, number: sinks.overwrite_partitions(batch.withColumn("batch_id", F.lit(number)), path, ["batch_id"])
    streams.with_universe(rows, wanted, write, sinks.new_place(spark, "offsets")).awaitTermination()
    return spark.read.parquet(path).select("event_id", "symbol")


@query(V.with_views(("ticks", "bands"), "SELECT event_id, price, ceiling_price, floor_price FROM ticks JOIN bands b ON ticks.symbol = b.symbol AND CAST(exchange_ts AS DATE) = b.day WHERE price > ceiling_price OR price < floor_price"))
def stream_anomalies(spark, sf_dir):
    """A stream's trades outside their bands."""
    rows = _events(spark, sf_dir).withColumn("day", F.to_date("exchange_ts"))
    found = streams.anomaly_stream(rows, V.bands(spark, sf_dir), ["symbol", "day"])
    return _finished(spark, found.select("event_id", "price", "ceiling_price", "floor_price"), "anomalies")


@query(V.with_views(("quotes",), "SELECT event_id, bid_price1, ask_price1 FROM quotes WHERE bid_price1 > 0 AND ask_price1 - bid_price1 < 0"))
def stream_spreads(spark, sf_dir):
    """A stream's quotes with the ask below the bid."""
    found = streams.spread_stream(V.as_quotes(_events(spark, sf_dir)))
    return _finished(spark, found.select("event_id", "bid_price1", "ask_price1"), "spreads")


@query(V.with_views(("ticks",), "SELECT symbol, ts, previous, current, false AS late FROM (SELECT symbol, exchange_ts AS ts, CAST(k AS BIGINT) AS current, CAST(lag(k) OVER (PARTITION BY symbol, CAST(exchange_ts AS DATE) ORDER BY exchange_ts, event_id) AS BIGINT) AS previous FROM ticks) WHERE current < previous"))
def stream_resets(spark, sf_dir):
    """Where a symbol's counter goes down within a day."""
    rows = _events(spark, sf_dir).select("symbol", "exchange_ts", F.col("k").alias("session_vol"), F.col("event_id").alias("kafka_offset"))
    return _ntz(_finished(spark, streams.reset_stream(rows), "resets"), "ts")


@query(FOUND["alert_transitions"][1])
def stream_alerts(spark, sf_dir):
    """The state machine of alerts over a stream."""
    states = _events(spark, sf_dir).select(F.col("symbol").alias("key"), F.col("exchange_ts").alias("ts"), (F.col("k") < 50).alias("firing"))
    return _ntz(_finished(spark, streams.alert_stream(states), "alerts"), "ts")


@query(V.with_views(("ticks",), "SELECT symbol AS check_name, max(exchange_ts) AS ts, count(*) AS n_new FROM ticks WHERE k > 95 GROUP BY 1"))
def stream_marks(spark, sf_dir):
    """Anomalies newer than each check's high-water mark, over all batches."""
    found = _events(spark, sf_dir).filter("k > 95").select(F.col("symbol").alias("check_name"), F.col("exchange_ts").alias("ts"))
    marks = _finished(spark, streams.mark_stream(found), "marks")
    return _ntz(marks.groupBy("check_name").agg(F.max("ts").alias("ts"), F.sum("n_new").alias("n_new")), "ts")
