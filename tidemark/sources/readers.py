"""Typed scans. Filters and columns reach the files; nothing is collected."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.time import MARKET_TZ, replay_start
from ..schemas import CANDLE, KINDS
from . import avro, journal


def read_table(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """A bronze or reference table with its schema; Delta where its reader is present and asked for by ``delta:``. A writer's unfinished swap is finished first."""
    if path.startswith("delta:"):
        return spark.read.format("delta").load(path.removeprefix("delta:"))
    journal.settle(spark, path)
    return spark.read.schema(KINDS[kind]).parquet(path)


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def read_bronze(spark: SparkSession, path: str, dates: list[str], resolution: str, symbols: DataFrame | None = None) -> DataFrame:
    """Candles of dates and a resolution, by partition; empty if the table is not there."""
    if not _exists(spark, path):
        return spark.createDataFrame([], CANDLE)
    rows = spark.read.schema(CANDLE).parquet(path).filter(F.col("date").isin(*dates) & (F.col("resolution") == resolution))
    return rows.join(symbols.select("symbol").distinct(), "symbol", "left_semi") if symbols is not None else rows


def stream_table(spark: SparkSession, path: str, kind: str, files_per_batch: int = 1000) -> DataFrame:
    """A stream of the files that land in a folder."""
    return spark.readStream.schema(KINDS[kind]).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def stream_topic(spark: SparkSession, servers: str, topic: str, kind: str, start: str = "earliest", rows_per_batch: int | None = None, schemas: dict[int, str] | None = None, reader_schema: str | None = None) -> DataFrame:
    """A stream of a topic's records: JSON, or Avro framed for a registry if its ``schemas`` are given. Needs Spark's Kafka package."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic).option("startingOffsets", start)
    if rows_per_batch:
        reader = reader.option("maxOffsetsPerTrigger", rows_per_batch)
    return decode_topic(reader.load(), kind, schemas, reader_schema)


def decode_topic(messages: DataFrame, kind: str, schemas: dict[int, str] | None = None, reader_schema: str | None = None) -> DataFrame:
    """Messages (value, partition, offset) as rows of a feed; of Avro ones that can't be read, ``problem`` says why."""
    if schemas is None:
        return decode(messages, KINDS[kind])
    rows = avro.decode(messages, schemas, reader_schema or next(iter(schemas.values())))
    return rows.withColumnsRenamed({"partition": "kafka_partition", "offset": "kafka_offset"})


def replay_topic(spark: SparkSession, servers: str, topic: str, kind: str, start_ms: int, end_ms: int | None = None, schemas: dict[int, str] | None = None, reader_schema: str | None = None) -> DataFrame:
    """A bounded read of a topic between two times, both included. Needs the Kafka package."""
    reader = spark.read.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic).option("startingTimestamp", str(start_ms))
    if end_ms is not None:
        reader = reader.option("endingTimestamp", str(end_ms + 1))
    return decode_topic(reader.load(), kind, schemas, reader_schema)


def decode(messages: DataFrame, schema: T.StructType) -> DataFrame:
    """Fields of JSON message values, with the partition and offset they came from."""
    body = F.from_json(F.col("value").cast("string"), schema).alias("r")
    return messages.select(body, "partition", "offset").select("r.*", F.col("partition").alias("__partition"), F.col("offset").alias("__offset")).withColumns({"kafka_partition": F.col("__partition"), "kafka_offset": F.col("__offset")}).drop("__partition", "__offset")


def between(rows: DataFrame, start: Column, end: Column | None = None, ts: str = "exchange_ts") -> DataFrame:
    """Rows of a range of time, both ends included."""
    kept = rows.filter(F.col(ts) >= start)
    return kept if end is None else kept.filter(F.col(ts) <= end)


def since_session_start(rows: DataFrame, as_of: Column, ts: str = "exchange_ts", tz: str = MARKET_TZ) -> DataFrame:
    return between(rows, replay_start(as_of, tz), as_of, ts)


def snapshot(rows: DataFrame, day: Column, column: str = "trading_date") -> DataFrame:
    """A dated table's rows of one day."""
    return rows.filter(F.col(column) == day)


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict[str, str], day: str | None = None, key: str | None = None, bounds: tuple | None = None, partitions: int = 16) -> DataFrame:
    """A database table, in parallel by a number, date or time column ``key``. Needs the database's driver.

    Without ``bounds`` the database is asked for the key's least and largest value (one
    row). Rows outside of bounds, and those with a null key, are read all the same.
    """
    reader = spark.read.format("jdbc").option("url", url).options(**properties)
    if key:
        if bounds is None:
            named = spark._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(url).quoteIdentifier(key)
            bounds = tuple(reader.option("query", f"SELECT MIN({named}) AS low, MAX({named}) AS high FROM {table}").load().first())
            reader = spark.read.format("jdbc").option("url", url).options(**properties)
        if bounds[0] is not None:
            reader = reader.options(partitionColumn=key, lowerBound=bounds[0], upperBound=bounds[1], numPartitions=partitions)
    rows = reader.option("dbtable", table).load()
    return rows.filter(F.col("trading_date") == day) if day else rows


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str], mode: str = "append", partitions: int = 16) -> None:
    """Rows into a database table, by at most so many connections."""
    df.coalesce(partitions).write.format("jdbc").option("url", url).option("dbtable", table).options(**properties).mode(mode).save()


#: Record schemas of the landed API pages.
TRADE_ITEM = "symbol string, marketId string, boardId string, time string, matchPrice double, matchQtty int, side string, totalVolumeTraded bigint, highestPrice double, lowestPrice double, openPrice double, avgPrice double, tradingSessionId string"
QUOTE_ITEM = "symbol string, marketId string, boardId string, time string, bid array<struct<price:double,quantity:int>>, offer array<struct<price:double,quantity:int>>, totalBidQtty bigint, totalOfferQtty bigint"
CANDLE_PAGE = "symbol string, resolution string, t array<bigint>, o array<double>, h array<double>, l array<double>, c array<double>, v array<bigint>"


def landed_pages(spark: SparkSession, path: str, item: str, names: tuple[str, ...] = ("data", "instruments", "items")) -> DataFrame:
    """Records of landed JSON pages, under whichever of the names a page has them."""
    element = T.StructType.fromDDL(item)
    schema = T.StructType([T.StructField(n, T.ArrayType(element)) for n in names])
    pages = spark.read.schema(schema).json(path)
    return pages.select(F.explode(F.coalesce(*names)).alias("r")).select("r.*")


def landed_days(spark: SparkSession, path: str) -> DataFrame:
    """Working days of landed JSON: a list of strings, of objects, or either below a name."""
    text = spark.read.text(path, wholetext=True).select(F.parse_json("value").alias("v"))
    wrapped = [F.try_variant_get("v", f"$.{n}", "variant") for n in ("data", "workingDates", "dates", "items")]
    days = text.select(F.explode(F.coalesce(*(F.try_variant_get(x, "$", "array<variant>") for x in (*wrapped, F.col("v"))))).alias("d"))
    value = F.coalesce(F.try_variant_get("d", "$.date", "string"), F.try_variant_get("d", "$.tradingDate", "string"), F.try_variant_get("d", "$.workingDate", "string"), F.try_variant_get("d", "$", "string"))
    return days.select(F.substring(value, 1, 10).try_cast("date").alias("trading_date")).filter("trading_date IS NOT NULL").distinct()


def candle_arrays(pages: DataFrame, keys: tuple[str, ...] = ("symbol", "resolution")) -> DataFrame:
    """Rows of candle pages whose columns are arrays, matched by place."""
    zipped = pages.select(*keys, F.explode(F.arrays_zip("t", "o", "h", "l", "c", "v")).alias("x"))
    return zipped.select(*keys, F.timestamp_seconds("x.t").alias("time"), F.col("x.o").alias("open"), F.col("x.h").alias("high"), F.col("x.l").alias("low"), F.col("x.c").alias("close"), F.col("x.v").alias("volume"))
