"""Market-shaped views over the test tables, and the same views as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

MARKETS = ("STO", "STX", "DVX", "UPX", "HCX")
#: Days and times that the queries refer to.
HOLIDAYS = ("2024-01-10", "2024-01-23")
AS_OF = "2024-01-16 04:00:00"
SECDEF_DAY = "1997-06-30"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ticks(spark: SparkSession, sf_dir: str, by_user: bool = False) -> DataFrame:
    """Events as trades: few symbols by type, or one a user."""
    t = as_ticks(table(spark, sf_dir, "events"))
    return (t.withColumn("symbol", F.concat(F.lit("U"), F.col("user_id").cast("string"))) if by_user else t).drop("user_id")


def as_ticks(events: DataFrame) -> DataFrame:
    """Rows of events, of a table or a stream, as trades by type."""
    k = F.get_json_object("props", "$.k").cast("int")
    return events.withColumn("k", k).select(
        F.col("event_type").alias("symbol"), F.col("value").alias("price"), (F.col("k") + 1).alias("quantity"), F.when(F.col("k") % 2 == 0, 1).otherwise(2).alias("side"), F.when(F.col("k") % 10 == 0, "G3").otherwise("G1").alias("board_id"),
        F.col("ts").alias("exchange_ts"), (F.col("ts") + F.make_dt_interval(secs=(F.col("k") / 1000).cast("decimal(18,6)"))).alias("gateway_ts"), "event_id", "k", "user_id",
    )


def quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_quotes(ticks(spark, sf_dir))


def as_quotes(t: DataFrame) -> DataFrame:
    """Ticks with a bid, an ask and up to three levels of depth."""
    level = lambda i: F.struct((F.col("price") - i / 10).alias("price"), (F.col("quantity") + i).alias("qtty"))
    levels = F.slice(F.array(*(level(i) for i in range(3))), 1, F.col("k") % 4)
    return t.select("symbol", F.when(F.col("k") % 17 != 0, F.col("price")).alias("bid_price1"), (F.col("price") + (F.col("k") - 5) / 100).alias("ask_price1"), levels.alias("bid_levels"), "exchange_ts", "gateway_ts", "event_id", "k", "board_id")


def index_snaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = Window.partitionBy("symbol", F.to_date("exchange_ts")).orderBy("exchange_ts").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return ticks(spark, sf_dir).select(F.col("symbol").alias("index_name"), F.col("price").alias("value"), F.sum(F.col("quantity").cast("bigint")).over(day).alias("total_volume"), F.col("k").alias("up_count"), "exchange_ts", "gateway_ts")


def bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ceiling and floor of each symbol and day from the mean price (in whole hundredths) of the day before."""
    per = ticks(spark, sf_dir).groupBy("symbol", F.to_date("exchange_ts").alias("day")).agg((F.expr("sum(cast(round(price * 100) as bigint)) div count(*)") / 100).alias("mean"))
    before = per.withColumn("mean", F.lag("mean").over(Window.partitionBy("symbol").orderBy("day"))).filter("mean IS NOT NULL")
    return before.select("symbol", "day", (F.col("mean") * 4).alias("ceiling_price"), (F.col("mean") * 0.05).alias("floor_price"))


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = table(spark, sf_dir, "events").select(F.to_date("ts").alias("trading_date")).distinct()
    return days.filter((F.weekday("trading_date") < 5) & ~F.col("trading_date").isin(*(F.lit(h).cast("date") for h in HOLIDAYS)))


def instruments(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, nation = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    c = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    market = F.element_at(F.array(*map(F.lit, MARKETS)), F.col("n_regionkey").cast("int") + 1)
    key = F.col("c_custkey")
    index = F.when(key % 6 == 0, "VN30,VN100").when(key % 6 == 1, "VN100").when(key % 6 == 2, "HNX30").when(key % 6 == 3, "VN300")
    expiry = F.when(market == "DVX", F.lit("1997-01-01").cast("date") + (key % 400).cast("int"))
    return c.select(F.col("c_name").alias("symbol"), market.alias("market_id"), F.col("c_mktsegment").alias("security_group_id"), index.alias("index_name"), (F.col("c_acctbal") > 0).alias("is_active"), expiry.alias("final_trade_date"), key.alias("id"))


def secdef(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with an order in a window, on its last day, and a few names that the master lacks."""
    orders = table(spark, sf_dir, "orders").filter((F.col("o_orderdate") >= "1997-01-01") & (F.col("o_orderdate") < "1998-01-01")).select(F.col("o_custkey").alias("id")).distinct()
    known = instruments(spark, sf_dir).join(orders, "id", "left_semi")
    key = F.col("id")
    day = F.when(key % 5 == 0, F.lit("1997-06-27")).otherwise(F.lit(SECDEF_DAY)).cast("date")
    rows = known.select("symbol", "market_id", F.when(key % 7 == 0, "G3").otherwise("G1").alias("board_id"), F.when(key % 11 == 0, "HALT").otherwise("OPEN").alias("security_status"), F.lit("1999-01-01").cast("date").alias("final_trade_date"), day.alias("trading_date"))
    extra = spark.range(9).select(F.concat(F.lit("NEW"), F.col("id").cast("string")).alias("symbol"), F.lit("STO").alias("market_id"), F.lit("G1").alias("board_id"), F.lit("OPEN").alias("security_status"), F.lit(None).cast("date").alias("final_trade_date"), F.when(F.col("id") < 6, F.lit(SECDEF_DAY)).otherwise(F.lit("1997-06-27")).cast("date").alias("trading_date"))
    return rows.unionByName(extra)


def contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The master's derivatives as contracts, a family for each group."""
    return instruments(spark, sf_dir).filter("market_id = 'DVX'").select(F.col("security_group_id").alias("family"), "symbol", F.col("final_trade_date").alias("expiry"))


def dup_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks with a fifth of them again and near copies: other microseconds and a fifth decimal."""
    t = ticks(spark, sf_dir).withColumn("copy", F.lit(0))
    again = t.filter("event_id % 5 = 0").withColumn("copy", F.lit(1))
    near = t.filter("event_id % 7 = 0").withColumn("copy", F.lit(2)).withColumn("price", F.col("price") + 0.00001).withColumn("exchange_ts", F.date_trunc("millisecond", F.col("exchange_ts")).cast("timestamp_ntz"))
    return t.unionByName(again).unionByName(near)


def run_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    end = F.col("o_orderdate") + F.make_dt_interval(secs=(F.col("o_orderkey") % 900).cast("decimal(18,6)"))
    return table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("dag_id"), F.concat(F.lit("task"), (F.col("o_custkey") % 4).cast("string")).alias("task_id"), F.col("o_orderstatus").alias("state"), F.col("o_orderdate").alias("start_date"), end.alias("end_date"))


def counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A running sum of quantities of each symbol that starts anew whenever k is 0."""
    order = Window.partitionBy("symbol").orderBy("exchange_ts").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    epoch = ticks(spark, sf_dir).withColumn("epoch", F.sum(F.when(F.col("k") == 0, 1).otherwise(0)).over(order))
    within = Window.partitionBy("symbol", "epoch").orderBy("exchange_ts").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return epoch.select("symbol", F.col("exchange_ts").alias("ts"), F.sum(F.col("quantity").cast("bigint")).over(within).alias("value"), "event_id")


def candles_by_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    """1-minute candles of the ticks on the market's clock: their UTC hours are moved into a session."""
    from ..operators.candles import ohlcv

    t = ticks(spark, sf_dir).withColumn("exchange_ts", F.col("exchange_ts") - F.expr("INTERVAL 3 HOURS"))
    return ohlcv(t).withColumnRenamed("bucket", "time").select("symbol", "time", "open", "high", "low", "close", "volume")


# The same views in SQL.
_TICK = """SELECT {symbol} AS symbol, value AS price, k + 1 AS quantity, CASE WHEN k % 2 = 0 THEN 1 ELSE 2 END AS side,
 CASE WHEN k % 10 = 0 THEN 'G3' ELSE 'G1' END AS board_id, ts AS exchange_ts, ts + to_milliseconds(k) AS gateway_ts, event_id, k
 FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k FROM events)"""
SQL = {
    "ticks": _TICK.format(symbol="event_type"),
    "uticks": _TICK.format(symbol="'U' || user_id"),
    "quotes": "SELECT symbol, CASE WHEN k % 17 <> 0 THEN price END AS bid_price1, price + (k - 5) / 100 AS ask_price1, list_slice([{'price': price - 0, 'qtty': quantity}, {'price': price - 0.1, 'qtty': quantity + 1}, {'price': price - 0.2, 'qtty': quantity + 2}], 1, k % 4) AS bid_levels, exchange_ts, gateway_ts, event_id, k, board_id FROM ticks",
    "index_snaps": "SELECT symbol AS index_name, price AS value, CAST(sum(quantity) OVER (PARTITION BY symbol, CAST(exchange_ts AS DATE) ORDER BY exchange_ts ROWS UNBOUNDED PRECEDING) AS BIGINT) AS total_volume, k AS up_count, exchange_ts, gateway_ts FROM ticks",
    "bands": "SELECT symbol, day, mean * 4 AS ceiling_price, mean * 0.05 AS floor_price FROM (SELECT symbol, day, lag(mean) OVER (PARTITION BY symbol ORDER BY day) AS mean FROM (SELECT symbol, CAST(exchange_ts AS DATE) AS day, CAST(sum(CAST(round(price * 100) AS BIGINT)) // count(*) AS BIGINT) / 100 AS mean FROM ticks GROUP BY ALL)) WHERE mean IS NOT NULL",
    "calendar": f"SELECT DISTINCT CAST(ts AS DATE) AS trading_date FROM events WHERE isodow(ts) < 6 AND CAST(ts AS DATE) NOT IN ({', '.join(f"DATE '{h}'" for h in HOLIDAYS)})",
    "instruments": f"SELECT c_name AS symbol, [{', '.join(repr(m) for m in MARKETS)}][n_regionkey + 1] AS market_id, c_mktsegment AS security_group_id, CASE c_custkey % 6 WHEN 0 THEN 'VN30,VN100' WHEN 1 THEN 'VN100' WHEN 2 THEN 'HNX30' WHEN 3 THEN 'VN300' END AS index_name, c_acctbal > 0 AS is_active, CASE WHEN n_regionkey = 2 THEN DATE '1997-01-01' + CAST(c_custkey % 400 AS INTEGER) END AS final_trade_date, c_custkey AS id FROM customer JOIN nation ON c_nationkey = n_nationkey",
    "secdef": f"""SELECT symbol, market_id, CASE WHEN id % 7 = 0 THEN 'G3' ELSE 'G1' END AS board_id, CASE WHEN id % 11 = 0 THEN 'HALT' ELSE 'OPEN' END AS security_status, DATE '1999-01-01' AS final_trade_date, CASE WHEN id % 5 = 0 THEN DATE '1997-06-27' ELSE DATE '{SECDEF_DAY}' END AS trading_date
 FROM instruments WHERE id IN (SELECT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1998-01-01')
 UNION ALL SELECT 'NEW' || i, 'STO', 'G1', 'OPEN', NULL, CASE WHEN i < 6 THEN DATE '{SECDEF_DAY}' ELSE DATE '1997-06-27' END FROM range(9) r(i)""",
    "contracts": "SELECT security_group_id AS family, symbol, final_trade_date AS expiry FROM instruments WHERE market_id = 'DVX'",
    "dup_trades": "SELECT *, 0 AS copy FROM ticks UNION ALL SELECT *, 1 FROM ticks WHERE event_id % 5 = 0 UNION ALL SELECT symbol, price + 0.00001, quantity, side, board_id, date_trunc('millisecond', exchange_ts), gateway_ts, event_id, k, 2 FROM ticks WHERE event_id % 7 = 0",
    "run_history": "SELECT o_orderpriority AS dag_id, 'task' || (o_custkey % 4) AS task_id, o_orderstatus AS state, o_orderdate AS start_date, o_orderdate + to_seconds(o_orderkey % 900) AS end_date FROM orders",
    "counters": "SELECT symbol, exchange_ts AS ts, CAST(sum(quantity) OVER (PARTITION BY symbol, epoch ORDER BY exchange_ts ROWS UNBOUNDED PRECEDING) AS BIGINT) AS value, event_id FROM (SELECT *, sum(CASE WHEN k = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY symbol ORDER BY exchange_ts ROWS UNBOUNDED PRECEDING) AS epoch FROM ticks)",
    "minute_bars": "SELECT symbol, time_bucket(INTERVAL '1 minute', exchange_ts - INTERVAL 3 HOUR) AS time, arg_min(price, exchange_ts) AS open, max(price) AS high, min(price) AS low, arg_max(price, exchange_ts) AS close, CAST(sum(quantity) AS BIGINT) AS volume FROM ticks GROUP BY ALL",
}
NEEDS = {"quotes": ("ticks",), "index_snaps": ("ticks",), "bands": ("ticks",), "secdef": ("instruments",), "contracts": ("instruments",), "dup_trades": ("ticks",), "counters": ("ticks",), "minute_bars": ("ticks",)}


def with_views(names: tuple[str, ...], select: str, **ctes: str) -> str:
    """A SELECT over views, which come before it with what they need."""
    order: list[str] = []

    def add(name: str) -> None:
        for n in NEEDS.get(name, ()):
            add(n)
        if name not in order:
            order.append(name)

    for n in names:
        add(n)
    parts = [f"{n} AS ({SQL[n]})" for n in order] + [f"{n} AS ({q})" for n, q in ctes.items()]
    return f"WITH {', '.join(parts)} {select}"
