"""All queries of the market operators over the test tables, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import normalize as N
from ..functions import time as T
from ..operators import calendar, candles, dedup, futures, instruments, ops_metrics, quality, silver
from ..sources import readers, sinks
from . import views as V
from .registry import FOUND as _FOUND
from .registry import Query, query

def _quotient(total: str, parts: str, places: int) -> str:
    """SQL of whole total / whole parts, rounded in integers."""
    up = 10**places
    return f"CAST(({total} * {2 * up} + {parts}) // ({parts} * 2) AS BIGINT) / {up}.0::DOUBLE"


def _at(text: str) -> F.Column:
    return F.lit(text).cast("timestamp_ntz")


def _day(text: str) -> F.Column:
    return F.lit(text).cast("date")


AS_OF, DAY = V.AS_OF, V.SECDEF_DAY

# Candles

_OHLCV = """SELECT symbol, time_bucket(INTERVAL '{w}', exchange_ts) AS bucket, arg_min(price, exchange_ts) AS open, max(price) AS high, min(price) AS low, arg_max(price, exchange_ts) AS close,
 CAST(sum(quantity) AS BIGINT) AS volume, round(sum(quantity * price), 4) AS turnover, CAST(sum(CASE WHEN side = 1 THEN quantity ELSE 0 END) AS BIGINT) AS buy_vol, CAST(sum(CASE WHEN side = 2 THEN quantity ELSE 0 END) AS BIGINT) AS sell_vol,
 count(*) AS tick_count, avg(k) AS avg_latency_ms FROM ticks GROUP BY 1, 2"""


def _ohlcv(width: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return candles.ohlcv(V.ticks(spark, sf_dir), width).withColumn("turnover", F.round("turnover", 4))

    return run


for _name, _width in (("ohlcv_1m", "1 minute"), ("ohlcv_15m", "15 minutes"), ("ohlcv_1h", "1 hour")):
    _FOUND[_name] = (_ohlcv(_width), V.with_views(("ticks",), _OHLCV.format(w=_width)))


@query(V.with_views(("ticks",), """SELECT symbol, date_trunc('day', exchange_ts + INTERVAL 7 HOUR) AS bucket, arg_min(price, exchange_ts) AS open, max(price) AS high, min(price) AS low, arg_max(price, exchange_ts) AS close, CAST(sum(quantity) AS BIGINT) AS volume, count(*) AS tick_count FROM ticks GROUP BY 1, 2"""))
def ohlcv_1d(spark, sf_dir):
    """Daily candles on the market's clock."""
    return candles.ohlcv(V.ticks(spark, sf_dir), "1D").select("symbol", "bucket", "open", "high", "low", "close", "volume", "tick_count")


@query(V.with_views(("ticks",), """SELECT symbol, date_trunc('week', exchange_ts + INTERVAL 7 HOUR)::TIMESTAMP AS bucket, arg_min(price, exchange_ts) AS open, max(price) AS high, min(price) AS low, arg_max(price, exchange_ts) AS close, CAST(sum(quantity) AS BIGINT) AS volume, count(*) AS tick_count FROM ticks GROUP BY 1, 2"""))
def ohlcv_1w(spark, sf_dir):
    """Weekly candles, from Monday."""
    return candles.ohlcv(V.ticks(spark, sf_dir), "1W").select("symbol", "bucket", "open", "high", "low", "close", "volume", "tick_count")


_RESAMPLE = """SELECT symbol, time_bucket(INTERVAL '{w}', bucket) AS bucket, arg_min(open, bucket) AS open, max(high) AS high, min(low) AS low, arg_max(close, bucket) AS close, CAST(sum(volume) AS BIGINT) AS volume FROM {bars} GROUP BY 1, 2"""
_BARS = "SELECT symbol, time_bucket(INTERVAL '1 minute', exchange_ts) AS bucket, arg_min(price, exchange_ts) AS open, max(price) AS high, min(price) AS low, arg_max(price, exchange_ts) AS close, CAST(sum(quantity) AS BIGINT) AS volume, CAST(sum(CASE WHEN side = 1 THEN quantity ELSE 0 END) AS BIGINT) AS buy_vol, CAST(sum(CASE WHEN side = 2 THEN quantity ELSE 0 END) AS BIGINT) AS sell_vol, count(*) AS tick_count FROM ticks GROUP BY 1, 2"


@query(V.with_views(("ticks",), _RESAMPLE.format(w="1 hour", bars="bars"), bars=_BARS))
def ohlcv_resample_1h(spark, sf_dir):
    """A3: hours from minutes."""
    bars = candles.ohlcv(V.ticks(spark, sf_dir))
    return candles.resample(bars, "1 hour").select("symbol", "bucket", "open", "high", "low", "close", "volume")


_LIVE_EDGE, _LIVE_FROM, _LIVE_TO = "2024-01-15 12:00:00", "2024-01-10 07:07:00", "2024-01-20 00:00:00"


@query(V.with_views(("ticks",), f"SELECT * FROM ({_RESAMPLE.format(w='15 minutes', bars='merged')}) WHERE bucket >= TIMESTAMP '2024-01-10 07:00:00' AND bucket <= TIMESTAMP '{_LIVE_TO}'",
    bars=_BARS, stored=f"SELECT * FROM bars WHERE bucket < TIMESTAMP '{_LIVE_EDGE}'", edge="SELECT symbol, max(bucket) + INTERVAL 1 MINUTE AS frontier FROM stored GROUP BY symbol",
    live=f"SELECT symbol, time_bucket(INTERVAL '1 minute', exchange_ts) AS bucket, arg_min(price, exchange_ts) AS open, max(price) AS high, min(price) AS low, arg_max(price, exchange_ts) AS close, CAST(sum(quantity) AS BIGINT) AS volume FROM ticks LEFT JOIN edge USING (symbol) WHERE (frontier IS NULL OR exchange_ts >= frontier) AND exchange_ts <= TIMESTAMP '{_LIVE_TO}' GROUP BY 1, 2",
    merged="SELECT symbol, bucket, open, high, low, close, volume FROM stored UNION ALL SELECT * FROM live"))
def ohlcv_live(spark, sf_dir):
    """Stored bars up to the frontier and live ones after it."""
    t = V.ticks(spark, sf_dir)
    stored = candles.ohlcv(t).filter(F.col("bucket") < _at(_LIVE_EDGE))
    return candles.ohlcv_live(stored, t, "15 minutes", _at(_LIVE_FROM), _at(_LIVE_TO)).select("symbol", "bucket", "open", "high", "low", "close", "volume")


@query(V.with_views(("ticks",), "SELECT symbol, max(bucket) + INTERVAL 1 MINUTE AS frontier FROM bars GROUP BY symbol", bars=_BARS))
def bar_frontier(spark, sf_dir):
    """A5: where stored bars end."""
    return candles.frontier(candles.ohlcv(V.ticks(spark, sf_dir)))


@query(V.with_views(("index_snaps",), "SELECT index_name, time_bucket(INTERVAL '1 hour', exchange_ts) AS bucket, arg_min(value, exchange_ts) AS open, max(value) AS high, min(value) AS low, arg_max(value, exchange_ts) AS close, max(total_volume) - min(total_volume) AS volume, arg_max(up_count, exchange_ts) AS up_count, avg(up_count) AS avg_latency_ms FROM index_snaps GROUP BY 1, 2"))
def index_ohlc_1h(spark, sf_dir):
    """A2: index candles with the rise of cumulative volume."""
    return candles.index_ohlc(V.index_snaps(spark, sf_dir), "1 hour", turnover=None, breadth=("up_count",))


@query(V.with_views(("index_snaps",), "SELECT index_name, bucket, top - coalesce(lag(top) OVER (PARTITION BY index_name, CAST(bucket + INTERVAL 7 HOUR AS DATE) ORDER BY bucket), 0) AS volume FROM (SELECT index_name, time_bucket(INTERVAL '1 hour', exchange_ts) AS bucket, max(total_volume) AS top FROM index_snaps GROUP BY 1, 2)"))
def index_volume_exact(spark, sf_dir):
    """Q10: volumes with the rise between buckets."""
    return candles.index_volume_exact(V.index_snaps(spark, sf_dir), "1 hour")


@query(V.with_views(("ticks",), f"SELECT symbol, CAST(sum(volume) AS BIGINT) AS volume, max(high) AS high, min(low) AS low, CAST(sum(tick_count) AS BIGINT) AS tick_count FROM bars WHERE bucket + INTERVAL 7 HOUR >= date_trunc('day', TIMESTAMP '{AS_OF}' + INTERVAL 7 HOUR) AND bucket <= TIMESTAMP '{AS_OF}' GROUP BY symbol", bars=_BARS))
def day_stats(spark, sf_dir):
    """Since local midnight."""
    return candles.day_stats(candles.ohlcv(V.ticks(spark, sf_dir)), _at(AS_OF))


@query(V.with_views(("ticks",), "SELECT symbol, bucket, buy_vol, sell_vol FROM bars", bars=_BARS))
def volume_by_side(spark, sf_dir):
    """A8."""
    return candles.volume_by_side(candles.ohlcv(V.ticks(spark, sf_dir)))


@query(V.with_views(("quotes",), "SELECT symbol, arg_max({'v': bid_price1}, exchange_ts).v AS bid_price1, arg_max(ask_price1, exchange_ts) AS ask_price1, max(exchange_ts) AS quote_ts, price, quantity, side, trade_ts FROM quotes JOIN t USING (symbol) GROUP BY symbol, price, quantity, side, trade_ts",
    t="SELECT symbol, arg_max(price, exchange_ts) AS price, arg_max(quantity, exchange_ts) AS quantity, arg_max(side, exchange_ts) AS side, max(exchange_ts) AS trade_ts FROM ticks GROUP BY symbol"))
def latest_board(spark, sf_dir):
    """Newest quote and trade of each symbol."""
    return candles.latest_board(V.quotes(spark, sf_dir), V.ticks(spark, sf_dir))


@query(V.with_views(("uticks",), "SELECT DISTINCT symbol FROM uticks"))
def symbol_list(spark, sf_dir):
    """L5."""
    return candles.symbols(V.ticks(spark, sf_dir, by_user=True))


# Sessions, calendar, gap filling

_PHASE = """CASE WHEN isodow({l}) > 5 THEN 'CLOSED' WHEN epoch({l} - date_trunc('day', {l})) // 1 BETWEEN 32400 AND 41400 THEN 'AM' WHEN epoch({l} - date_trunc('day', {l})) // 1 BETWEEN 46800 AND 53100 THEN 'PM' ELSE 'CLOSED' END""".format(l="(exchange_ts + INTERVAL 7 HOUR)")


@query(V.with_views(("ticks",), f"SELECT {_PHASE} AS phase, CAST(exchange_ts + INTERVAL 7 HOUR AS DATE) AS day, count(*) AS n FROM ticks GROUP BY 1, 2"))
def session_phase_counts(spark, sf_dir):
    """Ticks by session phase and market day."""
    return V.ticks(spark, sf_dir).groupBy(T.session_phase("exchange_ts").alias("phase"), T.trading_date("exchange_ts").alias("day")).agg(F.count("*").alias("n"))


@query(V.with_views(("ticks",), "SELECT event_id, date_trunc('day', exchange_ts + INTERVAL 7 HOUR) + CASE WHEN hour(exchange_ts + INTERVAL 7 HOUR) >= 13 THEN INTERVAL 6 HOUR ELSE INTERVAL 2 HOUR END AS session_start, date_trunc('day', exchange_ts + INTERVAL 7 HOUR) + INTERVAL 2 HOUR AS replay_start FROM ticks"))
def session_starts(spark, sf_dir):
    """P18, S7."""
    return V.ticks(spark, sf_dir).select("event_id", T.session_start("exchange_ts").alias("session_start"), T.replay_start("exchange_ts").alias("replay_start"))


_SPINE = "SELECT symbol, CAST(d AS DATE) AS trading_date, d + to_minutes(m) - INTERVAL 7 HOUR AS time FROM (SELECT DISTINCT symbol FROM minute_bars) CROSS JOIN (SELECT DISTINCT date_trunc('day', time + INTERVAL 7 HOUR) AS d FROM minute_bars WHERE CAST(time + INTERVAL 7 HOUR AS DATE) IN (SELECT trading_date FROM calendar)) CROSS JOIN (SELECT m FROM range(555, 630) r(m) UNION ALL SELECT m FROM range(780, 870) r(m) UNION ALL SELECT 885)"
_FILL = "SELECT symbol, time, coalesce(open, carried) AS open, coalesce(high, carried) AS high, coalesce(low, carried) AS low, coalesce(close, carried) AS close, coalesce(volume, 0) AS volume, 'STOCK' AS bar_type, open IS NULL AS is_filled, trading_date FROM (SELECT *, last_value(close IGNORE NULLS) OVER (PARTITION BY symbol, trading_date ORDER BY time) AS carried FROM spine LEFT JOIN minute_bars USING (symbol, time))"


@query(V.with_views(("minute_bars", "calendar"), _FILL, spine=_SPINE))
def gap_fill_1m(spark, sf_dir):
    """Candles on the trading-minute spine."""
    bars = V.candles_by_minute(spark, sf_dir)
    return silver.gap_fill(bars, V.calendar(spark, sf_dir), bars)


@query(V.with_views(("minute_bars", "calendar"), f"SELECT symbol, trading_date, count(*) AS n, count(*) FILTER (is_filled) AS n_filled, count(*) FILTER (close IS NULL) AS n_head FROM ({_FILL}) GROUP BY ALL", spine=_SPINE))
def gap_fill_null_head(spark, sf_dir):
    """Q4: unknown prices before a day's first candle."""
    bars = V.candles_by_minute(spark, sf_dir)
    filled = silver.gap_fill(bars, V.calendar(spark, sf_dir), bars)
    return filled.groupBy("symbol", "trading_date").agg(F.count("*").alias("n"), F.count_if("is_filled").alias("n_filled"), F.count_if(F.col("close").isNull()).alias("n_head"))


@query(V.with_views(("ticks", "calendar"), "SELECT symbol, day AS time, open, high, low, close, volume, 'STOCK' AS bar_type, false AS is_filled, CAST(day AS DATE) AS trading_date, '1D' AS resolution, CAST(CAST(day AS DATE) AS VARCHAR) AS date FROM (SELECT symbol, date_trunc('day', exchange_ts) AS day, arg_min(price, exchange_ts) AS open, max(price) AS high, min(price) AS low, arg_max(price, exchange_ts) AS close, CAST(sum(quantity) AS BIGINT) AS volume FROM ticks GROUP BY 1, 2) WHERE CAST(day AS DATE) IN (SELECT trading_date FROM calendar)"))
def silver_1d(spark, sf_dir):
    """Daily candles with their kind, on trading days."""
    daily = candles.ohlcv(V.ticks(spark, sf_dir), "1D", tz="UTC").withColumnRenamed("bucket", "time").withColumn("resolution", F.lit("1D"))
    return silver.silver(daily, V.calendar(spark, sf_dir), resolution="1D", tz="UTC")


@query(V.with_views(("calendar", "ticks"), "SELECT event_id FROM ticks WHERE CAST(exchange_ts + INTERVAL 7 HOUR AS DATE) IN (SELECT trading_date FROM calendar)"))
def on_trading_days(spark, sf_dir):
    """J12."""
    return calendar.on_trading_days(V.ticks(spark, sf_dir), V.calendar(spark, sf_dir)).select("event_id")


@query(V.with_views(("calendar",), "SELECT CAST(d AS DATE) AS date, (SELECT max(trading_date) FROM calendar WHERE trading_date < CAST(d AS DATE)) AS previous_date FROM (SELECT DISTINCT date_trunc('day', ts) AS d FROM events)"))
def prev_trading_date(spark, sf_dir):
    """J13."""
    days = V.table(spark, sf_dir, "events").select(F.to_date("ts").alias("date")).distinct()
    return calendar.previous_trading_date(days, V.calendar(spark, sf_dir))


@query(V.with_views(("calendar",), "SELECT d::DATE AS trading_date FROM generate_series(DATE '2023-12-20', DATE '2024-01-25', INTERVAL 1 DAY) g(d) WHERE CASE WHEN d::DATE < (SELECT min(trading_date) FROM calendar) THEN isodow(d) < 6 ELSE d::DATE IN (SELECT trading_date FROM calendar) END"))
def trading_dates(spark, sf_dir):
    """Weekdays before the calendar begins, its own days after."""
    return calendar.trading_dates(V.calendar(spark, sf_dir), _day("2023-12-20"), _day("2024-01-25"))


@query(V.with_views(("calendar",), "SELECT count(*) AS n_days, min(trading_date) AS first_day, max(trading_date) AS last_day FROM calendar"))
def calendar_summary(spark, sf_dir):
    """A13."""
    return calendar.summary(V.calendar(spark, sf_dir))


@query("WITH r AS (SELECT event_type AS symbol, min(ts) AS range_start, max(ts) AS range_end FROM events GROUP BY 1) SELECT symbol, range_start, range_end, chunk_start, least(chunk_start + INTERVAL 5 DAY, range_end) AS chunk_end FROM (SELECT *, unnest(generate_series(range_start, range_end, INTERVAL 5 DAY)) AS chunk_start FROM r) WHERE chunk_start < range_end")
def time_chunks(spark, sf_dir):
    """W8."""
    r = V.table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("symbol")).agg(F.min("ts").alias("range_start"), F.max("ts").alias("range_end"))
    return calendar.time_chunks(r, 5)


# Quality

@query(V.with_views(("bands", "ticks"), "SELECT event_id, t.symbol, price, ceiling_price, floor_price FROM ticks t JOIN bands b ON t.symbol = b.symbol AND CAST(exchange_ts AS DATE) = day WHERE price > ceiling_price OR price < floor_price"))
def price_band_anomaly(spark, sf_dir):
    """J2."""
    t = V.ticks(spark, sf_dir).withColumn("day", F.to_date("exchange_ts"))
    return quality.price_band_anomalies(t, V.bands(spark, sf_dir), ["symbol", "day"]).select("event_id", "symbol", "price", "ceiling_price", "floor_price")


@query(V.with_views(("quotes",), "SELECT count(*) FILTER (bid_price1 >= ask_price1) AS crossed, count(*) FILTER (bid_price1 IS NULL OR ask_price1 IS NULL) AS one_sided, count(*) FILTER (bid_price1 <= 0 OR ask_price1 <= 0) AS not_positive, count(*) AS n FROM quotes"))
def spread_sanity(spark, sf_dir):
    """A10, Q7."""
    return quality.spread_sanity(V.quotes(spark, sf_dir))


@query(V.with_views(("quotes",), "SELECT event_id, round(ask_price1 - bid_price1, 4) AS spread FROM quotes WHERE bid_price1 > 0 AND ask_price1 - bid_price1 < 0"))
def negative_spread(spark, sf_dir):
    """The live check."""
    return N.with_spread(quality.negative_spreads(V.quotes(spark, sf_dir))).select("event_id", F.round("spread", 4).alias("spread"))


@query(V.with_views(("ticks",), "SELECT CAST(exchange_ts + INTERVAL 7 HOUR AS DATE) AS day, count(*) AS n, count(*) < 340 AS too_few FROM ticks GROUP BY 1"))
def row_count_check(spark, sf_dir):
    """A9."""
    return quality.row_counts(V.ticks(spark, sf_dir), 340)


_INSIDE = "isodow(exchange_ts + INTERVAL 7 HOUR) < 6 AND (hour(exchange_ts + INTERVAL 7 HOUR) BETWEEN 9 AND 11 OR hour(exchange_ts + INTERVAL 7 HOUR) BETWEEN 13 AND 14)"
_GAPS = "SELECT exchange_ts AS gap_end, lag(exchange_ts) OVER ({w} ORDER BY exchange_ts) AS gap_start, {k} FROM ticks WHERE " + _INSIDE


@query(V.with_views(("ticks",), f"SELECT gap_start, gap_end, (epoch_us(gap_end) - epoch_us(gap_start)) / 1000000 AS gap_s FROM ({_GAPS.format(w='', k='1')}) WHERE epoch_us(gap_end) - epoch_us(gap_start) > 600000000 ORDER BY gap_s DESC, gap_start LIMIT 10"))
def tick_gaps(spark, sf_dir):
    """The ten largest gaps over all symbols."""
    return quality.largest_gaps(quality.market_gaps(V.ticks(spark, sf_dir)))


@query(V.with_views(("ticks",), "SELECT symbol, day, session, gap_start, gap_end, (epoch_us(gap_end) - epoch_us(gap_start)) / 1000000 AS gap_s FROM (" + _GAPS.format(w="PARTITION BY symbol, CAST(exchange_ts + INTERVAL 7 HOUR AS DATE), hour(exchange_ts + INTERVAL 7 HOUR) < 12", k="symbol, CAST(exchange_ts + INTERVAL 7 HOUR AS DATE) AS day, CASE WHEN hour(exchange_ts + INTERVAL 7 HOUR) < 12 THEN 'AM' ELSE 'PM' END AS session") + ") WHERE epoch_us(gap_end) - epoch_us(gap_start) > 600000000"))
def tick_gaps_by_session(spark, sf_dir):
    """Gaps of each symbol within a session."""
    return quality.tick_gaps(V.ticks(spark, sf_dir), by_session=True, keys=["symbol"])


@query(V.with_views(("ticks", "quotes"), f"""SELECT "table", last_ts, round((epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(last_ts)) / 60000000, 1) AS gap_minutes, threshold_minutes, (epoch_us(TIMESTAMP '{AS_OF}') - greatest(epoch_us(last_ts), epoch_us(TIMESTAMP '2024-01-16 02:00:00'))) / 60000000 > threshold_minutes AS is_stale FROM
 (SELECT 'trade' AS "table", max(exchange_ts) AS last_ts, 3 AS threshold_minutes FROM ticks WHERE exchange_ts <= TIMESTAMP '{AS_OF}' UNION ALL SELECT 'quote', max(exchange_ts), 5 FROM quotes WHERE exchange_ts <= TIMESTAMP '{AS_OF}')"""))
def freshness(spark, sf_dir):
    """A11."""
    seen = lambda df: df.filter(F.col("exchange_ts") <= _at(AS_OF))
    return quality.freshness({"trade": seen(V.ticks(spark, sf_dir)), "quote": seen(V.quotes(spark, sf_dir))}, _at(AS_OF))


@query(V.with_views(("uticks",), "SELECT symbol, count(*) AS n, min(exchange_ts) AS first_ts, max(exchange_ts) AS last_ts FROM uticks GROUP BY symbol"))
def coverage(spark, sf_dir):
    """A12."""
    return quality.coverage(V.ticks(spark, sf_dir, by_user=True))


@query(V.with_views(("quotes", "bands"), "SELECT category, count(*) AS n FROM (SELECT 'spread' AS category FROM quotes WHERE bid_price1 > 0 AND ask_price1 - bid_price1 < 0 UNION ALL SELECT 'band' FROM ticks t JOIN bands b ON t.symbol = b.symbol AND CAST(exchange_ts AS DATE) = day WHERE price > ceiling_price OR price < floor_price) GROUP BY 1"))
def quality_report(spark, sf_dir):
    """A24."""
    return quality.report_counts(quality.report(spread=negative_spread(spark, sf_dir), band=price_band_anomaly(spark, sf_dir)))


@query(V.with_views(("bands", "ticks"), f"SELECT symbol, event_id, exchange_ts, rank, n_new, next_mark, greatest(n_new - 5, 0) AS not_shown FROM (SELECT t.symbol, event_id, exchange_ts, CAST(row_number() OVER (PARTITION BY t.symbol ORDER BY exchange_ts) AS INTEGER) AS rank, count(*) OVER (PARTITION BY t.symbol) AS n_new, max(exchange_ts) OVER (PARTITION BY t.symbol) AS next_mark FROM ticks t JOIN bands b ON t.symbol = b.symbol AND CAST(exchange_ts AS DATE) = day WHERE (price > ceiling_price OR price < floor_price) AND exchange_ts > TIMESTAMP '{AS_OF}') WHERE rank <= 5"))
def new_anomalies(spark, sf_dir):
    """L4, T8 in batch: the first five after the high-water mark."""
    t = V.ticks(spark, sf_dir).withColumn("day", F.to_date("exchange_ts"))
    found = quality.price_band_anomalies(t, V.bands(spark, sf_dir), ["symbol", "day"]).select("symbol", "event_id", "exchange_ts")
    marks = found.select("symbol").distinct().withColumn("last_ts", _at(AS_OF))
    return quality.new_anomalies(found, marks, ["symbol"])


@query(" UNION ALL ".join(f"SELECT '{n}' AS \"table\", 1 AS n_files, count(*) AS n_rows, true AS readable FROM {n}" for n in ("events", "orders", "lineitem")))
def table_health(spark, sf_dir):
    """Files and rows of tables, each of which is one file here."""
    return quality.table_health({n: V.table(spark, sf_dir, n) for n in ("events", "orders", "lineitem")})


# Deduplication

@query(V.with_views(("dup_trades",), "SELECT event_id, copy FROM (SELECT *, row_number() OVER (PARTITION BY symbol, epoch_us(exchange_ts) // 1000, round(price, 4), quantity, side ORDER BY event_id, copy) AS rn FROM dup_trades) i WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM ticks s WHERE s.event_id % 6 = 0 AND s.symbol = i.symbol AND epoch_us(s.exchange_ts) // 1000 = epoch_us(i.exchange_ts) // 1000 AND round(s.price, 4) = round(i.price, 4) AND s.quantity = i.quantity AND s.side = i.side)"))
def dedup_trades(spark, sf_dir):
    """Incoming trades against stored ones."""
    incoming = V.dup_trades(spark, sf_dir)
    stored = V.ticks(spark, sf_dir).filter("event_id % 6 = 0")
    return dedup.new_rows(incoming, stored, dedup.trade_fingerprint(), ["event_id", "copy"]).select("event_id", "copy")


@query(V.with_views(("quotes",), "SELECT event_id FROM (SELECT *, row_number() OVER (PARTITION BY symbol, date_trunc('second', exchange_ts), bid_price1, k ORDER BY event_id) AS rn FROM (SELECT symbol, date_trunc('day', exchange_ts) AS exchange_ts, CASE WHEN k % 17 <> 0 THEN round(price, 4) END AS bid_price1, k % 10 AS k, event_id FROM ticks)) WHERE rn = 1"))
def dedup_quotes_null(spark, sf_dir):
    """Missing prices equal each other."""
    t = V.ticks(spark, sf_dir)
    q = t.select("symbol", F.date_trunc("day", "exchange_ts").cast("timestamp_ntz").alias("exchange_ts"), F.when(F.col("k") % 17 != 0, F.col("price")).alias("bid_price1"), (F.col("k") % 10).cast("double").alias("ask_price1"), "event_id")
    return dedup.first_occurrences(q, dedup.quote_fingerprint(), ["event_id"]).select("event_id")


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem EXCEPT SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_returnflag = 'R') GROUP BY ALL")
def dedup_bars(spark, sf_dir):
    """Keyed rows that are not stored yet."""
    rows = V.table(spark, sf_dir, "lineitem")
    keys = ("l_orderkey", "l_linenumber")
    fresh = dedup.new_bars(rows, rows.filter("l_returnflag = 'R'"), keys)
    return fresh.groupBy(*keys).agg(F.count("*").alias("n"))


@query("SELECT o_custkey, o_orderkey, o_orderdate FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1")
def latest_per_key(spark, sf_dir):
    """The last row of each key."""
    return dedup.latest_per_key(V.table(spark, sf_dir, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey", "o_orderdate")


@query(V.with_views(("counters",), "SELECT symbol, ts, value, event_id, previous FROM (SELECT *, lag(value) OVER (PARTITION BY symbol ORDER BY ts) AS previous FROM counters) WHERE value < previous"))
def counter_resets(spark, sf_dir):
    """W6, T6 in batch."""
    return dedup.counter_resets(V.counters(spark, sf_dir), ["symbol"], ["ts"], "value")


# Instruments

@query(V.with_views(("instruments", "secdef"), "SELECT s.symbol, s.market_id, board_id, trading_date, is_active, index_name FROM secdef s JOIN instruments i ON s.symbol = i.symbol AND s.market_id = i.market_id"))
def secdef_with_master(spark, sf_dir):
    """J1."""
    return instruments.with_secdef(V.secdef(spark, sf_dir), V.instruments(spark, sf_dir)).select("symbol", "market_id", "board_id", "trading_date", F.col("im_is_active").alias("is_active"), F.col("im_index_name").alias("index_name"))


@query(V.with_views(("instruments", "secdef"), "SELECT DISTINCT symbol FROM secdef WHERE symbol NOT IN (SELECT symbol FROM instruments)"))
def unknown_symbols(spark, sf_dir):
    """J3."""
    return instruments.unknown_symbols(V.secdef(spark, sf_dir), V.instruments(spark, sf_dir))


@query(V.with_views(("instruments", "secdef"), f"SELECT symbol, market_id FROM instruments WHERE (final_trade_date IS NULL OR final_trade_date >= DATE '{DAY}') AND (symbol, market_id) NOT IN (SELECT (symbol, market_id) FROM secdef WHERE trading_date = DATE '{DAY}')"))
def missing_from_secdef(spark, sf_dir):
    """J4."""
    return instruments.missing_from_secdef(V.instruments(spark, sf_dir), V.secdef(spark, sf_dir), _day(DAY)).select("symbol", "market_id")


@query(V.with_views(("instruments", "secdef"), "SELECT i.symbol, coalesce(i.final_trade_date, s.f) AS final_trade_date, i.final_trade_date IS NULL AND s.f IS NOT NULL AS changed FROM instruments i LEFT JOIN (SELECT symbol, market_id, arg_max(final_trade_date, trading_date) AS f FROM secdef WHERE final_trade_date IS NOT NULL GROUP BY 1, 2) s ON s.symbol = i.symbol AND s.market_id = i.market_id"))
def enrich_expiry(spark, sf_dir):
    """J6."""
    return instruments.fill_expiry(V.instruments(spark, sf_dir), V.secdef(spark, sf_dir)).select("symbol", "final_trade_date", "changed")


@query(V.with_views(("instruments", "secdef"), "SELECT coalesce(s.symbol, i.symbol) AS symbol, coalesce(s.market_id, i.market_id) AS market_id, CASE WHEN s.symbol IS NULL THEN i.final_trade_date ELSE coalesce(s.final_trade_date, i.final_trade_date) END AS final_trade_date, CASE WHEN s.symbol IS NULL THEN i.is_active ELSE true END AS is_active FROM instruments i FULL JOIN (SELECT * FROM secdef QUALIFY row_number() OVER (PARTITION BY symbol, market_id ORDER BY trading_date DESC) = 1) s ON s.symbol = i.symbol AND s.market_id = i.market_id"))
def upsert_instruments(spark, sf_dir):
    """New rows in, an old expiry kept where the new one is missing."""
    master = V.instruments(spark, sf_dir).withColumn("last_synced_ts", F.lit(None).cast("timestamp_ntz"))
    incoming = V.secdef(spark, sf_dir)
    return instruments.upsert_instruments(master, incoming, ["trading_date"], _at(AS_OF)).select("symbol", "market_id", "final_trade_date", "is_active")


@query(V.with_views(("instruments", "secdef"), "SELECT symbol, market_id FROM instruments UNION SELECT symbol, market_id FROM secdef"))
def insert_if_absent(spark, sf_dir):
    """Do nothing on a known key."""
    return instruments.insert_if_absent(V.instruments(spark, sf_dir).select("symbol", "market_id"), V.secdef(spark, sf_dir).select("symbol", "market_id"), ["symbol", "market_id"])


@query(V.with_views(("instruments", "secdef"), "SELECT symbol, is_active AND symbol NOT IN (SELECT symbol FROM secdef) AS is_active, is_active AND symbol IN (SELECT symbol FROM secdef) AS changed FROM instruments"))
def set_inactive(spark, sf_dir):
    """J9."""
    return instruments.set_active(V.instruments(spark, sf_dir), V.secdef(spark, sf_dir), False).select("symbol", "is_active", "changed")


_DELTA = f"""SELECT symbol, 'new' AS action FROM (SELECT symbol FROM secdef EXCEPT SELECT symbol FROM instruments) UNION ALL
 SELECT symbol, 'reactivate' FROM (SELECT symbol FROM secdef WHERE trading_date = DATE '{DAY}' INTERSECT SELECT symbol FROM instruments WHERE NOT is_active) UNION ALL
 SELECT symbol, 'deactivate' FROM (SELECT symbol FROM instruments WHERE is_active AND market_id IN ('STO', 'STX', 'DVX') EXCEPT SELECT symbol FROM secdef WHERE trading_date = DATE '{DAY}') WHERE (SELECT count(DISTINCT symbol) FROM secdef WHERE trading_date = DATE '{DAY}') >= {{n}}"""


@query(V.with_views(("instruments", "secdef"), _DELTA.format(n=200)))
def instrument_delta(spark, sf_dir):
    """U2, U5."""
    return instruments.instrument_delta(V.instruments(spark, sf_dir), V.secdef(spark, sf_dir), _day(DAY))


@query(V.with_views(("instruments", "secdef"), _DELTA.format(n=100_000_000)))
def instrument_delta_guard(spark, sf_dir):
    """Too few symbols on the day."""
    return instruments.instrument_delta(V.instruments(spark, sf_dir), V.secdef(spark, sf_dir), _day(DAY), least=100_000_000)


@query(V.with_views(("instruments", "secdef"), f"SELECT action, count(*) AS n FROM ({_DELTA.format(n=200)}) GROUP BY 1"))
def delta_summary(spark, sf_dir):
    """Counts of a delta."""
    return instruments.delta_summary(instrument_delta(spark, sf_dir))


@query(V.with_views(("instruments", "secdef"), f"SELECT symbol, CASE a WHEN 'new' THEN true WHEN 'reactivate' THEN true WHEN 'deactivate' THEN false ELSE is_active END AS is_active FROM (SELECT coalesce(i.symbol, d.symbol) AS symbol, i.is_active, d.action AS a FROM instruments i FULL JOIN ({_DELTA.format(n=200)}) d ON d.symbol = i.symbol)"))
def apply_delta(spark, sf_dir):
    """The master after a delta."""
    master = V.instruments(spark, sf_dir).withColumn("last_synced_ts", F.lit(None).cast("timestamp_ntz"))
    s = V.secdef(spark, sf_dir)
    delta = instruments.instrument_delta(master, s, _day(DAY))
    none = master.limit(0)
    return instruments.apply_delta(master, delta, none, s, _at(AS_OF)).select("symbol", "is_active")


@query(V.with_views(("instruments", "secdef"), f"SELECT DISTINCT s.symbol FROM secdef s JOIN instruments i ON s.symbol = i.symbol AND s.market_id = i.market_id WHERE trading_date = DATE '{DAY}' AND board_id = 'G1' AND security_status = 'OPEN' AND is_active AND (security_group_id IN ('BUILDING') OR regexp_matches(index_name, '(^|,)VN30(,|$)'))"))
def universe(spark, sf_dir):
    """P19."""
    return instruments.universe(V.secdef(spark, sf_dir), V.instruments(spark, sf_dir), _day(DAY), boards=["G1"], statuses=["OPEN"], groups=["BUILDING"], indexes=["VN30"])


@query(V.with_views(("instruments",), "SELECT DISTINCT symbol FROM instruments WHERE is_active AND regexp_matches(index_name, '(^|,)VN100(,|$)')"))
def index_members(spark, sf_dir):
    """P22."""
    return instruments.index_members(V.instruments(spark, sf_dir), "VN100")


@query(V.with_views(("instruments",), f"SELECT DISTINCT symbol FROM instruments WHERE market_id IN ('STO', 'DVX') AND (final_trade_date IS NULL OR final_trade_date >= DATE '{DAY}') ORDER BY symbol LIMIT 1950"))
def priority_symbols(spark, sf_dir):
    """P23."""
    return instruments.priority_symbols(V.instruments(spark, sf_dir), ["STO", "DVX"], _day(DAY))


@query(V.with_views(("instruments",), "SELECT symbol FROM instruments WHERE is_active UNION SELECT unnest(['VN30F1M', 'VN30F2M', 'VN30F1Q', 'VN30F2Q', 'V100F1M', 'V100F2M', 'V100F1Q', 'V100F2Q'])"))
def end_of_day_universe(spark, sf_dir):
    """P21."""
    return instruments.end_of_day_universe(V.instruments(spark, sf_dir))


@query(V.with_views(("instruments", "secdef"), f"SELECT symbol FROM secdef WHERE trading_date = DATE '{DAY}' EXCEPT SELECT symbol FROM secdef WHERE trading_date <> DATE '{DAY}'"))
def universe_additions(spark, sf_dir):
    """J19, U5."""
    s = V.secdef(spark, sf_dir)
    return instruments.additions(s.filter(F.col("trading_date") == _day(DAY)), s.filter(F.col("trading_date") != _day(DAY)))


@query(V.with_views(("instruments",), "SELECT market_id, is_active, count(DISTINCT symbol) AS n FROM instruments GROUP BY 1, 2"))
def symbol_set_sizes(spark, sf_dir):
    """Distinct symbols by market and state."""
    return V.instruments(spark, sf_dir).groupBy("market_id", "is_active").agg(F.countDistinct("symbol").alias("n"))


@query(V.with_views(("instruments", "secdef"), f"SELECT (SELECT count(*) FROM instruments WHERE is_active) AS active_instruments, (SELECT count(*) FROM secdef WHERE trading_date = DATE '{DAY}') AS secdef_today"))
def active_counts(spark, sf_dir):
    """A15."""
    return ops_metrics.active_counts(V.instruments(spark, sf_dir), V.secdef(spark, sf_dir), _day(DAY))


@query(V.with_views(("instruments",), "SELECT CASE WHEN security_group_id = 'BUILDING' THEN 'INDEX' WHEN market_id = 'DVX' THEN 'DERIVATIVE' ELSE 'STOCK' END AS kind, count(*) AS n FROM instruments GROUP BY 1"))
def instrument_kinds(spark, sf_dir):
    """P15."""
    name = F.when(F.col("security_group_id") == "BUILDING", " vnindex ").when(F.col("market_id") == "DVX", F.concat(F.lit("41i1"), "symbol")).otherwise(F.col("symbol"))
    return V.instruments(spark, sf_dir).groupBy(N.classify_instrument(name).alias("kind")).agg(F.count("*").alias("n"))


# Futures

_ROLL = """SELECT family, CAST(d AS DATE) AS day, 'F' || rn || 'M' AS code, symbol FROM alive WHERE rn <= 2
 UNION ALL SELECT family, CAST(d AS DATE), 'F' || q || 'Q', symbol FROM (SELECT *, row_number() OVER (PARTITION BY family, d ORDER BY expiry, symbol) AS q FROM (SELECT *, max(CASE WHEN rn = 2 THEN expiry END) OVER (PARTITION BY family, d) AS f2 FROM alive) WHERE month(expiry) IN (3, 6, 9, 12) AND expiry > f2) WHERE q <= 2"""
_ALIVE = "SELECT *, row_number() OVER (PARTITION BY family, d ORDER BY expiry, symbol) AS rn FROM contracts JOIN generate_series(DATE '1997-01-01', DATE '1997-12-31', INTERVAL 1 DAY) g(d) ON expiry >= CAST(d AS DATE)"


@query(V.with_views(("contracts",), _ROLL, alive=_ALIVE))
def futures_roll_daily(spark, sf_dir):
    """J16, W7."""
    return futures.roll_daily(V.contracts(spark, sf_dir), _day("1997-01-01"), _day("1997-12-31"), ("family",))


@query(V.with_views(("contracts",), "SELECT family, code, symbol, greatest(min(day)::TIMESTAMP - INTERVAL 7 HOUR, TIMESTAMP '1997-01-15') AS valid_from, max(day)::TIMESTAMP + INTERVAL 17 HOUR - INTERVAL 1 MICROSECOND AS valid_to FROM (SELECT *, day - CAST(row_number() OVER (PARTITION BY family, code, symbol ORDER BY day) AS INTEGER) AS island FROM rolled) GROUP BY family, code, symbol, island HAVING max(day)::TIMESTAMP + INTERVAL 17 HOUR > TIMESTAMP '1997-01-15 00:00:00.000001'", alive=_ALIVE, rolled=_ROLL))
def futures_roll_intervals(spark, sf_dir):
    """Runs of equal mapping, clipped."""
    daily = futures.roll_daily(V.contracts(spark, sf_dir), _day("1997-01-01"), _day("1997-12-31"), ("family",))
    return futures.roll_intervals(daily, start=_at("1997-01-15 00:00:00"), keys=("family",))


@query(V.with_views(("contracts",), "SELECT o_orderkey, code, symbol FROM orders JOIN spans ON o_orderdate BETWEEN valid_from AND valid_to AND substr(symbol, 10, 9)::INT = o_custkey", alive=_ALIVE, rolled=_ROLL, spans="SELECT family, code, symbol, min(day)::TIMESTAMP - INTERVAL 7 HOUR AS valid_from, max(day)::TIMESTAMP + INTERVAL 17 HOUR - INTERVAL 1 MICROSECOND AS valid_to FROM (SELECT *, day - CAST(row_number() OVER (PARTITION BY family, code, symbol ORDER BY day) AS INTEGER) AS island FROM rolled) GROUP BY family, code, symbol, island"))
def futures_attach(spark, sf_dir):
    """Ticks with the code that held at their time."""
    daily = futures.roll_daily(V.contracts(spark, sf_dir), _day("1997-01-01"), _day("1997-12-31"), ("family",))
    names = V.instruments(spark, sf_dir).select("symbol", F.col("id").alias("o_custkey"))
    ticks = V.table(spark, sf_dir, "orders").join(names, "o_custkey")
    return futures.attach_contracts(ticks, futures.roll_intervals(daily, keys=("family",)), ts="o_orderdate").select("o_orderkey", "code", "symbol")


# Normalizing

@query("SELECT event_id, CASE WHEN event_type IN ('view', 'click') THEN 1 WHEN event_type IN ('error', 'login') THEN 2 ELSE 0 END AS side FROM events")
def normalize_side(spark, sf_dir):
    """P2."""
    raw = F.when(F.col("event_type") == "view", " buy ").when(F.col("event_type") == "click", "b").when(F.col("event_type") == "error", "2").when(F.col("event_type") == "login", "Sell").otherwise(F.col("event_type"))
    return V.table(spark, sf_dir, "events").select("event_id", N.normalize_side(raw).alias("side"))


@query(V.with_views(("quotes",), "SELECT event_id, bid_levels[1].price AS bid_price1, bid_levels[2].price AS bid_price2, bid_levels[3].price AS bid_price3, bid_levels[1].qtty AS bid_qty1, bid_levels[3].qtty AS bid_qty3 FROM quotes"))
def depth_levels(spark, sf_dir):
    """Levels past the book's end are null."""
    level = lambda i, f: N.depth_level("bid_levels", i, f)
    return V.quotes(spark, sf_dir).select("event_id", *(level(i, "price").alias(f"bid_price{i + 1}") for i in range(3)), level(0, "qtty").alias("bid_qty1"), level(2, "qtty").alias("bid_qty3"))


@query(V.with_views(("ticks",), "SELECT symbol, board_id, count(*) AS n, sum(CASE WHEN price IS NULL THEN 1 ELSE 0 END)::BIGINT AS no_price, min(date_trunc('millisecond', exchange_ts)) AS first_ts, count(DISTINCT side) AS sides FROM ticks WHERE board_id = 'G1' GROUP BY 1, 2"))
def normalize_trades(spark, sf_dir):
    """Raw records to canonical ones, of the regular board."""
    raw = V.ticks(spark, sf_dir).select("symbol", F.col("board_id").alias("boardId"), F.lit("").alias("marketId"), "price", "quantity", F.when(F.col("side") == 1, "BUY").otherwise("s").alias("side"), (F.unix_millis(F.col("exchange_ts").cast("timestamp")) / 1000).alias("time"))
    canonical = N.filter_boards(N.normalize_trades(raw), ["G1"]).filter("market_id = 'UNKNOWN'")
    return canonical.groupBy("symbol", "board_id").agg(F.count("*").alias("n"), F.count_if(F.col("price").isNull()).alias("no_price"), F.min(F.col("exchange_ts").cast("timestamp_ntz")).alias("first_ts"), F.countDistinct("side").alias("sides"))


@query(V.with_views(("ticks",), "SELECT event_id, date_trunc('millisecond', exchange_ts - INTERVAL 7 HOUR) AS exchange_ts, CAST(CAST(exchange_ts AS DATE) AS VARCHAR) AS date FROM ticks WHERE k % 9 <> 0"))
def normalize_rest_times(spark, sf_dir):
    """Local times with and without a fraction; bad ones are dropped."""
    text = F.when(F.col("k") % 9 == 0, "2024-13-45").when(F.col("k") % 2 == 0, F.date_format("exchange_ts", "yyyy-MM-dd HH:mm:ss.SSS")).otherwise(F.date_format("exchange_ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    ts = N.parse_local_time(text)
    timed = V.ticks(spark, sf_dir).select("event_id", ts.alias("at")).filter("at IS NOT NULL")
    return timed.select("event_id", F.col("at").cast("timestamp_ntz").alias("exchange_ts"), T.partition_stamp("at").alias("date"))


@query("SELECT o_orderkey, CAST(o_totalprice AS DOUBLE) AS ceiling_price, CAST(o_orderdate AS DATE) AS listing_date FROM orders WHERE o_orderkey % 3 <> 0")
def normalize_secdef(spark, sf_dir):
    """Tolerant numbers and dates, rows need their key."""
    o = V.table(spark, sf_dir, "orders")
    raw = o.select(F.col("o_orderkey").cast("string").alias("symbol"), F.when(F.col("o_orderkey") % 3 != 0, "STO").otherwise("").alias("marketId"), F.lit("G1").alias("boardId"), F.col("o_totalprice").cast("string").alias("ceilingPrice"), F.lit("n/a").alias("floorPrice"), F.when(F.col("o_orderkey") % 2 == 0, F.date_format("o_orderdate", "yyyyMMdd")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("listingDate"))
    return N.normalize_secdef(raw, _day(DAY), ["G1"]).filter("floor_price IS NULL").select(F.col("symbol").cast("bigint").alias("o_orderkey"), "ceiling_price", "listing_date")


@query(V.with_views(("ticks",), "SELECT symbol, bucket AS time, open, high, low, close, volume FROM bars", bars=_BARS))
def ohlc_arrays_to_rows(spark, sf_dir):
    """Candle pages of arrays to rows."""
    bars = candles.ohlcv(V.ticks(spark, sf_dir))
    row = F.struct(F.unix_seconds(F.col("bucket").cast("timestamp")).alias("t"), "open", "high", "low", "close", "volume")
    page = bars.groupBy("symbol", F.to_date("bucket").alias("resolution")).agg(F.collect_list(row).alias("r")).select("symbol", F.col("resolution").cast("string").alias("resolution"), *(F.col(f"r.{s}").alias(d) for s, d in (("t", "t"), ("open", "o"), ("high", "h"), ("low", "l"), ("close", "c"), ("volume", "v"))))
    return readers.candle_arrays(page).select("symbol", F.col("time").cast("timestamp_ntz").alias("time"), "open", "high", "low", "close", "volume")


@query(V.with_views(("ticks",), f"SELECT event_id FROM ticks WHERE exchange_ts >= TIMESTAMP '2024-01-16 02:00:00' AND exchange_ts <= TIMESTAMP '{AS_OF}'"))
def session_replay(spark, sf_dir):
    """Ticks since the market day's start."""
    return readers.since_session_start(V.ticks(spark, sf_dir), _at(AS_OF)).select("event_id")


@query(V.with_views(("ticks",), "SELECT canonical, count(*) AS n FROM (SELECT CASE k % 8 WHEN 0 THEN '1min' WHEN 1 THEN '1H' WHEN 2 THEN '1D' WHEN 3 THEN '1W' WHEN 4 THEN '5min' WHEN 5 THEN '1H' WHEN 6 THEN '15min' ELSE '30min' END AS canonical FROM ticks) GROUP BY 1"))
def resolution_names(spark, sf_dir):
    """P16."""
    raw = F.element_at(F.array(*map(F.lit, ("1", "60", "d", "W", "5min", "1h", "15", "30"))), F.col("k") % 8 + 1)
    return V.ticks(spark, sf_dir).groupBy(T.normalize_resolution(raw).alias("canonical")).agg(F.count("*").alias("n"))


@query(V.with_views(("ticks",), "SELECT symbol, max(k) AS max_ms, avg(k) AS avg_ms FROM ticks GROUP BY 1"))
def latency(spark, sf_dir):
    """P26."""
    ms = T.latency_ms("gateway_ts", "exchange_ts")
    return V.ticks(spark, sf_dir).groupBy("symbol").agg(F.max(ms).cast("int").alias("max_ms"), F.avg(ms).alias("avg_ms"))


@query(V.with_views(("index_snaps",), "SELECT index_name, date_trunc('second', exchange_ts) AS exchange_ts, value, NULL::DOUBLE AS changed_value, total_volume, up_count FROM index_snaps"))
def normalize_index(spark, sf_dir):
    """Tolerant numbers of index records."""
    s = V.index_snaps(spark, sf_dir)
    raw = s.select(F.col("index_name").alias("indexName"), F.unix_seconds(F.col("exchange_ts").cast("timestamp")).alias("transactTime"), F.col("value").cast("string").alias("valueIndexes"), F.lit("n/a").alias("changedValue"), F.col("total_volume").cast("string").alias("totalVolumeTraded"), F.col("up_count").cast("string").alias("fluctuationUpIssueCount"))
    return N.normalize_index(raw).select("index_name", F.col("exchange_ts").cast("timestamp_ntz").alias("exchange_ts"), "value", "changed_value", "total_volume", "up_count")


@query(V.with_views(("ticks",), "SELECT symbol, CAST(sum(quantity) AS BIGINT) AS sell_volume, 0::BIGINT AS n_buy, min(date_trunc('second', exchange_ts)) AS producer_ts FROM ticks GROUP BY 1"))
def normalize_foreign(spark, sf_dir):
    """P5."""
    raw = V.ticks(spark, sf_dir).select("symbol", F.col("quantity").cast("string").alias("sellVolume"), F.lit("none").alias("buyVolume"), F.unix_seconds(F.col("exchange_ts").cast("timestamp")).alias("receivedAt"))
    return N.normalize_foreign(raw).groupBy("symbol").agg(F.sum("sell_volume").alias("sell_volume"), F.count("buy_volume").alias("n_buy"), F.min(F.col("producer_ts").cast("timestamp_ntz")).alias("producer_ts"))


@query(V.with_views(("ticks",), "SELECT symbol, max(price) AS expected_price, CAST(max(quantity) AS BIGINT) AS expected_qty, count(*) AS n FROM ticks GROUP BY 1"))
def normalize_expected_price(spark, sf_dir):
    """P6."""
    raw = V.ticks(spark, sf_dir).select("symbol", F.col("price").alias("expectedTradePrice"), F.col("quantity").cast("string").alias("expectedTradeQuantity"), F.lit(1704160800.0).alias("receivedAt"))
    return N.normalize_expected_price(raw).groupBy("symbol").agg(F.max("expected_price").alias("expected_price"), F.max("expected_qty").alias("expected_qty"), F.count("producer_ts").alias("n"))


@query(V.with_views(("quotes",), "SELECT event_id, bid_levels[1].price AS bid_price1, bid_levels[2].qtty AS bid_qty2, NULL::DOUBLE AS ask_price1, NULL::DOUBLE AS spread, len(bid_levels) AS depth FROM quotes"))
def normalize_quotes(spark, sf_dir):
    """Books flattened to levels; a missing side has none."""
    level = lambda x: F.struct(x["price"].alias("price"), x["qtty"].alias("quantity"))
    raw = V.quotes(spark, sf_dir).select(F.col("event_id").cast("string").alias("symbol"), F.transform("bid_levels", level).alias("bid"), F.lit(None).cast("array<struct<price:double,quantity:int>>").alias("offer"))
    return N.normalize_quotes(raw).select(F.col("symbol").cast("bigint").alias("event_id"), "bid_price1", "bid_qty2", "ask_price1", "spread", F.size("bid_levels").cast("bigint").alias("depth"))


@query(V.with_views(("instruments",), "SELECT symbol, market_id, index_name, CAST(final_trade_date AS VARCHAR) AS final_trade_date FROM instruments WHERE id % 10 <> 0"))
def normalize_instruments(spark, sf_dir):
    """Lists of indexes to comma lists; rows without a key are dropped."""
    raw = V.instruments(spark, sf_dir).select(F.when(F.col("id") % 10 != 0, F.col("symbol")).alias("symbol"), F.col("market_id").alias("marketId"), F.split("index_name", ",").alias("indexName"), F.date_format("final_trade_date", "yyyyMMdd").alias("finalTradeDate"))
    return N.normalize_instruments(raw).select("symbol", "market_id", "index_name", F.col("final_trade_date").cast("string").alias("final_trade_date"))


@query(V.with_views(("ticks",), "SELECT event_id, CASE WHEN k % 2 = 0 THEN CAST(quantity AS DOUBLE) WHEN k % 3 = 0 THEN price END AS value FROM ticks"))
def unwrap_union(spark, sf_dir):
    """The member of a tagged union that is set."""
    u = V.ticks(spark, sf_dir).select("event_id", F.struct(F.when(F.col("k") % 2 == 0, F.col("quantity")).alias("i"), F.when((F.col("k") % 2 != 0) & (F.col("k") % 3 == 0), F.col("price")).alias("d")).alias("u"))
    return u.select("event_id", N.unwrap_union(F.col("u.i").cast("double"), F.col("u.d")).alias("value"))


@query(V.with_views(("instruments", "secdef"), "SELECT symbol, market_id FROM instruments WHERE symbol IN (SELECT symbol FROM secdef) UNION ALL SELECT symbol, arg_max(market_id, (trading_date, market_id, board_id)) FROM secdef WHERE symbol NOT IN (SELECT symbol FROM instruments) GROUP BY symbol"))
def fallback_rows(spark, sf_dir):
    """Rows from the master, and from the newest definition for what it lacks."""
    s = V.secdef(spark, sf_dir)
    return instruments.fallback_rows(s, V.instruments(spark, sf_dir).select("symbol", "market_id"), s)


@query(V.with_views(("ticks",), "SELECT symbol, CAST(coalesce(max(CASE WHEN side = 1 THEN CAST(exchange_ts AS DATE) END), max(CASE WHEN k < 90 THEN CAST(exchange_ts AS DATE) END), DATE '2024-02-01') AS VARCHAR) AS final_trade_date FROM coded WHERE symbol NOT IN (SELECT symbol FROM coded WHERE event_id % 500 = 0) GROUP BY 1",
    coded="SELECT '41I1F' || lpad(CAST(user_id AS VARCHAR), 4, '0') AS symbol, side, k, exchange_ts, event_id FROM ticks JOIN (SELECT event_id, user_id FROM events) USING (event_id)"))
def register_contracts(spark, sf_dir):
    """Missing contracts with the day of their last trade, else quote, else the range's end."""
    users = V.table(spark, sf_dir, "events").select("event_id", F.concat(F.lit("41I1F"), F.lpad(F.col("user_id").cast("string"), 4, "0")).alias("symbol"))
    coded = V.ticks(spark, sf_dir).drop("symbol").join(users, "event_id")
    known = coded.filter("event_id % 500 = 0").select("symbol").distinct()
    master = known.select("symbol", F.lit("DVX").alias("market_id"), F.lit("FU").alias("security_group_id"), _day("2024-01-01").alias("final_trade_date"), F.lit(True).alias("is_active"))
    out = instruments.register_contracts(master, coded, coded.filter("side = 1"), coded.filter("k < 90"), F.lit("2024-02-01"))
    return out.filter(~F.col("is_active")).select("symbol", F.col("final_trade_date").cast("string").alias("final_trade_date"))


@query(V.with_views(("calendar",), "SELECT len(list(trading_date)) AS n, CAST(min(trading_date) AS VARCHAR) AS first_in_range, (SELECT CAST(min(trading_date) AS VARCHAR) FROM calendar) AS first_day FROM calendar WHERE trading_date BETWEEN DATE '2024-01-08' AND DATE '2024-01-20'"))
def days_within(spark, sf_dir):
    """The days of a range as a list."""
    one = calendar.days_within(V.calendar(spark, sf_dir), _day("2024-01-08"), _day("2024-01-20"))
    return one.select(F.size("days").cast("bigint").alias("n"), F.element_at("days", 1).cast("string").alias("first_in_range"), F.col("first_day").cast("string").alias("first_day"))


@query(V.with_views(("counters",), "SELECT event_id, CASE WHEN p IS NULL THEN NULL WHEN value < p THEN value ELSE value - p END AS increase FROM (SELECT *, lag(value) OVER (PARTITION BY symbol ORDER BY ts) AS p FROM counters)"))
def counter_increase(spark, sf_dir):
    """The rise since the sample before."""
    return ops_metrics.counter_increase(V.counters(spark, sf_dir), ("symbol",)).select("event_id", "increase")


# Operations

_NOW = "1998-01-01 00:00:00"


@query(V.with_views(("run_history",), f"SELECT dag_id, state, count(*) AS n, max(end_date) AS last_end, {_quotient('sum(epoch_us(end_date) - epoch_us(start_date))', 'count(end_date) * 1000000', 1)} AS avg_s FROM run_history WHERE start_date >= TIMESTAMP '{_NOW}' - INTERVAL 24 HOUR AND start_date <= TIMESTAMP '{_NOW}' GROUP BY 1, 2"))
def run_history_24h(spark, sf_dir):
    """A16."""
    return ops_metrics.run_history(V.run_history(spark, sf_dir), _at(_NOW))


@query(V.with_views(("run_history",), f"SELECT dag_id, task_id, state, count(*) AS n, {_quotient('sum(epoch_us(end_date) - epoch_us(start_date))', 'count(end_date) * 60000000', 2)} AS avg_min, {_quotient('max(epoch_us(end_date) - epoch_us(start_date))', '60000000', 2)} AS max_min FROM run_history WHERE start_date >= TIMESTAMP '{_NOW}' - INTERVAL 7 DAY AND start_date <= TIMESTAMP '{_NOW}' GROUP BY 1, 2, 3"))
def task_history(spark, sf_dir):
    """A17."""
    return ops_metrics.task_history(V.run_history(spark, sf_dir), _at(_NOW))


@query(V.with_views(("run_history",), f"SELECT dag_id, date_trunc('hour', start_date)::TIMESTAMP AS hour, {_quotient('sum(epoch_us(end_date) - epoch_us(start_date))', 'count(end_date) * 1000000', 1)} AS avg_s FROM run_history WHERE state = 'F' GROUP BY 1, 2"))
def hourly_duration(spark, sf_dir):
    """A18."""
    return ops_metrics.hourly_duration(V.run_history(spark, sf_dir), "F")


@query(V.with_views(("run_history",), f"SELECT count(*) AS n FROM run_history WHERE state = 'F' AND CAST(start_date + INTERVAL 7 HOUR AS DATE) = CAST(TIMESTAMP '{_NOW}' + INTERVAL 7 HOUR AS DATE)"))
def runs_today(spark, sf_dir):
    """A19."""
    return ops_metrics.runs_on_day(V.run_history(spark, sf_dir), _at(_NOW), "F")


@query("SELECT o_custkey AS job_id, o_orderstatus AS last_run_status FROM (SELECT c_custkey FROM customer) LEFT JOIN (SELECT o_custkey, arg_max(o_orderstatus, o_orderkey) AS o_orderstatus FROM orders GROUP BY 1) ON c_custkey = o_custkey WHERE o_orderstatus IS NULL OR o_orderstatus <> 'F'".replace("SELECT o_custkey AS job_id", "SELECT c_custkey AS job_id", 1))
def failing_jobs(spark, sf_dir):
    """Jobs whose last run did not succeed, or that never ran."""
    jobs = V.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("job_id"))
    stats = V.table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("job_id")).agg(F.max_by("o_orderstatus", "o_orderkey").alias("s"))
    stats = stats.select("job_id", F.when(F.col("s") == "F", "Success").otherwise(F.col("s")).alias("last_run_status"), F.lit(0).alias("total_failures"))
    return ops_metrics.failing_jobs(jobs, stats).select("job_id", "last_run_status")


@query(V.with_views(("counters",), "SELECT event_id, round(coalesce(sum(increase) OVER (PARTITION BY symbol ORDER BY epoch_us(ts) RANGE BETWEEN 3600000000 PRECEDING AND CURRENT ROW), 0) / 3600, 6) AS rate FROM (SELECT *, CASE WHEN p IS NULL THEN NULL WHEN value < p THEN value ELSE value - p END AS increase FROM (SELECT *, lag(value) OVER (PARTITION BY symbol ORDER BY ts) AS p FROM counters))"))
def counter_rate(spark, sf_dir):
    """Rate a second over an hour, with resets."""
    return ops_metrics.counter_rate(V.counters(spark, sf_dir), ("symbol",), 3600).select("event_id", F.round("rate", 6).alias("rate"))


@query("SELECT o_orderpriority AS topic, CAST(sum(greatest(0, o_custkey - o_orderkey // 7)) AS BIGINT) AS lag FROM orders GROUP BY 1")
def lag_rollup(spark, sf_dir):
    """A21."""
    o = V.table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("topic"), F.col("o_custkey").alias("end_offset"), F.expr("o_orderkey div 7").alias("committed_offset"))
    return ops_metrics.consumer_lag(o, ("topic",))


@query(V.with_views(("ticks",), f"SELECT ts, service_name, label, metric_name, metric_value FROM (SELECT time_bucket(INTERVAL '1 hour', exchange_ts) AS ts, symbol AS service_name, board_id AS label, {_quotient('sum(quantity)', 'greatest(sum(k), 1)', 4)} AS msg_rate, sum(CASE WHEN k > 90 THEN 1 ELSE 0 END)::DOUBLE AS error_count FROM ticks GROUP BY 1, 2, 3) UNPIVOT (metric_value FOR metric_name IN (msg_rate, error_count))"))
def service_metrics(spark, sf_dir):
    """Metric rows of each window."""
    t = V.ticks(spark, sf_dir).select(F.col("exchange_ts").alias("ts"), F.col("symbol").alias("service_name"), F.col("board_id").alias("label"), F.col("quantity").alias("messages"), F.when(F.col("k") > 90, 1).otherwise(0).alias("errors"), F.lit(None).cast("int").alias("reconnects"), F.lit(None).cast("int").alias("lag"), F.col("k").alias("elapsed_s"))
    return ops_metrics.service_metrics(t, window="1 hour").select("ts", "service_name", "label", "metric_name", "metric_value")


@query("SELECT l_returnflag AS resolution, CAST(sum(l_linenumber) AS BIGINT) AS fetched, CAST(sum(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS inserted, list_sort(list_distinct(list(l_linestatus) FILTER (l_quantity > 49)))::VARCHAR[] AS failed FROM lineitem GROUP BY 1".replace("list_sort(list_distinct(list(l_linestatus) FILTER (l_quantity > 49)))::VARCHAR[]", "array_to_string(list_sort(list_distinct(list(l_linestatus) FILTER (l_quantity > 49))), ',')"))
def run_totals(spark, sf_dir):
    """A23."""
    r = V.table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("resolution"), F.col("l_linenumber").alias("fetched"), F.when(F.col("l_linestatus") == "F", 1).otherwise(0).alias("inserted"), F.lit(0).alias("skipped"), F.when(F.col("l_quantity") > 49, "failed").otherwise("ok").alias("status"), F.col("l_linestatus").alias("symbol"))
    return ops_metrics.run_totals(r).select("resolution", "fetched", "inserted", F.array_join("failed", ",").alias("failed"))


@query(V.with_views(("ticks",), "SELECT event_id FROM ticks WHERE exchange_ts >= TIMESTAMP '2024-01-30' - INTERVAL 7 DAY"))
def retention_prune(spark, sf_dir):
    """K10."""
    return sinks.prune(V.ticks(spark, sf_dir), 7, _at("2024-01-30 00:00:00")).select("event_id")


@query("SELECT o_orderkey, target FROM (SELECT o_orderkey, o_orderdate, CASE WHEN o_orderstatus = 'F' THEN 'hot' ELSE 'cold' END AS target FROM orders) WHERE o_orderdate >= TIMESTAMP '1998-01-01' - CASE target WHEN 'hot' THEN INTERVAL 30 DAY ELSE INTERVAL 90 DAY END")
def within_retention(spark, sf_dir):
    """P25."""
    r = V.table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").alias("range_start"), F.when(F.col("o_orderstatus") == "F", "hot").otherwise("cold").alias("target"))
    policy = spark.createDataFrame([("hot", 30), ("cold", 90)], "target string, keep_days int")
    return ops_metrics.within_retention(r, policy, _at(_NOW)).select("o_orderkey", "target")


@query("SELECT symbol, range_start, range_end, resume_token, last_page FROM (SELECT 'C' || o_custkey AS symbol, o_orderdate AS range_start, o_orderdate + INTERVAL 1 DAY AS range_end, arg_max('t' || l_linenumber, l_linenumber) AS resume_token, max(l_linenumber) AS last_page, bool_or(l_linenumber >= 5) AS done FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL) WHERE NOT coalesce(done, false)")
def pending_ranges(spark, sf_dir):
    """What is left to do, and where to resume."""
    ranges = V.table(spark, sf_dir, "orders").select("o_orderkey", F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("symbol"), F.col("o_orderdate").alias("range_start"), (F.col("o_orderdate") + F.expr("INTERVAL 1 DAY")).alias("range_end"))
    ledger = ranges.join(V.table(spark, sf_dir, "lineitem"), F.col("l_orderkey") == F.col("o_orderkey")).select("symbol", "range_start", "range_end", F.col("l_linenumber").alias("page"), F.concat(F.lit("t"), F.col("l_linenumber").cast("string")).alias("next_token"), (F.col("l_linenumber") >= 5).alias("done"))
    return sinks.pending(ranges.drop("o_orderkey").distinct(), ledger, ("symbol", "range_start", "range_end"))


_STEPS = """SELECT key, ts, event FROM walk WHERE event IS NOT NULL"""
_CHECKS = """SELECT symbol AS key, exchange_ts AS ts, k < 50 AS firing, row_number() OVER (PARTITION BY symbol ORDER BY exchange_ts, k < 50) AS n FROM ticks"""
_WALK = """SELECT key, n, ts, firing AS active, CAST(NULL AS TIMESTAMP) AS recovered, CASE WHEN firing THEN 'FIRE' END AS event FROM checks WHERE n = 1
 UNION ALL SELECT c.key, c.n, c.ts, CASE WHEN c.firing THEN true WHEN w.active AND (w.recovered IS NULL OR c.ts - w.recovered >= INTERVAL 300 SECOND) THEN false ELSE w.active END,
 CASE WHEN NOT c.firing AND w.active AND (w.recovered IS NULL OR c.ts - w.recovered >= INTERVAL 300 SECOND) THEN c.ts ELSE w.recovered END,
 CASE WHEN c.firing AND NOT w.active THEN 'FIRE' WHEN NOT c.firing AND w.active AND (w.recovered IS NULL OR c.ts - w.recovered >= INTERVAL 300 SECOND) THEN 'RECOVER' END
 FROM walk w JOIN checks c ON c.key = w.key AND c.n = w.n + 1"""


@query(V.with_views(("ticks",), _STEPS, checks=_CHECKS, walk=_WALK).replace("WITH ", "WITH RECURSIVE ", 1))
def alert_transitions(spark, sf_dir):
    """T7 in batch: a state machine over each symbol's checks."""
    t = V.ticks(spark, sf_dir).select(F.col("symbol").alias("key"), F.col("exchange_ts").alias("ts"), (F.col("k") < 50).alias("firing"))
    return quality.alert_transitions(t, ["key"])


#: Date columns of results, which are shown as text so that engines print them alike.
_DATES = {
    "session_phase_counts": ("day",), "gap_fill_1m": ("trading_date",), "gap_fill_null_head": ("trading_date",), "silver_1d": ("trading_date",), "prev_trading_date": ("date", "previous_date"), "trading_dates": ("trading_date",),
    "calendar_summary": ("first_day", "last_day"), "row_count_check": ("day",), "tick_gaps_by_session": ("day",), "secdef_with_master": ("trading_date",), "enrich_expiry": ("final_trade_date",), "upsert_instruments": ("final_trade_date",),
    "futures_roll_daily": ("day",), "normalize_secdef": ("listing_date",),
}


def _with_text_dates(f: Query, names: tuple[str, ...]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return f(spark, sf_dir).withColumns({n: F.col(n).cast("string") for n in names})

    run.__name__, run.__doc__, run.__wrapped__ = f.__name__, f.__doc__, f
    return run


for _name, _columns in _DATES.items():
    _run, _sql = _FOUND[_name]
    _FOUND[_name] = (_with_text_dates(_run, _columns), f"SELECT * REPLACE ({', '.join(f'CAST({c} AS VARCHAR) AS {c}' for c in _columns)}) FROM ({_sql})")
