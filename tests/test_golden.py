"""Small hand-made cases of the semantics that matter."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions import normalize as N
from tidemark.functions import time as T
from tidemark.operators import calendar, candles, dedup, futures, instruments, ops_metrics, quality, silver


def ts(text):
    return dt.datetime.fromisoformat(text)


def day(text):
    return dt.date.fromisoformat(text)


def bars(spark, rows):
    return spark.createDataFrame([(s, ts(t), p, p, p, p, 10) for s, t, p in rows], "symbol string, time timestamp_ntz, open double, high double, low double, close double, volume bigint")


@pytest.mark.parametrize(("symbol", "n"), [("VN30F1M", 181), ("ABC", 166), (" vnindex ", 166)])
def test_minutes_of_a_day(spark, symbol, n):
    days = spark.createDataFrame([(day("2024-01-02"),)], "trading_date date")
    rows = bars(spark, [(symbol, "2024-01-02 02:00:00", 1.0)])
    assert silver.gap_fill(rows, days, rows).count() == n


def test_leading_gap_stays_null_and_off_spine_is_dropped(spark):
    days = spark.createDataFrame([(day("2024-01-02"),)], "trading_date date")
    rows = bars(spark, [("ABC", "2024-01-02 03:00:00", 5.0), ("ABC", "2024-01-02 07:40:00", 9.0)])
    out = silver.gap_fill(rows, days, rows).orderBy("time").collect()
    assert [r.close for r in out[:45]] == [None] * 45 and all(r.is_filled and r.volume == 0 for r in out[:45])
    assert out[45].close == 5.0 and not out[45].is_filled and out[-1].close == 5.0  # 14:40 local is off the spine


def test_two_bars_for_a_minute_and_a_symbol_without_bars(spark):
    days = spark.createDataFrame([(day("2024-01-02"),), (day("2024-01-03"),)], "trading_date date")
    rows = bars(spark, [("ABC", "2024-01-02 03:00:00", 5.0), ("ABC", "2024-01-02 03:00:00", 6.0)])
    wanted = spark.createDataFrame([("ABC",), ("XYZ",)], "symbol string")
    out = silver.gap_fill(rows, days, wanted)
    assert out.count() == 2 * 166  # the day without any candle gives none
    assert out.filter("symbol = 'XYZ' AND close IS NOT NULL").count() == 0


def test_full_derivative_day_is_not_filled(spark):
    days = spark.createDataFrame([(day("2024-01-02"),)], "trading_date date")
    times = silver.trading_minutes(days, "DERIVATIVE").withColumn("symbol", F.lit("VN30F2401"))
    full = times.select("symbol", "time", *(F.lit(1.0).alias(c) for c in ("open", "high", "low", "close")), F.lit(1).cast("bigint").alias("volume"))
    assert silver.gap_fill(full, days, full).filter("is_filled").count() == 0


def test_resample_equals_direct(spark):
    rows = [("A", ts("2024-01-02 02:00:00") + dt.timedelta(seconds=37 * i), float(i % 17), i % 5 + 1, i % 3) for i in range(400)]
    t = spark.createDataFrame(rows, "symbol string, exchange_ts timestamp_ntz, price double, quantity int, side int")
    direct = candles.ohlcv(t, "15 minutes", gateway=None)
    two = candles.resample(candles.ohlcv(t, gateway=None), "15 minutes")
    columns = ["symbol", "bucket", "open", "high", "low", "close", "volume"]
    assert sorted(direct.select(*columns).collect()) == sorted(two.select(*columns).collect())
    assert candles.resample(candles.ohlcv(t, gateway=None), "7 parsecs").count() == candles.ohlcv(t, gateway=None).count()


def test_ties_take_the_given_order(spark):
    t = spark.createDataFrame([("A", ts("2024-01-02 02:00:00"), float(i), 1, 1, i) for i in (3, 1, 2)], "symbol string, exchange_ts timestamp_ntz, price double, quantity int, side int, event_id int")
    r = candles.ohlcv(t, gateway=None, tie=("event_id",)).first()
    assert (r.open, r.close) == (1.0, 3.0)


def test_null_at_the_extreme_time_is_kept(spark):
    s = spark.createDataFrame([("X", ts("2024-01-02 02:00:00"), None, 5), ("X", ts("2024-01-02 02:00:05"), 7.0, 9)], "index_name string, exchange_ts timestamp_ntz, value double, total_volume bigint")
    r = candles.index_ohlc(s, turnover=None, breadth=(), gateway=None).first()
    assert r.open is None and r.close == 7.0 and r.volume == 4


def contracts(spark, *expiries):
    return spark.createDataFrame([(f"C{e}", day(e)) for e in expiries], "symbol string, expiry date")


def test_roll_on_and_after_expiry(spark):
    c = contracts(spark, "2024-01-18", "2024-02-15", "2024-03-21", "2024-06-20", "2024-09-19")
    got = {(r.day.isoformat(), r.code): r.symbol for r in futures.roll_daily(c, F.lit("2024-01-18"), F.lit("2024-01-19")).collect()}
    assert got["2024-01-18", "F1M"] == "C2024-01-18" and got["2024-01-19", "F1M"] == "C2024-02-15"
    assert got["2024-01-18", "F1Q"] == "C2024-03-21"
    assert got["2024-01-19", "F2M"] == "C2024-03-21" and got["2024-01-19", "F1Q"] == "C2024-06-20" and got["2024-01-19", "F2Q"] == "C2024-09-19"


def test_unmapped_days_split_an_interval_and_clip(spark):
    daily = spark.createDataFrame([(day("2024-01-01"), "F1M", "A"), (day("2024-01-02"), "F1M", "A"), (day("2024-01-04"), "F1M", "A")], "day date, code string, symbol string")
    out = futures.roll_intervals(daily, start=F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")).orderBy("valid_from").collect()
    assert [r.valid_from for r in out] == [ts("2024-01-01 00:00:00"), ts("2024-01-03 17:00:00")]
    assert out[0].valid_to == ts("2024-01-02 16:59:59.999999")


def test_null_prices_make_one_fingerprint(spark):
    rows = [("A", ts("2024-01-02 02:00:00.000100"), None, None, 1), ("A", ts("2024-01-02 02:00:00.000900"), None, None, 2)]
    q = spark.createDataFrame(rows, "symbol string, exchange_ts timestamp_ntz, bid_price1 double, ask_price1 double, n int")
    once = dedup.first_occurrences(q, dedup.quote_fingerprint(), ["n"])
    assert [r.n for r in once.collect()] == [1]
    assert dedup.new_rows(q, once, dedup.quote_fingerprint(), ["n"]).count() == 0
    assert dedup.first_occurrences(once, dedup.quote_fingerprint(), ["n"]).count() == 1


def secdef(spark, symbols, at="2024-01-02"):
    return spark.createDataFrame([(s, "STO", day(at)) for s in symbols], "symbol string, market_id string, trading_date date")


def master(spark, rows):
    return spark.createDataFrame(rows, "symbol string, market_id string, is_active boolean, final_trade_date date")


@pytest.mark.parametrize(("n", "gone"), [(199, 0), (200, 1)])
def test_guard_against_mass_deactivation(spark, n, gone):
    m = master(spark, [("OLD", "STO", True, None), ("UP", "UPX", True, None)])
    delta = instruments.instrument_delta(m, secdef(spark, [f"S{i}" for i in range(n)]), F.lit("2024-01-02").cast("date"))
    got = {r.action: r.n for r in instruments.delta_summary(delta).collect()}
    assert got.get("deactivate", 0) == gone and got["new"] == n  # the UPX symbol is never deactivated


def test_first_run_gives_no_delta(spark):
    assert instruments.instrument_delta(master(spark, []), secdef(spark, ["A"]), F.lit("2024-01-02").cast("date")).count() == 0


def test_upsert_keeps_an_old_expiry_and_replaces_the_rest(spark):
    old = spark.createDataFrame([("A", "STO", "Old", day("2024-03-01"), True, None), ("B", "STO", "B", None, False, None)], "symbol string, market_id string, full_name string, final_trade_date date, is_active boolean, last_synced_ts timestamp_ntz")
    new = spark.createDataFrame([("A", "STO", "x", None, 1), ("A", "STO", None, None, 2), ("C", "STO", "C", None, 1)], "symbol string, market_id string, full_name string, final_trade_date date, n int")
    now = F.lit("2024-01-02 00:00:00").cast("timestamp_ntz")
    got = {r.symbol: r for r in instruments.upsert_instruments(old, new, ["n"], now).collect()}
    assert got["A"].full_name is None and got["A"].final_trade_date == day("2024-03-01")
    assert got["C"].is_active and not got["B"].is_active
    again = instruments.upsert_instruments(instruments.upsert_instruments(old, new, ["n"], now), new, ["n"], now)
    assert again.count() == 3


def test_whole_items_of_a_comma_list(spark):
    m = spark.createDataFrame([("A", "VN30,VN100", True), ("B", "VN300", True), ("C", None, True), ("D", "HNX, VN30", True)], "symbol string, index_name string, is_active boolean")
    assert [r.symbol for r in instruments.index_members(m, "VN30").collect()] == ["A", "D"]


def test_missing_contract_is_registered_once(spark):
    m = spark.createDataFrame([("41I1F1000", "DVX", "FU", day("2024-01-18"), True)], "symbol string, market_id string, security_group_id string, final_trade_date date, is_active boolean")
    wanted = spark.createDataFrame([("41I1F1000",), ("41I1F2000",), ("SHORT",)], "symbol string")
    none = spark.createDataFrame([], "symbol string, exchange_ts timestamp_ntz")
    t = spark.createDataFrame([("41I1F2000", ts("2024-02-14 03:00:00"))], "symbol string, exchange_ts timestamp_ntz")
    got = {r.symbol: r for r in instruments.register_contracts(m, wanted, t, none, F.lit("2024-03-01")).collect()}
    assert set(got) == {"41I1F1000", "41I1F2000"} and got["41I1F2000"].final_trade_date == day("2024-02-14") and not got["41I1F2000"].is_active


def test_sessions_end_to_the_microsecond(spark):
    """Local times are seven hours later; 2024-01-16 is a Tuesday, 2024-01-20 a Saturday."""
    cases = {
        "2024-01-16 01:59:59.999999": "CLOSED", "2024-01-16 02:00:00": "AM", "2024-01-16 04:30:00": "AM", "2024-01-16 04:30:00.000001": "CLOSED", "2024-01-16 04:30:00.445115": "CLOSED",
        "2024-01-16 05:59:59.999999": "CLOSED", "2024-01-16 06:00:00": "PM", "2024-01-16 07:45:00": "PM", "2024-01-16 07:45:00.921999": "CLOSED", "2024-01-20 03:00:00": "CLOSED",
    }
    rows = spark.createDataFrame([(t,) for t in cases], "t string").withColumn("at", F.col("t").cast("timestamp_ntz"))
    assert {r.t: r.p for r in rows.select("t", T.session_phase("at").alias("p")).collect()} == cases
    monitored = spark.createDataFrame([("2024-01-16 08:15:00",), ("2024-01-16 08:15:00.5",)], "t string").select("t", T.is_monitored_time(F.col("t").cast("timestamp_ntz")).alias("m"))
    assert [r.m for r in monitored.orderBy("t").collect()] == [True, False]


def test_counter_reset(spark):
    c = spark.createDataFrame([("A", i, v) for i, v in enumerate((10, 15, 12, 20))], "symbol string, i int, v int")
    assert [r.v for r in dedup.counter_resets(c, ["symbol"], ["i"], "v").collect()] == [12]
    assert dedup.counter_resets(c, ["symbol"], ["i"], "v", max_jump=7).count() == 2


def test_counter_rate_after_a_reset(spark):
    c = spark.createDataFrame([("A", ts("2024-01-01 00:00:00") + dt.timedelta(seconds=i), v) for i, v in enumerate((10, 20, 3))], "symbol string, ts timestamp_ntz, value bigint")
    assert [round(r.rate, 3) for r in ops_metrics.counter_rate(c, ("symbol",), 10).orderBy("ts").collect()] == [0.0, 1.0, 1.3]


def test_alert_cooldown(spark):
    checks = [(0, True), (1, True), (2, False), (3, True), (4, False), (6, False), (7, False)]
    s = spark.createDataFrame([("k", ts("2024-01-01 00:00:00") + dt.timedelta(minutes=m), f) for m, f in checks], "key string, ts timestamp_ntz, firing boolean")
    got = [(r.ts.minute, r.event) for r in quality.alert_transitions(s, ["key"]).orderBy("ts").collect()]
    assert got == [(0, "FIRE"), (2, "RECOVER"), (3, "FIRE"), (7, "RECOVER")]


def test_freshness_clamps_and_excuses_auctions(spark):
    rows = lambda *t: spark.createDataFrame([(ts(x),) for x in t], "exchange_ts timestamp_ntz")
    at = lambda text: F.lit(text).cast("timestamp_ntz")
    old, none = rows("2024-01-01 08:00:00"), rows()
    got = {r.table: r for r in quality.freshness({"trade": old, "quote": old}, at("2024-01-02 02:04:00")).collect()}
    assert not got["quote"].is_stale and not got["trade"].is_stale and got["quote"].gap_minutes == 1084.0
    got = {r.table: r for r in quality.freshness({"trade": old, "quote": none}, at("2024-01-02 02:20:00")).collect()}
    assert got["trade"].is_stale and got["quote"].is_stale and got["quote"].gap_minutes is None


def test_bands_of_several_boards_do_not_multiply(spark):
    t = spark.createDataFrame([("A", 11.0)], "symbol string, price double")
    b = spark.createDataFrame([("A", 10.0, 5.0), ("A", 10.0, 5.0), ("A", None, 1.0)], "symbol string, ceiling_price double, floor_price double")
    assert quality.price_band_anomalies(t, b, ["symbol"]).count() == 1


def test_calendar_rules(spark):
    empty = spark.createDataFrame([], "trading_date date")
    assert calendar.trading_dates(empty, F.lit("2024-01-01"), F.lit("2024-01-07")).count() == 5
    with pytest.raises(Exception, match="empty"):
        calendar.summary(empty).collect()


def test_silver_leaves_out_what_is_done(spark):
    b = bars(spark, [("ABC", "2024-01-02 03:00:00", 5.0)]).withColumn("resolution", F.lit("1min"))
    days = spark.createDataFrame([(day("2024-01-02"),)], "trading_date date")
    done = spark.createDataFrame([("ABC", "1min", "2024-01-02")], "symbol string, resolution string, date string")
    assert silver.silver(b, days).count() == 166 and silver.silver(b, days, done=done).count() == 0
    stats = silver.silver_stats(silver.silver(b, days), spark.createDataFrame([("ABC",), ("NONE",)], "symbol string")).first()
    assert (stats.symbols, stats.rows, stats.skipped) == (1, 166, 1)


def test_normalized_feed_records(spark):
    raw = spark.createDataFrame([("A", None, "", "9.5", None, "Buy ", None, 1704160800.25, 1704160801.0)], "symbol string, marketId string, boardId string, price string, quantity int, side string, time double, multicastReceiveTime double, receivedAt double")
    r = N.normalize_trades(raw).first()
    assert (r.market_id, r.board_id, r.price, r.quantity, r.side) == ("UNKNOWN", "UNKNOWN", 9.5, 0, 1)
    assert r.exchange_ts == r.gateway_ts == ts("2024-01-02 02:00:00.250000")
    quote = spark.createDataFrame([("A", [(1.0, 5), (0.9, None)], None)], "symbol string, bid array<struct<price:double,quantity:int>>, offer array<struct<price:double,quantity:int>>")
    q = N.normalize_quotes(quote, as_of=F.lit("2024-01-02 00:00:00").cast("timestamp")).first()
    assert (q.bid_price2, q.bid_qty2, q.bid_price3, q.ask_price1, q.spread, q.ask_levels) == (0.9, None, None, None, None, [])


def test_tolerant_index_foreign_expected_instruments(spark):
    i = spark.createDataFrame([("VN30", "12.5", "x", "7")], "indexName string, valueIndexes string, changedValue string, totalVolumeTraded string")
    r = N.normalize_index(i).first()
    assert (r.value, r.changed_value, r.total_volume) == (12.5, None, 7)
    f = N.normalize_foreign(spark.createDataFrame([("A", "5", 1704160800.0)], "symbol string, sellVolume string, receivedAt double")).first()
    assert f.sell_volume == 5 and f.exchange_ts is None and f.producer_ts == ts("2024-01-02 02:00:00")
    e = N.normalize_expected_price(spark.createDataFrame([("A", 1.5, "3")], "symbol string, expectedTradePrice double, expectedTradeQuantity string")).first()
    assert (e.expected_price, e.expected_qty) == (1.5, 3)
    m = spark.createDataFrame([("A", "STO", ["X", "Y"], "20240105"), (None, "STO", [], None)], "symbol string, marketId string, indexName array<string>, listedDate string")
    rows = N.normalize_instruments(m).collect()
    assert len(rows) == 1 and rows[0].index_name == "X,Y" and rows[0].listed_date == day("2024-01-05")


def test_unknown_resolution_is_an_error(spark):
    df = spark.createDataFrame([("2min",)], "r string")
    with pytest.raises(Exception, match="invalid resolution"):
        df.select(T.normalize_resolution("r")).collect()


def test_previous_day_across_months(spark):
    cal = spark.createDataFrame([(day("2024-01-31"),), (day("2024-03-01"),)], "trading_date date")
    asked = spark.createDataFrame([(day(x),) for x in ("2024-01-31", "2024-02-10", "2024-03-01", "2024-03-02")], "date date")
    got = {r.date.isoformat(): r.previous_date for r in calendar.previous_trading_date(asked, cal).collect()}
    assert got == {"2024-01-31": None, "2024-02-10": day("2024-01-31"), "2024-03-01": day("2024-01-31"), "2024-03-02": day("2024-03-01")}
