"""Schemas of the feeds and tables. Event times are UTC."""

from pyspark.sql import types as T


LEVELS = "array<struct<price:double,qtty:int>>"
_TYPES = {
    "string": T.StringType(), "double": T.DoubleType(), "int": T.IntegerType(), "bigint": T.LongType(), "boolean": T.BooleanType(), "timestamp": T.TimestampType(), "date": T.DateType(),
    LEVELS: T.ArrayType(T.StructType([T.StructField("price", T.DoubleType()), T.StructField("qtty", T.IntegerType())])),
}


def _struct(spec: str) -> T.StructType:
    """Columns and types as in DDL; works without a session."""
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in (c.split(" ") for c in spec.split(", "))])


TRADE = _struct("symbol string, market_id string, board_id string, price double, quantity int, side int, session_vol bigint, session_high double, session_low double, session_open double, session_vwap double, trading_session_id string, exchange_ts timestamp, gateway_ts timestamp, producer_ts timestamp, ingested_ts timestamp, is_backfill boolean, date string, kafka_partition int, kafka_offset bigint")
QUOTE = _struct(
    "symbol string, market_id string, board_id string, "
    + ", ".join(f"{side}_price{i} double, {side}_qty{i} int" for side in ("bid", "ask") for i in (1, 2, 3))
    + f", total_bid_qty bigint, total_ask_qty bigint, bid_levels {LEVELS}, ask_levels {LEVELS}, exchange_ts timestamp, gateway_ts timestamp, producer_ts timestamp, date string, kafka_partition int, kafka_offset bigint"
)
INDEX = _struct("index_name string, market_id string, value double, prior_value double, highest_value double, lowest_value double, changed_value double, changed_ratio double, up_count int, down_count int, steady_count int, upper_limit_count int, lower_limit_count int, up_volume bigint, down_volume bigint, steady_volume bigint, total_volume bigint, total_value double, match_volume bigint, match_value double, deal_volume bigint, deal_value double, trading_session_id string, exchange_ts timestamp, gateway_ts timestamp, producer_ts timestamp, date string")
FOREIGN = _struct("symbol string, market_id string, board_id string, trading_session_id string, sell_volume bigint, sell_value bigint, buy_volume bigint, buy_value bigint, total_sell_volume bigint, total_sell_value bigint, total_buy_volume bigint, total_buy_value bigint, order_limit_qty bigint, buy_possible_qty bigint, exchange_ts timestamp, producer_ts timestamp, date string")
EXPECTED_PRICE = _struct("symbol string, market_id string, board_id string, isin string, close_price double, expected_price double, expected_qty bigint, producer_ts timestamp, date string")
SECDEF = _struct("symbol string, market_id string, board_id string, isin string, product_grp_id string, security_group_id string, basic_price double, ceiling_price double, floor_price double, open_interest_qty bigint, security_status string, admin_status string, trading_method_status string, trading_sanction_status string, listing_date date, final_trade_date date, trading_date date, ingested_ts timestamp")
INSTRUMENT = _struct("symbol string, market_id string, security_group_id string, symbol_type string, listed_date date, final_trade_date date, short_name string, full_name string, index_name string, is_active boolean, last_synced_ts timestamp")
CALENDAR = _struct("trading_date date")
CANDLE = _struct("symbol string, resolution string, open double, high double, low double, close double, volume bigint, time timestamp, date string")
SILVER_CANDLE = _struct("symbol string, resolution string, open double, high double, low double, close double, volume bigint, time timestamp, date string, bar_type string, is_filled boolean, trading_date string")
METRIC = _struct("ts timestamp, service_name string, metric_name string, metric_value double, label string")
LEDGER = _struct("symbol string, data_type string, range_start timestamp, range_end timestamp, page int, next_token string, done boolean")

KINDS = {"trade": TRADE, "quote": QUOTE, "index": INDEX, "foreign": FOREIGN, "expected_price": EXPECTED_PRICE, "secdef": SECDEF, "instrument": INSTRUMENT, "calendar": CALENDAR, "candle": CANDLE, "silver_candle": SILVER_CANDLE, "metric": METRIC, "ledger": LEDGER}
