"""Raw feed and API records to canonical columns.

Each function takes a DataFrame of raw records and returns the canonical one.
Fields that can't be read become null; nothing fails on a bad value. ``as_of``
is the clock used where a record has no time of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .time import MARKET_TZ, col, from_millis, partition_stamp, seconds_to_time, utc_time

UNKNOWN = "UNKNOWN"
BUY, SELL = ("BUY", "B", "1"), ("SELL", "S", "2")
#: Index names and the prefixes of derivative symbols.
INDEXES = ("VN30", "VNINDEX", "HNX", "HNX30", "VN100", "UPCOM")
DERIVATIVE_PREFIXES = ("VN30F", "V100F", "41I1", "41I2")


def _has(df: DataFrame, name: str) -> bool:
    return name in df.columns


def _get(df: DataFrame, *names: str) -> Column:
    """The first present and non-null of alternative columns."""
    found = [F.col(f"`{n}`") for n in names if _has(df, n)]
    return F.coalesce(*found) if found else F.lit(None)


def _text(c: Column, default: str | None = None) -> Column:
    """A string; the empty one counts as missing where there is a default."""
    value = c.cast("string")
    return value if default is None else F.when(F.length(value) > 0, value).otherwise(default)


def _int(c: Column, kind: str = "bigint") -> Column:
    return c.try_cast(kind)


def _number(c: Column) -> Column:
    return c.try_cast("double")


def normalize_side(side: Column | str) -> Column:
    """1 buy, 2 sell, 0 unknown; letter case and blanks don't matter."""
    given = F.upper(F.trim(col(side).cast("string")))
    return F.when(given.isin(*BUY), 1).when(given.isin(*SELL), 2).otherwise(0)


def classify_instrument(symbol: Column | str) -> Column:
    name = F.upper(F.trim(col(symbol)))
    derivative = F.lit(False)
    for prefix in DERIVATIVE_PREFIXES:
        derivative = derivative | name.startswith(prefix)
    return F.when(name.isin(*INDEXES), "INDEX").when(derivative, "DERIVATIVE").otherwise("STOCK")


def depth_level(levels: Column | str, index: int, field: str) -> Column:
    """A field of one level of the book; null past its end."""
    return F.get(col(levels), index)[field]


def canonical_levels(levels: Column | str, price: str = "price", quantity: str = "quantity") -> Column:
    """Book levels as structs of (price, qtty); a missing book is an empty one."""
    one = lambda x: F.struct(x[price].cast("double").alias("price"), x[quantity].cast("int").alias("qtty"))
    return F.coalesce(F.transform(col(levels), one), F.array().cast("array<struct<price:double,qtty:int>>"))


def flatten_depth(df: DataFrame, bid: str = "bid_levels", ask: str = "ask_levels", levels: int = 3) -> DataFrame:
    """Prices and quantities of the first levels as columns, and the spread."""
    out = {}
    for side, source in (("bid", bid), ("ask", ask)):
        for i in range(levels):
            out[f"{side}_price{i + 1}"] = depth_level(source, i, "price")
            out[f"{side}_qty{i + 1}"] = depth_level(source, i, "qtty")
    return with_spread(df.withColumns(out))


def with_spread(df: DataFrame) -> DataFrame:
    return df.withColumn("spread", F.col("ask_price1") - F.col("bid_price1"))


def unwrap_union(*members: Column | str) -> Column:
    """The one member of a tagged union that is set."""
    return F.coalesce(*map(col, members))


def _clocks(df: DataFrame, event: tuple[str, ...], as_of: Column | None) -> dict[str, Column]:
    gateway = seconds_to_time(_get(df, "multicastReceiveTime"))
    return {"exchange_ts": F.coalesce(seconds_to_time(_get(df, *event)), gateway, as_of if as_of is not None else F.lit(None)).cast("timestamp"), "gateway_ts": gateway, "producer_ts": seconds_to_time(_get(df, "receivedAt"))}


def normalize_trades(df: DataFrame, as_of: Column | None = None) -> DataFrame:
    get = lambda *n: _get(df, *n)
    return df.select(*(c.alias(n) for n, c in ({
        "symbol": _text(get("symbol")), "market_id": _text(get("marketId"), UNKNOWN), "board_id": _text(get("boardId"), UNKNOWN), "price": _number(get("price")), "quantity": F.coalesce(_int(get("quantity"), "int"), F.lit(0)),
        "side": normalize_side(get("side")), "session_vol": _int(get("totalVolumeTraded")), "session_high": _number(get("highestPrice")), "session_low": _number(get("lowestPrice")), "session_open": _number(get("openPrice")), "session_vwap": _number(get("avgPrice")),
        "trading_session_id": _text(get("tradingSessionId")),
    } | _clocks(df, ("time",), as_of)).items()))


def normalize_quotes(df: DataFrame, as_of: Column | None = None) -> DataFrame:
    get = lambda *n: _get(df, *n)
    flat = df.select(*(c.alias(n) for n, c in ({
        "symbol": _text(get("symbol")), "market_id": _text(get("marketId"), UNKNOWN), "board_id": _text(get("boardId"), UNKNOWN), "total_bid_qty": _int(get("totalBidQtty")), "total_ask_qty": _int(get("totalOfferQtty")),
        "bid_levels": canonical_levels("bid"), "ask_levels": canonical_levels("offer"),
    } | _clocks(df, ("time",), as_of)).items()))
    return flatten_depth(flat)


#: Canonical column -> raw field, for numbers with and without fraction.
INDEX_NUMBERS = {"value": "valueIndexes", "prior_value": "priorValueIndexes", "highest_value": "highestValueIndexes", "lowest_value": "lowestValueIndexes", "changed_value": "changedValue", "changed_ratio": "changedRatio", "total_value": "grossTradeAmount", "match_value": "contauctAccTrdVal", "deal_value": "blkTrdAccTrdVal"}
INDEX_COUNTS = {"up_count": "fluctuationUpIssueCount", "down_count": "fluctuationDownIssueCount", "steady_count": "fluctuationSteadinessIssueCount", "upper_limit_count": "fluctuationUpperLimitIssueCount", "lower_limit_count": "fluctuationLowerLimitIssueCount", "up_volume": "fluctuationUpIssueVolume", "down_volume": "fluctuationDownIssueVolume", "steady_volume": "fluctuationSteadinessIssueVolume", "total_volume": "totalVolumeTraded", "match_volume": "contauctAccTrdVol", "deal_volume": "blkTrdAccTrdVol"}
FOREIGN_COUNTS = {"sell_volume": "sellVolume", "sell_value": "sellTradedAmount", "buy_volume": "buyVolume", "buy_value": "buyTradedAmount", "total_sell_volume": "totalSellVolume", "total_sell_value": "totalSellTradedAmount", "total_buy_volume": "totalBuyVolume", "total_buy_value": "totalBuyTradedAmount", "order_limit_qty": "foreignerOrderLimitQuantity", "buy_possible_qty": "foreignerBuyPossibleQuantity"}


def normalize_index(df: DataFrame, as_of: Column | None = None) -> DataFrame:
    numbers = {n: _number(_get(df, raw)) for n, raw in INDEX_NUMBERS.items()}
    counts = {n: _int(_get(df, raw), "int" if n.endswith("_count") else "bigint") for n, raw in INDEX_COUNTS.items()}
    head = {"index_name": _text(_get(df, "indexName")), "market_id": _text(_get(df, "marketId")), "trading_session_id": _text(_get(df, "tradingSessionId"))}
    return df.select(*(c.alias(n) for n, c in (head | numbers | counts | _clocks(df, ("transactTime",), as_of)).items()))


def normalize_foreign(df: DataFrame, as_of: Column | None = None) -> DataFrame:
    head = {n: _text(_get(df, raw)) for n, raw in {"symbol": "symbol", "market_id": "marketId", "board_id": "boardId", "trading_session_id": "tradingSessionId"}.items()}
    counts = {n: _int(_get(df, raw)) for n, raw in FOREIGN_COUNTS.items()}
    received = F.coalesce(seconds_to_time(_get(df, "receivedAt")), as_of if as_of is not None else F.lit(None)).cast("timestamp")
    return df.select(*(c.alias(n) for n, c in (head | counts | {"exchange_ts": seconds_to_time(_get(df, "transactTime")), "producer_ts": received}).items()))


def normalize_expected_price(df: DataFrame, as_of: Column | None = None) -> DataFrame:
    received = F.coalesce(seconds_to_time(_get(df, "receivedAt")), as_of if as_of is not None else F.lit(None)).cast("timestamp")
    return df.select(
        *(_text(_get(df, raw)).alias(n) for n, raw in {"symbol": "symbol", "market_id": "marketId", "board_id": "boardId", "isin": "isin"}.items()),
        _number(_get(df, "closePrice")).alias("close_price"), _number(_get(df, "expectedTradePrice")).alias("expected_price"), _int(_get(df, "expectedTradeQuantity")).alias("expected_qty"), received.alias("producer_ts"),
    )


def parse_local_time(text: Column | str, tz: str = MARKET_TZ) -> Column:
    """Local ``yyyy-MM-dd HH:mm:ss`` with or without a fraction as UTC, to the millisecond; null if unreadable."""
    given = col(text)
    parsed = F.coalesce(F.try_to_timestamp(given, F.lit("yyyy-MM-dd HH:mm:ss.SSS")), F.try_to_timestamp(given, F.lit("yyyy-MM-dd HH:mm:ss.SSSSSS")), F.try_to_timestamp(given, F.lit("yyyy-MM-dd HH:mm:ss")))
    return F.date_trunc("millisecond", utc_time(parsed, tz)).cast("timestamp")


def _landed(df: DataFrame, time_col: str, tz: str) -> DataFrame:
    timed = df.withColumn("exchange_ts", parse_local_time(time_col, tz)).filter(F.col("exchange_ts").isNotNull() & F.col("symbol").isNotNull())
    return timed.withColumn("date", partition_stamp("exchange_ts", tz)).withColumn("is_backfill", F.lit(True))


def normalize_rest_trades(df: DataFrame, tz: str = MARKET_TZ) -> DataFrame:
    """Trades of the landed API pages; rows whose time can't be read are dropped."""
    d = _landed(df, "time", tz)
    get = lambda *n: _get(d, *n)
    return d.select(
        "symbol", _text(get("marketId"), UNKNOWN).alias("market_id"), _text(get("boardId"), UNKNOWN).alias("board_id"), _number(get("matchPrice")).alias("price"), F.coalesce(_int(get("matchQtty"), "int"), F.lit(0)).alias("quantity"),
        normalize_side(get("side")).alias("side"), _int(get("totalVolumeTraded")).alias("session_vol"), _number(get("highestPrice")).alias("session_high"), _number(get("lowestPrice")).alias("session_low"), _number(get("openPrice")).alias("session_open"), _number(get("avgPrice")).alias("session_vwap"),
        _text(get("tradingSessionId")).alias("trading_session_id"), "exchange_ts", "date", "is_backfill",
    )


def normalize_rest_quotes(df: DataFrame, tz: str = MARKET_TZ) -> DataFrame:
    """Quotes of the landed API pages."""
    d = _landed(df, "time", tz)
    flat = d.select("symbol", _text(_get(d, "marketId"), UNKNOWN).alias("market_id"), _text(_get(d, "boardId"), UNKNOWN).alias("board_id"), _int(_get(d, "totalBidQtty")).alias("total_bid_qty"), _int(_get(d, "totalOfferQtty")).alias("total_ask_qty"), canonical_levels("bid").alias("bid_levels"), canonical_levels("offer").alias("ask_levels"), "exchange_ts", "date", "is_backfill")
    return flatten_depth(flat)


def tolerant_date(c: Column | str) -> Column:
    """ISO or yyyyMMdd dates; null if unreadable."""
    given = col(c).cast("string")
    return F.coalesce(F.try_to_timestamp(given, F.lit("yyyy-MM-dd")), F.try_to_timestamp(given, F.lit("yyyyMMdd")), given.try_cast("timestamp")).cast("date")


def normalize_instruments(df: DataFrame) -> DataFrame:
    """Camel- or snake-case fields; a list of indexes becomes a comma list; rows without a key are dropped."""
    index = _get(df, "indexName", "index_name")
    kind = next((f.dataType.typeName() for f in df.schema if f.name in ("indexName", "index_name")), "string")
    index = F.array_join(index, ",") if kind == "array" else index.cast("string")
    out = df.select(
        _text(_get(df, "symbol")).alias("symbol"), _text(_get(df, "marketId", "market_id")).alias("market_id"), _text(_get(df, "securityGroupId", "security_group_id")).alias("security_group_id"), _text(_get(df, "symbolType", "symbol_type")).alias("symbol_type"),
        tolerant_date(_get(df, "listedDate", "listed_date")).alias("listed_date"), tolerant_date(_get(df, "finalTradeDate", "final_trade_date")).alias("final_trade_date"), _text(_get(df, "shortName", "short_name")).alias("short_name"), _text(_get(df, "fullName", "full_name")).alias("full_name"), index.alias("index_name"),
    )
    return out.filter((F.length("symbol") > 0) & (F.length("market_id") > 0))


def normalize_secdef(df: DataFrame, as_of_date: Column, boards: list[str] | None = None) -> DataFrame:
    """Security definitions with tolerant numbers and dates; rows need a symbol, market and board."""
    get = lambda *n: _get(df, *n)
    texts = {"symbol": ("symbol",), "market_id": ("marketId", "market_id"), "board_id": ("boardId", "board_id"), "isin": ("isin",), "product_grp_id": ("productGrpId", "product_grp_id"), "security_group_id": ("securityGroupId", "security_group_id"), "security_status": ("securityStatus", "security_status"), "admin_status": ("symbolAdminStatusCode", "admin_status"), "trading_method_status": ("symbolTradingMethodStatusCode", "trading_method_status"), "trading_sanction_status": ("symbolTradingSanctionStatusCode", "trading_sanction_status")}
    numbers = {"basic_price": ("basicPrice", "basic_price"), "ceiling_price": ("ceilingPrice", "ceiling_price"), "floor_price": ("floorPrice", "floor_price")}
    out = df.select(
        *(_text(get(*raw)).alias(n) for n, raw in texts.items()), *(_number(get(*raw)).alias(n) for n, raw in numbers.items()), _int(get("openInterestQtty", "open_interest_qty")).alias("open_interest_qty"),
        tolerant_date(get("listingDate", "listing_date")).alias("listing_date"), tolerant_date(get("finalTradeDate", "final_trade_date")).alias("final_trade_date"), as_of_date.cast("date").alias("trading_date"),
    )
    keyed = out.filter((F.length("symbol") > 0) & (F.length("market_id") > 0) & (F.length("board_id") > 0))
    return filter_boards(keyed, boards) if boards else keyed


def filter_boards(df: DataFrame, boards: list[str], board: str = "board_id") -> DataFrame:
    """Rows of the given boards; an empty list lets all pass."""
    return df.filter(F.col(board).isin(*boards)) if boards else df


def skipped_boards(df: DataFrame, boards: list[str], board: str = "board_id") -> Column:
    """An aggregate for ``observe``: how many rows ``filter_boards`` leaves out."""
    return F.count_if(~F.coalesce(F.col(board).isin(*boards), F.lit(False))).alias("skipped") if boards else F.lit(0).alias("skipped")


def epoch_columns(df: DataFrame, *names: str) -> DataFrame:
    """Epoch-millisecond columns as UTC times; what can't be read becomes null."""
    return df.withColumns({n: from_millis(n) for n in names})
