"""Security master: upserts, deltas, universes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .dedup import latest_per_key

KEY = ("symbol", "market_id")
#: Markets whose missing symbols are deactivated, and fewest symbols for that.
DEACTIVATED_MARKETS, LEAST_SYMBOLS = ("STO", "STX", "DVX"), 200
PRIORITY_LIMIT = 1950


def with_secdef(secdef: DataFrame, instruments: DataFrame) -> DataFrame:
    """Security definitions with the master's columns beside them (prefixed ``im_``)."""
    master = instruments.select(*KEY, *(F.col(c).alias(f"im_{c}") for c in instruments.columns if c not in KEY))
    return secdef.join(master, list(KEY))


def unknown_symbols(secdef: DataFrame, instruments: DataFrame) -> DataFrame:
    """Symbols of any security definition that the master lacks."""
    return secdef.select("symbol").distinct().join(instruments.select("symbol"), "symbol", "left_anti")


def missing_from_secdef(instruments: DataFrame, secdef: DataFrame, as_of: Column) -> DataFrame:
    """Unexpired instruments without a definition on the day."""
    today = secdef.filter(F.col("trading_date") == as_of).select(*KEY)
    return instruments.filter(F.col("final_trade_date").isNull() | (F.col("final_trade_date") >= as_of)).join(today, list(KEY), "left_anti")


def fill_expiry(instruments: DataFrame, secdef: DataFrame) -> DataFrame:
    """Null expiries take the newest definition's; ``changed`` marks the rows that did."""
    known = secdef.filter(F.col("final_trade_date").isNotNull()).groupBy(*KEY).agg(F.max_by("final_trade_date", "trading_date").alias("__expiry"))
    joined = instruments.join(known, list(KEY), "left")
    changed = F.col("final_trade_date").isNull() & F.col("__expiry").isNotNull()
    return joined.withColumn("changed", changed).withColumn("final_trade_date", F.coalesce("final_trade_date", "__expiry")).select(*instruments.columns, "changed")


def upsert(target: DataFrame, source: DataFrame, keys: list[str], policy: dict[str, str] | None = None, default: str = "incoming") -> DataFrame:
    """The target with the source's rows merged in, one source row for each key.

    Policies of a column where a key is on both sides: ``incoming`` takes the source's value
    (null too), ``coalesce`` the source's unless null, ``keep`` the target's. Columns
    that the source lacks are kept.
    """
    policy = policy or {}
    t = target.select(*(F.col(c).alias(f"t_{c}") for c in target.columns)).withColumn("__t", F.lit(True))
    s = source.select(*(F.col(c).alias(f"s_{c}") for c in source.columns if c in target.columns)).withColumn("__s", F.lit(True))
    match = F.lit(True)
    for k in keys:
        match = match & F.col(f"t_{k}").eqNullSafe(F.col(f"s_{k}"))
    joined = t.join(s, match, "full")
    out = []
    for c in target.columns:
        old, new = F.col(f"t_{c}"), F.col(f"s_{c}") if c in source.columns else None
        if c in keys:
            value = F.when(F.col("__s"), new).otherwise(old)
        elif new is None:
            value = old
        else:
            rule = policy.get(c, default)
            merged = {"incoming": new, "coalesce": F.coalesce(new, old), "keep": old}[rule]
            value = F.when(F.col("__s").isNull(), old).when(F.col("__t").isNull(), new).otherwise(merged)
        out.append(value.alias(c))
    return joined.select(*out)


def upsert_instruments(master: DataFrame, incoming: DataFrame, order: list[str], synced: Column) -> DataFrame:
    """The master with incoming instruments: all columns replaced, an old expiry kept where the new one is null."""
    last = latest_per_key(incoming, list(KEY), order).withColumn("is_active", F.lit(True)).withColumn("last_synced_ts", synced)
    source = last.select(*(c for c in master.columns if c in last.columns))
    return upsert(master, source, list(KEY), {"final_trade_date": "coalesce"})


def insert_if_absent(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    return target.unionByName(source.dropDuplicates(keys).join(target.select(*keys), keys, "left_anti"), allowMissingColumns=True)


def set_active(instruments: DataFrame, symbols: DataFrame, active: bool) -> DataFrame:
    """``is_active`` set for listed symbols; ``changed`` marks rows whose flag was another."""
    named = symbols.select("symbol").distinct().withColumn("__hit", F.lit(True))
    joined = instruments.join(named, "symbol", "left")
    changed = F.col("__hit").isNotNull() & ~F.col("is_active").eqNullSafe(F.lit(active))
    return joined.withColumn("changed", changed).withColumn("is_active", F.when(F.col("__hit"), F.lit(active)).otherwise(F.col("is_active"))).select(*instruments.columns, "changed")


def symbol_set(instruments: DataFrame, active: bool | None = None, markets: list[str] | None = None) -> DataFrame:
    rows = instruments if active is None else instruments.filter(F.col("is_active") == active)
    rows = rows.filter(F.col("market_id").isin(*markets)) if markets else rows
    return rows.select("symbol").distinct()


def instrument_delta(instruments: DataFrame, secdef: DataFrame, as_of: Column, markets: tuple[str, ...] = DEACTIVATED_MARKETS, least: int = LEAST_SYMBOLS) -> DataFrame:
    """(symbol, action): new, reactivate or deactivate, by symbol alone.

    Nothing is deactivated on a day with fewer than ``least`` symbols; an empty master
    gives no rows (see ``delta_state``).
    """
    master = instruments.groupBy("symbol").agg(F.max("is_active").alias("any_active"), F.min("is_active").alias("all_active"), F.max(F.coalesce(F.col("is_active"), F.lit(False)) & F.col("market_id").isin(*markets)).alias("at_risk"))
    defined = secdef.groupBy("symbol").agg(F.max(F.coalesce(F.col("trading_date") == as_of, F.lit(False))).alias("today"))
    state = F.broadcast(delta_state(instruments, secdef, as_of, least))
    both = defined.join(master.withColumn("known", F.lit(True)), "symbol", "full").crossJoin(state)
    known, today = F.coalesce("known", F.lit(False)), F.coalesce("today", F.lit(False))
    action = F.when(~known, "new").when(today & (F.col("all_active") == False), "reactivate").when(~today & F.col("at_risk") & F.col("may_deactivate"), "deactivate")  # noqa: E712
    return both.filter(~F.col("first_run")).withColumn("action", action).filter(F.col("action").isNotNull()).select("symbol", "action")


def delta_state(instruments: DataFrame, secdef: DataFrame, as_of: Column, least: int = LEAST_SYMBOLS) -> DataFrame:
    """One row: (n_today, first_run, may_deactivate)."""
    today = secdef.filter(F.col("trading_date") == as_of).agg(F.countDistinct("symbol").alias("n_today"))
    known = instruments.agg((F.count("*") == 0).alias("first_run"))
    return today.crossJoin(known).withColumn("may_deactivate", F.col("n_today") >= least)


def fallback_rows(wanted: DataFrame, primary: DataFrame, secdef: DataFrame) -> DataFrame:
    """Rows of the wanted symbols: from the primary source, and for those it lacks from their newest definition."""
    named = wanted.select("symbol").distinct()
    own = primary.join(named, "symbol", "left_semi")
    lost = named.join(primary.select("symbol"), "symbol", "left_anti")
    spare = latest_per_key(secdef.join(lost, "symbol", "left_semi"), ["symbol"], ["trading_date", "market_id", "board_id"])
    return own.unionByName(spare.select(*(c for c in spare.columns if c in primary.columns)), allowMissingColumns=True)


def apply_delta(instruments: DataFrame, delta: DataFrame, incoming: DataFrame, secdef: DataFrame, synced: Column) -> DataFrame:
    """The master after a delta: new rows, switched flags, expiries filled from definitions."""
    fresh = fallback_rows(delta.filter("action = 'new'"), incoming, secdef)
    master = upsert_instruments(instruments, fresh, list(KEY), synced)
    flags = delta.filter("action <> 'new'").select("symbol", (F.col("action") == "reactivate").alias("__active"))
    master = master.join(flags, "symbol", "left").withColumn("is_active", F.coalesce("__active", "is_active")).select(*instruments.columns)
    return fill_expiry(master, secdef).drop("changed")


def delta_summary(delta: DataFrame) -> DataFrame:
    return delta.groupBy("action").agg(F.count("*").alias("n"))


def additions(current: DataFrame, previous: DataFrame) -> DataFrame:
    """Symbols that the previous set lacks."""
    return current.select("symbol").distinct().join(previous.select("symbol"), "symbol", "left_anti")


def in_index(index_name: Column | str, indexes: list[str]) -> Column:
    """Whether a comma list has any of the indexes, as whole items."""
    items = F.transform(F.split(F.col(index_name) if isinstance(index_name, str) else index_name, ","), lambda x: F.trim(x))
    return F.coalesce(F.arrays_overlap(items, F.array(*map(F.lit, indexes))), F.lit(False))


def index_members(instruments: DataFrame, index: str) -> DataFrame:
    return instruments.filter(F.col("is_active") & in_index("index_name", [index])).select("symbol").distinct().orderBy("symbol")


def universe(secdef: DataFrame, instruments: DataFrame, as_of: Column, boards: list[str] = ("G1",), statuses: list[str] = (), admin: list[str] = (), sanctions: list[str] = (), markets: list[str] = (), groups: list[str] = (), indexes: list[str] = ()) -> DataFrame:
    """Symbols tradable on a day. An empty list is no filter; groups and indexes widen each other."""
    s = secdef.filter(F.col("trading_date") == as_of)
    for column, values in (("board_id", boards), ("security_status", statuses), ("admin_status", admin), ("trading_sanction_status", sanctions), ("market_id", markets)):
        if values:
            s = s.filter(F.col(column).isin(*values))
    m = instruments.filter(F.col("is_active"))
    if groups or indexes:
        m = m.filter((F.col("security_group_id").isin(*groups) if groups else F.lit(False)) | (in_index("index_name", list(indexes)) if indexes else F.lit(False)))
    return s.select(*KEY).join(m.select(*KEY), list(KEY), "left_semi").select("symbol").distinct().orderBy("symbol")


def end_of_day_universe(instruments: DataFrame, physical_prefixes: tuple[str, ...] = ("41I1", "41I2"), rolling: tuple[str, ...] = ("VN30F1M", "VN30F2M", "VN30F1Q", "VN30F2Q", "V100F1M", "V100F2M", "V100F1Q", "V100F2Q")) -> DataFrame:
    """Active symbols without physical contracts, with the rolling codes."""
    own = instruments.filter(F.col("is_active")).select("symbol")
    for prefix in physical_prefixes:
        own = own.filter(~F.col("symbol").startswith(prefix))
    codes = instruments.sparkSession.createDataFrame([(c,) for c in rolling], "symbol string")
    return own.union(codes).distinct()


def priority_symbols(instruments: DataFrame, markets: list[str], as_of: Column, limit: int = PRIORITY_LIMIT) -> DataFrame:
    """Unexpired symbols of the markets in order, as many as a subscription may hold."""
    alive = F.col("final_trade_date").isNull() | (F.col("final_trade_date") >= as_of)
    return instruments.filter(F.col("market_id").isin(*markets) & alive).select("symbol").distinct().orderBy("symbol").limit(limit)


def register_contracts(instruments: DataFrame, wanted: DataFrame, trades: DataFrame, quotes: DataFrame, end: Column, market: str = "DVX", group: str = "FU") -> DataFrame:
    """The master with missing 9-character contracts: their expiry is the last trade's day, else the last quote's, else the range's end."""
    named = wanted.select("symbol").distinct().filter(F.length("symbol") == 9).join(instruments.select("symbol"), "symbol", "left_anti")
    last = lambda df, name: df.join(named, "symbol", "left_semi").groupBy("symbol").agg(F.max("exchange_ts").cast("date").alias(name))
    dated = named.join(last(trades, "__t"), "symbol", "left").join(last(quotes, "__q"), "symbol", "left")
    fresh = dated.select("symbol", F.lit(market).alias("market_id"), F.lit(group).alias("security_group_id"), F.coalesce("__t", "__q", end.cast("date")).alias("final_trade_date"), F.lit(False).alias("is_active"))
    return insert_if_absent(instruments, fresh, list(KEY))
