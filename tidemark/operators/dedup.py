"""Fingerprints of ticks and bars, latest rows, gaps and islands."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import scan


def trade_fingerprint(ts: str = "exchange_ts") -> dict[str, Column]:
    """Symbol, millisecond, price to 4 places, quantity and side."""
    return {"symbol": F.col("symbol"), "ms": F.unix_millis(F.col(ts).cast("timestamp")), "price4": F.round("price", 4), "quantity": F.col("quantity"), "side": F.col("side")}


def quote_fingerprint(ts: str = "exchange_ts") -> dict[str, Column]:
    """Symbol, millisecond, best bid and ask to 4 places; nulls equal each other."""
    return {"symbol": F.col("symbol"), "ms": F.unix_millis(F.col(ts).cast("timestamp")), "bid4": F.round("bid_price1", 4), "ask4": F.round("ask_price1", 4)}


def first_occurrences(rows: DataFrame, fingerprint: dict[str, Column], order: list[str]) -> DataFrame:
    """The first row of each fingerprint."""
    keyed = rows.withColumns({f"__{k}": c for k, c in fingerprint.items()})
    rank = F.row_number().over(Window.partitionBy(*(f"__{k}" for k in fingerprint)).orderBy(*order))
    return keyed.withColumn("__rank", rank).filter("__rank = 1").select(*rows.columns)


def new_rows(incoming: DataFrame, stored: DataFrame, fingerprint: dict[str, Column], order: list[str], ts: str = "exchange_ts", by: str | None = None) -> DataFrame:
    """Incoming rows, each fingerprint once, that are not stored yet.

    The incoming side's first and last time are looked up when this is called (one row, a
    job of its own that reads only the time column), so that the stored side is read with plain bounds, which reach its files; ``by`` names a column of stored
    dates of these times, whose partitions are then pruned as well. Nulls equal each other.
    """
    once = first_occurrences(incoming, fingerprint, order).withColumns({f"__{k}": c for k, c in fingerprint.items()})
    low, high = incoming.agg(F.date_trunc("second", F.min(ts)), F.max(ts)).first()
    if low is None:
        return once.select(*incoming.columns)
    kind = incoming.schema[ts].dataType.simpleString()
    low, high = F.lit(low).cast(kind), F.lit(high).cast(kind) + F.expr("INTERVAL 1 SECOND")
    near = stored.filter((F.col(ts) >= low) & (F.col(ts) <= high))
    if by:
        near = near.filter((F.col(by) >= low.cast("date")) & (F.col(by) <= high.cast("date")))
    known = near.select(*(c.alias(f"__s_{k}") for k, c in fingerprint.items())).distinct()
    match = F.lit(True)
    for k in fingerprint:
        match = match & F.col(f"__{k}").eqNullSafe(F.col(f"__s_{k}"))
    return once.join(known, match, "left_anti").select(*incoming.columns)


def new_bars(incoming: DataFrame, stored: DataFrame, keys: tuple[str, ...] = ("symbol", "resolution", "time")) -> DataFrame:
    return incoming.dropDuplicates(list(keys)).join(stored.select(*keys).distinct(), list(keys), "left_anti")


def latest_per_key(rows: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """One row of each key: the last by ``order``, all columns kept."""
    descending = [(F.col(o) if isinstance(o, str) else o).desc_nulls_last() for o in order]
    return rows.withColumn("__rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*descending))).filter("__rank = 1").drop("__rank")


def runs(rows: DataFrame, keys: list[str], order: str, value: list[str], slice_s: int = scan.SLICE_S) -> DataFrame:
    """Runs of equal values in order of a time: its first and last and their length.

    A run is told by where it starts. Keys are cut into slices (see ``scan``), so a run may
    span many tasks, which sum their shares of it.
    """
    before = scan.lag(rows.select(*dict.fromkeys([*keys, order, *value])), keys, [order], {"__there": order, **{f"__was_{i}": v for i, v in enumerate(value)}}, slice_s)
    same = F.col("__there").isNotNull()
    for i, v in enumerate(value):
        same = same & F.col(v).eqNullSafe(F.col(f"__was_{i}"))
    marked = before.withColumn("__start", F.when(~same, F.col(order)))
    placed = scan.last_mark(marked, keys, [order], "__start", "__run", slice_s)
    return placed.groupBy(*keys, *value, "__run").agg(F.min(order).alias("first"), F.max(order).alias("last"), F.count("*").alias("n")).drop("__run")


def counter_resets(rows: DataFrame, keys: list[str], order: list[str], counter: str, max_jump: int | None = None, slice_s: int = scan.SLICE_S) -> DataFrame:
    """Rows whose cumulative counter is below the one before it (or, on request, jumped)."""
    with_before = scan.lag(rows, keys, order, {"previous": counter}, slice_s)
    bad = F.col(counter) < F.col("previous")
    if max_jump is not None:
        bad = bad | (F.col(counter) - F.col("previous") > max_jump)
    return with_before.filter(bad)
