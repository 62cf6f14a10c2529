"""Streaming operators and their sinks.

Sources are streams of canonical rows; event times are ``timestamp``. Everything
that has a batch twin gives the same rows (see the tests).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions.normalize import filter_boards
from ..operators import candles, quality
from ..sources import journal, rollup

#: How late a tick may be, and how often candles come out.
LOOKBACK, REFRESH = "10 minutes", "1 minute"


def event_time(df: DataFrame, ts: str = "exchange_ts") -> DataFrame:
    return df.withColumn(ts, F.col(ts).cast("timestamp"))


def ohlcv_stream(ticks: DataFrame, width: str = "1 minute", lookback: str = LOOKBACK, **options) -> DataFrame:
    """Candles of a stream; a bucket closes when the watermark passes it, later ticks are dropped and counted by Spark."""
    ts = options.get("ts", "exchange_ts")
    timed = event_time(ticks, ts).withWatermark(ts, lookback)
    at = F.struct(ts, *options.get("tie", ())) if options.get("tie") else F.col(ts)
    q = F.col("quantity").cast("bigint")
    out = timed.groupBy(F.window(ts, width), "symbol").agg(
        F.min_by("price", at).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", at).alias("close"), F.sum(q).alias("volume"), F.sum(F.col("quantity") * F.col("price")).alias("turnover"),
        F.sum(F.when(F.col("side") == 1, q).otherwise(0)).alias("buy_vol"), F.sum(F.when(F.col("side") == 2, q).otherwise(0)).alias("sell_vol"), F.count("*").alias("tick_count"),
    )
    return out.select("symbol", F.col("window.start").alias("bucket"), "open", "high", "low", "close", "volume", "turnover", "buy_vol", "sell_vol", "tick_count")


def index_stream(snaps: DataFrame, width: str = "1 minute", lookback: str = LOOKBACK, breadth: tuple[str, ...] = candles.BREADTH, ts: str = "exchange_ts") -> DataFrame:
    """Index candles of a stream."""
    timed = event_time(snaps, ts).withWatermark(ts, lookback)
    out = timed.groupBy(F.window(ts, width), "index_name").agg(F.min_by("value", ts).alias("open"), F.max("value").alias("high"), F.min("value").alias("low"), F.max_by("value", ts).alias("close"), (F.max("total_volume") - F.min("total_volume")).alias("volume"), *(F.max_by(b, ts).alias(b) for b in breadth))
    return out.select("index_name", F.col("window.start").alias("bucket"), "open", "high", "low", "close", "volume", *breadth)


def dedup_stream(rows: DataFrame, keys: list[str], ts: str = "exchange_ts", within: str = LOOKBACK) -> DataFrame:
    """Each fingerprint (or offset) once, within the watermark."""
    return event_time(rows, ts).withWatermark(ts, within).dropDuplicatesWithinWatermark(keys)


def anomaly_stream(trades: DataFrame, bands: DataFrame, keys: list[str]) -> DataFrame:
    """Trades outside their bands: a stream joined with a static table."""
    return quality.price_band_anomalies(trades, bands, keys)


def spread_stream(quotes: DataFrame) -> DataFrame:
    return quality.negative_spreads(quotes)


def _application(batch: DataFrame, given: str | None) -> str:
    """Whose batch numbers these are: the name given, else the query's id, which its checkpoint keeps."""
    return given or batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "stream"


def to_bronze(rows: DataFrame, path: str, checkpoint: str, by: list[str] = ("date",), trigger: dict | None = None, application: str | None = None) -> StreamingQuery:
    """A stream into partitioned files, each row once: the table's ledger has the batches of ``application`` that are in.

    By default that is the query's own id. With a name of the caller's, a checkpoint that
    is made anew must start from the same rows, as its batch numbers count as done.
    """
    write = lambda batch, number: journal.append_batch(batch, path, list(by), _application(batch, application), number)
    return rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def to_serving(rows: DataFrame, path: str, checkpoint: str, columns: list[str], trigger: dict | None = None) -> StreamingQuery:
    """A stream's fixed projection appended to a serving table."""
    return rows.select(*columns).writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(**(trigger or {"availableNow": True})).start()


def route(raw: DataFrame, normalize: Callable[[DataFrame], DataFrame], boards: list[str], bronze: str, serving: str, checkpoint: str, stamp: Column, trigger: dict | None = None, application: str | None = None) -> StreamingQuery:
    """Normalize once, then add all rows to bronze and those of the boards to serving, batch by batch and each batch once."""
    rows = normalize(raw).withColumn("date", stamp)

    def write(batch: DataFrame, number: int) -> None:
        batch.persist()
        try:
            name = _application(batch, application)
            journal.append_batch(batch, bronze, ["date"], name, number)
            journal.append_batch(filter_boards(batch, boards), serving, ["date"], name, number)
        finally:
            batch.unpersist()

    return rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def with_universe(rows: DataFrame, universe: Callable[[SparkSession], DataFrame], sink: Callable[[DataFrame, int], None], checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Rows of the symbols that ``universe`` gives, read anew for every batch."""

    def write(batch: DataFrame, number: int) -> None:
        wanted = universe(batch.sparkSession).select("symbol").distinct()
        sink(batch.join(wanted, "symbol", "left_semi"), number)

    return rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def maintained_candles(ticks: DataFrame, table: str, store: str, checkpoint: str, candle: Callable[[DataFrame], DataFrame] = candles.ohlcv, width: str = "1 minute", keys: tuple[str, ...] = ("symbol",), ts: str = "exchange_ts", trigger: dict | None = None, application: str | None = None) -> StreamingQuery:
    """Ticks into ``table`` by date, and their candles in a store that late ticks refresh (see ``sources.rollup``).

    A batch adds its ticks, then notes their buckets, then makes the stale candles anew;
    each step may be run again.
    """

    def write(batch: DataFrame, number: int) -> None:
        name = _application(batch, application)
        batch.persist()
        try:
            journal.append_batch(batch.withColumn("date", F.date_format(ts, "yyyy-MM-dd")), table, ["date"], name, number)
            rollup.log_touched(batch, store, number, name, width, keys, ts)
        finally:
            batch.unpersist()
        if journal.Store(batch.sparkSession, table).leaves("", 1):
            stored = batch.sparkSession.read.option("basePath", table).parquet(table)
            rollup.refresh(batch.sparkSession, stored, store, candle, width, keys=keys, ts=ts)

    return ticks.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


#: How late a row may be whose state is kept by symbol and day or by alert.
STATE_LOOKBACK = "1 day"


def reset_stream(rows: DataFrame, counter: str = "session_vol", ts: str = "exchange_ts", tie: str = "kafka_offset", lookback: str = STATE_LOOKBACK) -> DataFrame:
    """(symbol, ts, previous, current, late) where a symbol's cumulative counter went down.

    State is the last time and value of a symbol and day; rows of a batch are put in
    order first, and a row older than the state is late, not a reset. Rows more than
    ``lookback`` late are dropped and counted by Spark. The state of a day goes when the watermark
    has passed its end.
    """
    keyed = event_time(rows, ts).withWatermark(ts, lookback)
    day = F.to_date(ts)
    keyed = keyed.select(ts, "symbol", day.alias("day"), F.unix_micros(F.col(ts)).alias("us"), F.coalesce(F.col(tie).cast("bigint"), F.lit(-1)).alias("tie"), F.col(counter).cast("bigint").alias("value"), F.unix_millis(F.date_add(day, 1).cast("timestamp")).alias("until")).filter("value IS NOT NULL")

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        last_us, last_tie, last = state.get if state.exists else (None, None, None)
        own = pd.concat([f[["us", "tie", "value", "until"]] for f in frames]).sort_values(["us", "tie"])
        late = (own["us"] < last_us) | ((own["us"] == last_us) & (own["tie"] < last_tie)) if last is not None else own["us"] != own["us"]
        fresh = own[~late]
        found = own[late].assign(previous=last, late=True)
        if len(fresh):
            before = fresh["value"].shift(fill_value=fresh["value"].iloc[0] if last is None else last)
            down = fresh.assign(previous=before, late=False)[fresh["value"] < before]
            found = pd.concat([found, down]) if len(found) else down
            newest = fresh.iloc[-1]
            state.update((int(newest["us"]), int(newest["tie"]), int(newest["value"])))
            state.setTimeoutTimestamp(max(int(own["until"].iloc[0]), state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame({"symbol": [key[0]] * len(found), "us": found["us"].to_numpy(), "previous": found["previous"].to_numpy(), "current": found["value"].to_numpy(), "late": found["late"].to_numpy()})

    out = keyed.groupBy("symbol", "day").applyInPandasWithState(step, "symbol string, us bigint, previous bigint, current bigint, late boolean", "last_us bigint, last_tie bigint, last bigint", "append", GroupStateTimeout.EventTimeTimeout)
    return out.select("symbol", F.timestamp_micros("us").alias("ts"), "previous", "current", "late")


def alert_stream(states: DataFrame, cooldown_s: int = 300, lookback: str = STATE_LOOKBACK) -> DataFrame:
    """FIRE and RECOVER events from a stream of (key, ts, firing); state survives restarts.

    As in the batch operator, at equal times ok comes before firing, and results without a time or an
    outcome are left out. A key has state while it is active or in its cooldown; an
    inactive key's goes when the watermark has passed the cooldown, as it says no more then.
    """
    machine = quality.AlertFold(cooldown_s * 1000000)
    rows = states.select("key", F.col("ts").cast("timestamp").alias("ts"), "firing").withWatermark("ts", lookback)
    rows = rows.filter(F.col("ts").isNotNull() & F.col("firing").isNotNull()).withColumn("us", F.unix_micros("ts"))

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        active, recovered = state.get if state.exists else (False, None)
        found = []
        own = pd.concat([f[["us", "firing"]] for f in frames]).sort_values(["us", "firing"])
        for us, on in zip(own["us"].tolist(), own["firing"].tolist(), strict=True):
            event, active, recovered = machine.step(on, us, active, recovered)
            if event:
                found.append((us, event))
        until = (recovered + machine.wait) // 1000 + 1 if recovered is not None else 0
        if active or until > state.getCurrentWatermarkMs():
            state.update((active, recovered))
            if not active:
                state.setTimeoutTimestamp(until)
        elif state.exists:
            state.remove()
        yield pd.DataFrame({"key": [key[0]] * len(found), "us": [us for us, _ in found], "event": [e for _, e in found]})

    out = rows.groupBy("key").applyInPandasWithState(step, "key string, us bigint, event string", "active boolean, recovered bigint", "append", GroupStateTimeout.EventTimeTimeout)
    return out.select("key", F.timestamp_micros("us").alias("ts"), "event")


def mark_stream(anomalies: DataFrame, lookback: str = STATE_LOOKBACK) -> DataFrame:
    """(check_name, ts, n_new) for anomalies newer than each check's high-water mark, which moves on with them.

    A mark goes when the watermark has passed it, as all later rows are newer. Frames are
    counted one by one.
    """
    rows = anomalies.select("check_name", F.col("ts").cast("timestamp").alias("ts")).withWatermark("ts", lookback).withColumn("us", F.unix_micros("ts"))

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        mark = state.get[0] if state.exists else None
        newest, n = mark, 0
        for frame in frames:
            us = frame["us"] if mark is None else frame["us"][frame["us"] > mark]
            n += len(us)
            newest = max(newest, int(us.max())) if len(us) and newest is not None else int(us.max()) if len(us) else newest
        if n:
            state.update((newest,))
            state.setTimeoutTimestamp(max(newest // 1000 + 1, state.getCurrentWatermarkMs() + 1))
            yield pd.DataFrame({"check_name": [key[0]], "us": [newest], "n_new": [n]})

    out = rows.groupBy("check_name").applyInPandasWithState(step, "check_name string, us bigint, n_new bigint", "mark bigint", "append", GroupStateTimeout.EventTimeTimeout)
    return out.select("check_name", F.timestamp_micros("us").alias("ts"), "n_new")


def observed(rows: DataFrame, name: str, **counts: Column) -> DataFrame:
    """Rows with named counts that Spark takes as they pass: no second scan. ``counts`` are aggregates."""
    return rows.observe(name, *(c.alias(k) for k, c in counts.items()))


def metrics_of(p) -> list[dict]:
    """One progress report of a query as metric rows: throughput, lateness, state, and what ``observed`` counts."""
    late = sum(s.numRowsDroppedByWatermark for s in p.stateOperators)
    values = {"input_rows": p.numInputRows, "rows_per_s": p.processedRowsPerSecond, "late_rows": late, "state_rows": sum(s.numRowsTotal for s in p.stateOperators), "batch_ms": (p.durationMs or {}).get("triggerExecution", 0)}
    for name, row in (p.observedMetrics or {}).items():
        values |= {f"{name}.{k}": v for k, v in row.asDict().items()}
    return [{"ts": p.timestamp, "service_name": p.name or str(p.id), "metric_name": k, "metric_value": float(v or 0), "label": str(p.batchId)} for k, v in values.items()]


class MetricsListener(StreamingQueryListener):
    """Metric rows of every batch of every query, appended to a table as they come.

    Add it with ``spark.streams.addListener``. A batch's rows are a few; they are written in
    one file, by ``service_name``.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.problems = spark, path, []

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        rows = metrics_of(event.progress)
        try:
            df = self.spark.createDataFrame([(r["ts"], r["service_name"], r["metric_name"], r["metric_value"], r["label"]) for r in rows], "ts string, service_name string, metric_name string, metric_value double, label string")
            df.withColumn("ts", F.to_timestamp("ts")).coalesce(1).write.mode("append").parquet(self.path)
        except Exception as problem:  # a metric that can't be written must not end the query
            self.problems.append(problem)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def progress_metrics(query: StreamingQuery) -> list[dict]:
    """Throughput and lateness of a query's batches as metric rows."""
    out = []
    for p in query.recentProgress:
        late = sum(s.get("numRowsDroppedByWatermark", 0) for s in p["stateOperators"])
        values = {"input_rows": p["numInputRows"], "rows_per_s": p.get("processedRowsPerSecond") or 0.0, "late_rows": late, "batch_ms": p["durationMs"].get("triggerExecution", 0)}
        out += [{"ts": p["timestamp"], "service_name": p.get("name") or p["id"], "metric_name": k, "metric_value": float(v), "label": str(p["batchId"])} for k, v in values.items()]
    return out
