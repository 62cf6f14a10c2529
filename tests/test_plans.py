"""Plans keep their shape: one exchange for gap filling, pushed filters, narrow scans."""

from pyspark.sql import functions as F

import __spark_entry__ as entry
from tidemark.operators import candles, silver
from tidemark.plans import views as V


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_gap_fill_shuffles_candles_once(spark, tmp_path):
    b = spark.range(10).select(F.concat(F.lit("S"), "id").alias("symbol"), F.lit("2024-01-02 03:00:00").cast("timestamp_ntz").alias("time"), *(F.lit(1.0).alias(c) for c in ("open", "high", "low", "close")), F.lit(1).cast("bigint").alias("volume"))
    b.write.parquet(str(tmp_path / "b"))
    bars = spark.read.parquet(str(tmp_path / "b"))
    days = spark.sql("SELECT DATE '2024-01-02' AS trading_date")
    text = plan(silver.gap_fill(bars, days, bars.select("symbol")))
    window_side = text.split("Window")[-1]
    assert window_side.count("Exchange hashpartitioning(symbol") - window_side.count("Exchange hashpartitioning(symbol#") <= 1
    assert text.count("REPARTITION_BY_COL") == 1


def test_candles_hash_aggregate_and_read_few_columns(spark, sf_dir):
    text = plan(candles.ohlcv(V.ticks(spark, sf_dir)))
    assert "SortAggregate" not in text and "HashAggregate" in text
    assert "user_id" not in text.split("ReadSchema")[1]


def test_filters_reach_the_scan(spark, sf_dir):
    o = V.table(spark, sf_dir, "orders").filter(F.col("o_orderdate") >= F.lit("1997-01-01").cast("timestamp_ntz")).select("o_orderkey")
    assert "GreaterThanOrEqual(o_orderdate" in plan(o)


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "bucket" in df.columns
    assert set(entry.oracle_sql()) <= set(entry.queries())
