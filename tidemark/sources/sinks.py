"""Repeatable writers on partitioned Parquet.

Where a table is read and replaced in one step, the new rows go to a staging folder
beside it first: Spark can't overwrite files that the same job reads, and a job that
dies leaves the old table whole. Ranges, merges, compactions, whole tables and numbered
batches go through the table's journal (see ``journal``).
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.time import partition_stamp
from ..schemas import LEDGER
from . import journal


def _fs(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


_LOCAL: list[str] = []


def new_place(spark: SparkSession, name: str) -> str:
    """A path for a new table in the shared folder, ``spark.checkpoint.dir``; only a local session may leave that unset."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        if not _LOCAL:
            _LOCAL.append("file://" + tempfile.mkdtemp(prefix="spark-tables-"))
            atexit.register(shutil.rmtree, _LOCAL[0].removeprefix("file://"), True)
        where = _LOCAL[0]
    return f"{where.rstrip('/')}/tidemark-{name}-{uuid.uuid4().hex}"


def table_exists(spark: SparkSession, path: str) -> bool:
    fs, place = _fs(spark, path)
    return fs.exists(place)


def _staged(df: DataFrame, path: str) -> tuple[DataFrame, str]:
    where = f"{path.rstrip('/')}_staging_{uuid.uuid4().hex}"
    df.write.parquet(where)
    return df.sparkSession.read.schema(df.schema).parquet(where), where


def _drop(spark: SparkSession, path: str) -> None:
    fs, place = _fs(spark, path)
    fs.delete(place, True)


def append_partitioned(df: DataFrame, path: str, by: list[str]) -> None:
    """Append; an empty frame writes nothing. Readers merge new columns (``mergeSchema``)."""
    df.write.mode("append").partitionBy(*by).parquet(path)


def overwrite_partitions(df: DataFrame, path: str, by: list[str]) -> None:
    """Replace just the partitions that ``df`` has rows for."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def replace_where(df: DataFrame, path: str, predicate: Column, by: list[str], moved: Callable[[str], None] = lambda _: None) -> None:
    """Delete the rows of the table that meet the predicate, then add ``df``.

    Only partitions with such rows or with new ones are rewritten. They change together:
    the swap of their folders is written to the table's journal first, so a writer that is
    killed leaves the old table or one that ``recover`` makes the new one (see ``journal``).
    """
    spark = df.sparkSession
    if not table_exists(spark, path):
        return append_partitioned(df, path, by)
    journal.recover(spark, path)
    old = spark.read.option("mergeSchema", "true").parquet(path)
    gone = F.coalesce(predicate, F.lit(False))
    touched = old.filter(gone).select(*by).unionByName(df.select(*by)).distinct()
    kept = old.join(touched, by, "left_semi").filter(~gone)
    losing = [journal.unescaped(r["f"].rstrip("/")) for r in _folders(old, None, [], by, gone).toLocalIterator()]
    journal.swap_partitions(kept.unionByName(df, allowMissingColumns=True), path, by, losing, moved)
    return None


def insert_absent(df: DataFrame, path: str, keys: list[str], by: list[str], ts: str | None = None) -> None:
    """Append the rows whose keys the table does not have.

    With ``ts``, a time among the keys, only the stored range of the incoming times is read
    (their bounds, one row, are looked up first); without it, the keys of the whole table.
    """
    spark = df.sparkSession
    if table_exists(spark, path):
        stored = spark.read.parquet(path)
        if ts:
            low, high = df.agg(F.min(ts), F.max(ts)).first()
            stored = stored.filter(F.col(ts).between(F.lit(low), F.lit(high)) | F.lit(low is None))
        df = df.join(stored.select(*keys).distinct(), keys, "left_anti")
    staged, where = _staged(df, path)
    append_partitioned(staged, path, by)
    _drop(spark, where)


def merge(df: DataFrame, path: str, keys: list[str], by: list[str], columns: list[str] | None = None) -> None:
    """Update the rows whose keys are in ``df``, and add the others (an upsert).

    ``keys`` are unique in ``df`` and not null. With ``columns`` only these are updated, and a
    null among the new values keeps the stored one. Only partitions that hold such rows, or
    get new ones, are rewritten, all at once (see ``journal``); a row whose partition
    changes moves.
    """
    spark = df.sparkSession
    if not table_exists(spark, path):
        return append_partitioned(df, path, by)
    journal.recover(spark, path)
    old = spark.read.option("mergeSchema", "true").parquet(path)
    matched = old.join(df.select(*keys), keys, "left_semi")
    touched = matched.select(*by).unionByName(df.select(*by)).distinct()
    losing = [journal.unescaped(r["f"].rstrip("/")) for r in _folders(old, matched, keys, by).toLocalIterator()]
    kept = old.join(touched, by, "left_semi").join(df.select(*keys), keys, "left_anti")
    new = df
    if columns is not None:
        theirs = df.select(*keys, F.lit(True).alias("__new"), *(F.col(c).alias(f"__{i}") for i, c in enumerate(columns)))
        updated = old.join(theirs, keys).select(*(F.coalesce(f"__{columns.index(c)}", c).alias(c) if c in columns else F.col(c) for c in old.columns))
        new = updated.unionByName(df.join(old.select(*keys), keys, "left_anti"), allowMissingColumns=True)
    journal.swap_partitions(kept.unionByName(new, allowMissingColumns=True), path, by, losing)
    return None


def _folders(old: DataFrame, rows: DataFrame | None, keys: list[str], by: list[str], which: Column | None = None) -> DataFrame:
    """(f) partition folders, as URLs have them, of rows of ``old`` that a condition or a table of keys picks: one row each."""
    placed = old.select(*(old.columns), F.regexp_extract("_metadata.file_path", f"((?:[^/]+=[^/]*/){{{len(by)}}})[^/]+$", 1).alias("f"))
    picked = placed.filter(which) if which is not None else placed.join(rows.select(*keys).distinct(), keys, "left_semi")
    return picked.select("f").distinct()


def replace_table(df: DataFrame, path: str, moved: Callable[[str], None] = lambda _: None) -> None:
    """The whole table anew; an empty frame is refused.

    The new files are complete and noted in the table's journal before an old one is moved.
    """
    if df.isEmpty():
        raise ValueError("an empty frame would clear the table")
    journal.replace_all(df, path, moved=moved)
    df.sparkSession.catalog.refreshByPath(path)


def daily_snapshot(df: DataFrame, path: str, day: str) -> None:
    """A keyed table's state as the ``date`` partition of a day, replaced if written again."""
    overwrite_partitions(df.withColumn("date", F.lit(day)), path, ["date"])


def archive_day(messages: DataFrame, path: str, epoch_columns: list[str], ts: str, tz: str, keys: list[str] | None = None) -> None:
    """Replayed records to bronze: epoch milliseconds to times, date stamp, append.

    With ``keys`` (such as topic, partition and offset) records that are there already
    are left out, so that a day may be archived again.
    """
    from ..functions.normalize import epoch_columns as to_times

    timed = to_times(messages, *epoch_columns).withColumn("date", partition_stamp(ts, tz))
    if keys:
        insert_absent(timed.dropDuplicates(keys), path, keys, ["date"])
    else:
        append_partitioned(timed, path, ["date"])


#: Bytes of a file after compaction, and cells that each column of a Z-order is cut into.
FILE_BYTES, CELLS = 128 << 20, 64


def cell_bounds(rows: DataFrame, column: str, cells: int = CELLS) -> list:
    """Lower bounds of equally full ranges of a column, from a sample that Spark draws; at most ``cells`` rows reach the driver."""
    ranged = rows.select(F.col(column).alias("v")).filter("v IS NOT NULL").repartitionByRange(cells, "v")
    lows = ranged.groupBy(F.spark_partition_id()).agg(F.min("v").alias("v")).collect()
    return sorted({r["v"] for r in lows})[1:]


def z_value(bounds: dict[str, list], cells: int = CELLS) -> Column:
    """Interleaved bits of the cells that columns lie in: near in any column is near in the order. Nulls lie in the first cell."""
    bits = (cells - 1).bit_length()
    out = F.lit(0).cast("bigint")
    for k, (column, lows) in enumerate(bounds.items()):
        cell = F.coalesce(sum((F.when(F.col(column) >= F.lit(low), 1).otherwise(0) for low in lows), F.lit(0)), F.lit(0)).cast("bigint")
        for bit in range(bits):
            out = out.bitwiseOR(F.shiftleft(F.shiftright(cell, bit).bitwiseAND(F.lit(1).cast("bigint")), bit * len(bounds) + k))
    return out


def folder_bytes(spark: SparkSession, path: str) -> int:
    fs, place = _fs(spark, path)
    return fs.getContentSummary(place).getLength() if fs.exists(place) else 0


def compact(spark: SparkSession, path: str, day: str, cluster: str | list[str] = "symbol", order: str = "exchange_ts", files: int | None = None, file_bytes: int = FILE_BYTES) -> int:
    """Rewrite a date partition as files of about ``file_bytes`` (or as so many); how many are asked for.

    With one column rows are clustered by it; with several by their Z-order, so that a filter
    on any of them reads a fraction of the files. Within a file rows are in order of the
    columns and ``order``. Readers see the old files or the new ones.
    """
    columns = [cluster] if isinstance(cluster, str) else list(cluster)
    journal.recover(spark, path)
    files = files or max(1, -(-folder_bytes(spark, f"{path.rstrip('/')}/date={day}") // file_bytes))
    rows = spark.read.option("mergeSchema", "true").parquet(path).filter(F.col("date").cast("string") == day).withColumn("date", F.lit(day))
    if len(columns) == 1:
        dealt = rows.repartitionByRange(files, *columns).sortWithinPartitions(*columns, order)
    else:
        z = z_value({c: cell_bounds(rows, c) for c in columns})
        dealt = rows.withColumn("__z", z).repartitionByRange(files, "__z").sortWithinPartitions("__z", order).drop("__z")
    journal.swap_partitions(dealt, path, ["date"])
    return files


def prune(rows: DataFrame, keep_days: int, as_of: Column, ts: str = "exchange_ts") -> DataFrame:
    """Rows that retention keeps."""
    return rows.filter(F.col(ts) >= as_of - F.make_dt_interval(days=F.lit(keep_days)))


def drop_old_partitions(spark: SparkSession, path: str, before: str) -> int:
    """Remove whole ``date`` partitions before a day; how many went."""
    fs, place = _fs(spark, path)
    old = [s.getPath() for s in fs.listStatus(place) if s.getPath().getName().startswith("date=") and s.getPath().getName()[5:] < before]
    for p in old:
        fs.delete(p, True)
    return len(old)


def empty_ledger(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], LEDGER)


def pending(ranges: DataFrame, ledger: DataFrame, keys: tuple[str, ...] = ("symbol", "data_type", "range_start", "range_end")) -> DataFrame:
    """Ranges that the ledger does not have as done, with the token to resume from."""
    last = ledger.groupBy(*keys).agg(F.max_by("next_token", "page").alias("resume_token"), F.max("page").alias("last_page"), F.max("done").alias("__done"))
    return ranges.join(last, list(keys), "left").filter(~F.coalesce("__done", F.lit(False))).drop("__done")


def clear_overlapping(ledger: DataFrame, ranges: DataFrame, keys: tuple[str, ...] = ("symbol", "data_type")) -> DataFrame:
    """The ledger without entries that overlap a range of the same key."""
    asked = ranges.select(*keys, F.col("range_start").alias("__from"), F.col("range_end").alias("__to"))
    overlap = (F.col("range_start") <= F.col("__to")) & (F.col("range_end") >= F.col("__from"))
    match = overlap
    for k in keys:
        asked = asked.withColumnRenamed(k, f"__{k}")
        match = match & (F.col(k) == F.col(f"__{k}"))
    return ledger.join(asked, match, "left_anti")
