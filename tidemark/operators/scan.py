"""Ordered computations over keys whose history no single task should sort.

Each key is cut by time into slices of one width. Rows are put in order within a slice
only; what a slice passes on (its last row, its last mark) is one row a slice, and only
these rows are put in order over a key. A key that holds all rows is worked by as many
tasks as it has slices. Results don't depend on the width.

Cases: rows without a time form one slice before all others, as nulls come first in
Spark's order; values may be null and are passed on as such.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Seconds of a slice.
SLICE_S = 3600


def slice_of(ts: str, seconds: int = SLICE_S) -> Column:
    return F.floor(F.unix_micros(F.col(ts).cast("timestamp")) / (seconds * 1_000_000))


def lag(rows: DataFrame, keys: list[str], order: list[str], values: dict[str, str], seconds: int = SLICE_S) -> DataFrame:
    """``rows`` with the values of the row before in ``order``, under new names.

    ``order`` starts with a time. The first row of a slice takes the last row of the
    nearest slice before it that has rows.
    """
    keys = list(keys)
    cut = rows.withColumn("__slice", slice_of(order[0], seconds))
    within = Window.partitionBy(*keys, "__slice").orderBy(*order)
    own = F.struct(*(F.col(v).alias(n) for n, v in values.items()))
    marked = cut.withColumns({"__before": F.lag(own).over(within), "__last": F.lead(F.lit(1)).over(within).isNull()})
    over = Window.partitionBy(*keys).orderBy("__slice")
    ends = marked.filter("__last").select(*keys, "__slice", own.alias("__own"))
    carried = ends.select(*(F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)), F.col("__slice").alias("__at"), F.lag("__own").over(over).alias("__carry")).filter("__carry IS NOT NULL")
    match = F.col("__slice").eqNullSafe(F.col("__at"))
    for i, k in enumerate(keys):
        match = match & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    both = marked.join(carried, match, "left")
    before = F.coalesce("__before", "__carry")
    return both.select(*rows.columns, *(before[n].alias(n) for n in values))


def last_mark(rows: DataFrame, keys: list[str], order: list[str], mark: str, name: str, seconds: int = SLICE_S) -> DataFrame:
    """``rows`` with the newest value of ``mark`` that isn't null, up to and with each row."""
    keys = list(keys)
    cut = rows.withColumn("__slice", slice_of(order[0], seconds))
    within = Window.partitionBy(*keys, "__slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    marked = cut.withColumn("__mark", F.last(mark, ignorenulls=True).over(within))
    # of rows without a mark the order is null, which max_by passes over; a slice without marks still takes part
    marks = F.max_by(mark, F.when(F.col(mark).isNotNull(), F.struct(*order)))
    ends = cut.groupBy(*keys, "__slice").agg(marks.alias("__own"))
    before = Window.partitionBy(*keys).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(*(F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)), F.col("__slice").alias("__at"), F.last("__own", ignorenulls=True).over(before).alias("__carry")).filter("__carry IS NOT NULL")
    match = F.col("__slice").eqNullSafe(F.col("__at"))
    for i, k in enumerate(keys):
        match = match & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    return marked.join(carried, match, "left").select(*rows.columns, F.coalesce("__mark", "__carry").alias(name))


def trailing_sum(rows: DataFrame, keys: list[str], ts: str, value: str, seconds: int, name: str) -> DataFrame:
    """``rows`` with the sum of ``value`` over the trailing ``seconds`` of each row (both ends count).

    Slices are as wide as the window. A window is then the rows of its slice up to now, and
    the rows of the slice before from the window's start on; these are sent once more, later
    by the width, and summed from the slice's end. Both are running sums, so the work of a
    row doesn't grow with the rows of its window, and nothing is subtracted.
    """
    keys, width = list(keys), seconds * 1_000_000
    us = rows.withColumn("__us", F.unix_micros(F.col(ts).cast("timestamp")))
    # rows without a time are peers of one another, once
    sent = us.withColumn("__moved", F.explode(F.when(F.col("__us").isNull(), F.array(F.lit(0))).otherwise(F.array(F.lit(0), F.lit(1)))))
    own = F.col("__moved") == 0
    at = F.col("__us") + F.col("__moved") * F.lit(width).cast("long")
    # of a row sent once more only the keys, the time and the value are needed
    slim = sent.select(*(F.col(c) if c in (*keys, value) else F.when(own, F.col(c)).alias(c) for c in rows.columns), "__moved", at.alias("__at"))
    placed = slim.withColumn("__slice", F.col("__at") - F.pmod("__at", F.lit(width).cast("long")))
    slices = Window.partitionBy(*keys, "__slice")
    upto = slices.orderBy("__at").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    since = slices.orderBy(F.desc("__at")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    summed = placed.withColumns({"__upto": F.sum(F.when(own, F.col(value))).over(upto), "__since": F.sum(F.when(~own, F.col(value))).over(since)})
    total = F.coalesce(F.col("__upto") + F.col("__since"), "__upto", "__since")
    return summed.filter(own).select(*rows.columns, total.alias(name))
