"""Places in one order over all rows, without a task that sees them all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from taxaloom.session import cut

_ROW_BITS = 33  # of Spark's increasing ids; the number of the partition is above them


def placed(rows: DataFrame, order: list[Column]) -> DataFrame:
    """``rows`` with their ``place`` in ``order``, from 0 and without gaps.

    Rows are dealt into ranges of the order, whose borders Spark takes from a
    sample, and sorted within these. A place is the number of rows in the
    ranges before and the row's number in its own; only the sizes of the ranges,
    one for each partition, reach the driver.
    """
    rows = cut(rows)
    numbered = cut(
        rows.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id())
    )
    split = numbered.withColumn("_range", F.shiftright("_at", _ROW_BITS))
    starts, before = [], 0
    for size in split.groupBy("_range").count().orderBy("_range").collect():
        starts.append((size["_range"], before))
        before += size["count"]
    known = rows.sparkSession.createDataFrame(starts, "_range long, _start long")
    within = F.col("_at").bitwiseAND((1 << _ROW_BITS) - 1)
    # A row for each partition: sent to all tasks, in place of all rows to the tasks of their ranges.
    return split.join(F.broadcast(known), "_range").withColumn("place", F.col("_start") + within).drop("_at", "_range", "_start")
