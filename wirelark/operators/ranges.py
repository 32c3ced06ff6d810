"""Order over all rows without a task that holds them all: ranges, their sizes, and what comes before each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..shared import stored


def ranged(rows: DataFrame, *order: str | Column) -> DataFrame:
    """Rows dealt by ranges of an order, sorted and stored, with ``_range`` and ``_nth`` (the place in it, from 0).

    The table is stored because places have to stay as they are, whatever task is run again.
    """
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    part = F.spark_partition_id()
    return stored(dealt.withColumns({"_range": part, "_nth": F.monotonically_increasing_id() - F.shiftleft(part.cast("long"), 33)}), "ranged")


def before(kept: DataFrame, size: Column) -> Column:
    """What the ranges before a row's own hold in all; one number a range reaches the driver."""
    sizes = {r[0]: r[1] for r in kept.groupBy("_range").agg(size).collect()}
    starts, total = [], 0
    for k in range(max(sizes, default=-1) + 1):
        starts.append(total)
        total += sizes.get(k) or 0
    return F.get(F.lit([*starts, total]), F.col("_range"))


def numbered(rows: DataFrame, *order: str | Column, name: str = "place") -> DataFrame:
    """Rows with their place, from 1, in the order of some columns; rows that are alike in all of them in any order."""
    kept = ranged(rows, *order)
    return kept.withColumn(name, F.col("_nth") + before(kept, F.count(F.lit(1))) + 1).drop("_range", "_nth")
