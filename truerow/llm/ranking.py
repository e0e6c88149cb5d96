"""Numbering rows along an order without one task that sees all of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from truerow.llm.common import stored

#: Spark's increasing ids hold the row within its partition in so many lower bits.
_ROW_BITS = 33


def numbered_along(rows: DataFrame, order: Sequence[Column], number: str) -> DataFrame:
    """`number`: 1, 2, 3, ... of every row along the order; equal rows in any order.

    The rows are range-sorted; a partition's first number is the sum of the partitions before it,
    so one count per partition passes the driver.
    """
    place = F.monotonically_increasing_id()
    sorted_rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = stored(sorted_rows.withColumn("_place", place), "numbered")
    part = F.shiftright("_place", _ROW_BITS)
    counts, before = [], 0
    for row in placed.groupBy(part.alias("part")).count().orderBy("part").collect():
        counts.append((row["part"], before))
        before += row["count"]
    starts = rows.sparkSession.createDataFrame(counts, "_part long, _before long")
    row = F.col("_place") - F.shiftleft("_part", _ROW_BITS)
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")
        .withColumn(number, F.col("_before") + row + 1)
        .drop("_place", "_part", "_before")
    )
