"""Rows in a global order, and running totals along it, without a task that holds a whole group."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keelson.llm.common import cut

PART_BITS = 33  # of monotonically_increasing_id


def in_order(df: DataFrame, *order: str) -> DataFrame:
    """df range-sorted, with `place`, which rises along the order; its upper bits are the range. Written, so that places stay as they are."""
    return cut(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id()))


def part_of(place: str) -> Column:
    return F.shiftright(place, PART_BITS)


def running(rows: DataFrame, group: str, add: Callable[..., Column], join: Callable[[Column, Column], Column], **values: Column) -> DataFrame:
    """rows with a running total of each value within the group, the row itself included.

    rows have places, in an order that begins with the group (not null). Totals run inside ranges; what the ranges before
    add is known from a total of each group and range, and only groups that lie in several ranges need it: at most two
    for each range, so they are broadcast.
    """
    rows = rows.withColumn("part_", part_of("place"))
    totals = rows.groupBy(group, "part_").agg(*[add(v).alias(k) for k, v in values.items()])
    before = Window.partitionBy(group).orderBy("part_").rowsBetween(Window.unboundedPreceding, -1)
    spread = totals.withColumn("parts_", F.count(F.lit(1)).over(Window.partitionBy(group))).where("parts_ > 1")
    spread = spread.select(group, "part_", *[add(k).over(before).alias(f"{k}_before_") for k in values])
    here = Window.partitionBy(group, "part_").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = rows.withColumns({k: add(v).over(here) for k, v in values.items()}).join(F.broadcast(spread), [group, "part_"], "left")
    out = out.withColumns({k: join(F.col(k), F.coalesce(F.col(f"{k}_before_"), F.lit(0))) for k in values})
    return out.drop("part_", *[f"{k}_before_" for k in values])
