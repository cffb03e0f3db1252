"""Running figures along timelines of any length, by prefix sums over range partitions.

Rows are dealt by (group, order) into slices of bounded size, so that neither a hot group nor a hot instant fills a task. Inside a
slice a window gives the running figure. What the slices before (or after) add to a group is one row per slice and group; only
groups cut by a slice border have any, and these few rows are joined back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ticketlake.session import settle

#: Rows of a slice, more or less.
SLICE_ROWS = 500_000


def sliced(rows: DataFrame, order: Sequence[str], slice_rows: int = SLICE_ROWS) -> tuple[DataFrame, int]:
    """Contiguous runs of the order, numbered in `fatia`, and how many; written, so that the numbers never change."""
    rows = settle(rows)
    parts = max(1, -(-rows.count() // slice_rows))
    if parts == 1:
        return rows.withColumn("fatia", F.lit(0)), 1
    return settle(rows.repartitionByRange(parts, *order).withColumn("fatia", F.spark_partition_id())), parts


def along(
    rows: DataFrame, group: Sequence[str], order: Sequence[str], counted: Column, reached: Column | None = None,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """`rows` with `total`, the `counted` rows of the group up to each row, and `seguinte`, the next `reached` after it.

    `group` columns hold no nulls. `reached` is null or a value that grows with the order; without it there is no `seguinte`.
    """
    ranged, parts = sliced(rows, [*group, *order], slice_rows)
    here = Window.partitionBy("fatia", *group)
    forward = here.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    added = {"total": F.count_if(counted).over(forward)}
    sums = [F.count_if(counted).alias("_n")]
    if reached is not None:
        backward = here.orderBy(*[F.desc(c) for c in order]).rowsBetween(Window.unboundedPreceding, -1)
        added["seguinte"] = F.last(reached, ignorenulls=True).over(backward)
        sums.append(F.min(reached).alias("_primeiro"))
    if parts == 1:  # no border, nothing to carry
        return ranged.withColumns(added).drop("fatia")
    whole = Window.partitionBy(*group)
    earlier = whole.orderBy("fatia").rowsBetween(Window.unboundedPreceding, -1)
    later = whole.orderBy(F.desc("fatia")).rowsBetween(Window.unboundedPreceding, -1)
    carry = {"_antes": F.sum("_n").over(earlier)}
    if reached is not None:
        carry["_depois"] = F.last("_primeiro", ignorenulls=True).over(later)
    borders = (
        ranged.groupBy("fatia", *group).agg(*sums)
        .select("fatia", *group, *[c.alias(n) for n, c in carry.items()])
        .dropna("all", subset=list(carry))
    )
    joined = ranged.withColumns(added).join(borders, ["fatia", *group], "left")
    out = joined.withColumn("total", F.col("total") + F.coalesce("_antes", F.lit(0)))
    if reached is not None:
        out = out.withColumn("seguinte", F.coalesce("seguinte", "_depois"))
    return out.drop("fatia", *carry)
