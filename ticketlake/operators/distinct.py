"""Exact distinct counts that can be stored per day and merged over any period: one bitmap per group and range of ids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Columns of a cell beside its group: the range of 64 ids, and which of them occur (one bit each).
RANGE, MEMBERS = "faixa", "membros"
_BITS = 6


def by_range(cells: DataFrame) -> DataFrame:
    """Rows dealt by their range of ids, so that all merges of a range stay in one task.

    Groups play no part, so a hot one spreads over all tasks; the number of tasks is that of the session's shuffles, and
    not fewer, as each holds a table of its cells.
    """
    return cells.repartition(int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions")), RANGE)


def distinct_cells(df: DataFrame, id_column: Column, by: Sequence[str]) -> DataFrame:
    """Which ids occur in each group; rows whose id is null or negative are left out.

    Counts of days cannot be added up, as an id may come on several days, but these cells can be merged. A cell is a whole
    number, so there are never more bytes of cells than of rows, however few ids of a range a group holds.
    """
    known = df.select(*by, id_column.cast("bigint").alias("_id")).filter("_id >= 0")
    placed = by_range(known.select(*by, F.shiftright("_id", _BITS).alias(RANGE), (F.col("_id") % (1 << _BITS)).cast("int").alias("_bit")))
    return placed.groupBy(*by, RANGE).agg(F.bit_or(F.expr("shiftleft(1L, _bit)")).alias(MEMBERS))


def merge_cells(cells: DataFrame, by: Sequence[str]) -> DataFrame:
    """Cells of coarser groups, or of several stored sets of cells."""
    return cells.groupBy(*by, RANGE).agg(F.bit_or(MEMBERS).alias(MEMBERS))


def count_cells(cells: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    """Distinct ids of each group."""
    return merge_cells(cells, by).groupBy(*by).agg(F.sum(F.bit_count(MEMBERS)).alias(name))
