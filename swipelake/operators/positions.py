"""The place of every row in a total order, without bringing the rows to one task.

Rows are dealt to key ranges and sorted there; a row's place is the number of rows in the ranges before its own and its place in
the range. Only one count per range goes through a single task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from swipelake.session import cut_lineage

# monotonically_increasing_id has the partition's number above this bit, and the row's place in the partition below.
_PART_BIT = 33


def ranges_of(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def with_positions(df: DataFrame, order: list[str], position: str = "position", ranges: int | None = None) -> DataFrame:
    """The rows, stored, with their place from 0. Rows that are equal in ``order`` get places in any order."""
    dealt = df.repartitionByRange(ranges or ranges_of(df), *order).sortWithinPartitions(*order)
    numbered = cut_lineage(dealt.withColumn("_place", F.monotonically_increasing_id()))
    part = F.shiftright("_place", _PART_BIT)
    before = F.sum("_rows").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    counts = numbered.groupBy(part.alias("_part")).agg(F.count("*").alias("_rows"))
    starts = F.broadcast(counts.select("_part", F.coalesce(before, F.lit(0)).alias("_before")))  # one row per range
    place = F.col("_before") + F.col("_place").bitwiseAND(F.lit((1 << _PART_BIT) - 1))
    return numbered.join(starts, part == F.col("_part")).withColumn(position, place).drop("_place", "_part", "_before")
