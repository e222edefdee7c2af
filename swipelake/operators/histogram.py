"""Counts per key range: where does the n-th row lie, where to cut a key range into equal loads.

Both walk down from the whole key range: count the rows of some thousand equal-width ranges
(a partial aggregation, at most that many rows come back), keep the range in question, repeat
inside it. Unevenly spread keys only cost another round.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from swipelake.session import cut_lineage

RANGES = 2048

# (low, width, number of ranges) -> {range number: rows}, for keys in [low, low + width * ranges)
RangeCounts = Callable[[int, int, int], dict[int, int]]


def range_counts(df: DataFrame, key: str) -> RangeCounts:
    def count(low: int, width: int, ranges: int) -> dict[int, int]:
        k = F.col(key)
        inside = df.where((k >= F.lit(low)) & (k <= F.lit(low + width * ranges - 1)))
        number = F.floor((k.cast("decimal(20,0)") - F.lit(low)) / F.lit(width)).cast("bigint")
        return {r["r"]: r["n"] for r in inside.groupBy(number.alias("r")).agg(F.count("*").alias("n")).collect()}

    return count


def narrow_to_offset(df: DataFrame, key: str, offset: int, few_rows: int) -> tuple[DataFrame, int]:
    """A filter on ``key`` and a smaller offset that together name the same place in key order.

    ``key`` holds whole numbers and no nulls."""
    edge = df.agg(F.min(key).alias("lo"), F.max(key).alias("hi")).first()
    if edge["lo"] is None:
        return df, offset
    low, high = int(edge["lo"]), int(edge["hi"])
    counts = range_counts(df, key)
    while offset > few_rows and high > low:
        width = -(-(high - low + 1) // RANGES)
        ranges = -(-(high - low + 1) // width)
        found = counts(low, width, ranges)
        for number in sorted(found):
            if offset < found[number]:
                low, high = low + number * width, min(high, low + (number + 1) * width - 1)
                break
            offset -= found[number]
        else:  # beyond the last row
            return df.where(F.col(key) > F.lit(high)), 0
    return df.where(F.col(key) >= F.lit(low)), offset


def narrow_by_ranges(df: DataFrame, key: str, offset: int, few_rows: int) -> tuple[DataFrame, int]:
    """As ``narrow_to_offset`` for keys of any type that can be ordered: the keys of one range.

    Keys are dealt to ranges of about ``few_rows`` and stored with their range, so that all reads
    see the same ranges; one count per range comes back.
    """
    ranges = -(-df.count() // max(few_rows, 1))
    if ranges < 2:
        return df, offset
    dealt = cut_lineage(df.repartitionByRange(ranges, key).select(key, F.spark_partition_id().alias("_range")))
    counts = {r["_range"]: r["n"] for r in dealt.groupBy("_range").agg(F.count("*").alias("n")).collect()}
    for number in sorted(counts):
        if offset < counts[number]:
            # The page may run on into the next ranges.
            return dealt.where(F.col("_range") >= number).select(key), offset
        offset -= counts[number]
    return df.limit(0), 0


def equal_load_cuts(counts: RangeCounts, low: int, high: int, parts: int) -> list[int]:
    """Keys that cut [low, high] into at most ``parts`` ranges of about the same number of rows.

    Rows are counted in steps that should each hold well under one part; a step that holds more
    is counted again in finer ones.
    """
    steps = max(RANGES, 16 * parts)
    pieces: list[tuple[int, int]] = []  # (first key, rows), in key order
    total = None
    todo = [(low, high)]
    while todo:
        lo, hi = todo.pop()
        width = -(-(hi - lo + 1) // steps)
        found = counts(lo, width, -(-(hi - lo + 1) // width))
        if total is None:
            total = sum(found.values())
        for number, rows in found.items():
            first = lo + number * width
            if width > 1 and rows * parts * 8 > total:
                todo.append((first, min(hi, first + width - 1)))
            else:
                pieces.append((first, rows))
    cuts: list[int] = []
    seen = 0
    for first, rows in sorted(pieces):
        if seen * parts >= total * (len(cuts) + 1) and len(cuts) < parts - 1:
            cuts.append(first)
        seen += rows
    return cuts
