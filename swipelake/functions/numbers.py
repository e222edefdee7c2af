"""Buckets, bands, ratios and shares."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from swipelake.functions.text import as_column

# Upper bounds (exclusive) and names of the credit-score bands.
SCORE_BANDS = [(580, "Poor"), (670, "Fair"), (740, "Good")]
TOP_SCORE_BAND = "Excellent"


def width_bucket_floor(col: Column | str, width: int = 10) -> Column:
    """Lower edge of the bucket of the given width, as bigint."""
    return F.floor(as_column(col) / F.lit(width)) * F.lit(width).cast("bigint")


def band(col: Column | str, bounds=None, top: str = TOP_SCORE_BAND) -> Column:
    """Name of the first band whose bound lies above the value; null falls through to ``top``."""
    c = as_column(col)
    chain = None
    for bound, name in bounds if bounds is not None else SCORE_BANDS:
        hit = c < F.lit(bound)
        chain = F.when(hit, name) if chain is None else chain.when(hit, name)
    return F.lit(top) if chain is None else chain.otherwise(top)


def safe_ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Division that gives null for a zero divisor."""
    return F.try_divide(as_column(numerator), as_column(denominator))


def decimal_share_pct(hits: Column, total: Column) -> Column:
    """Percentage that is first rounded to five places as a share, then to two.

    This is what a mean over decimal 1.0 / 0.0 yields, worked out from two counts.
    """
    share = hits.cast("decimal(18,0)") / total.cast("decimal(18,0)")
    return F.round(F.lit(100) * share.cast("decimal(6,5)"), 2).cast("decimal(8,2)")


def double_share_pct(hits: Column, total: Column) -> Column:
    """Percentage of a 0/1 flag in double arithmetic, rounded once."""
    return F.round(F.lit(100) * (hits.cast("double") / total), 2)
