"""Single rows by key, with their related row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _at_most_one(df: DataFrame, condition: Column, what: str) -> DataFrame:
    """The row that meets the condition, or no row; more than one fails the query.

    The condition reaches the scan, and at most two rows are looked at afterwards.
    """
    found = (
        df.where(condition)
        .limit(2)
        .agg(F.count("*").alias("n"), F.first(F.struct(*df.columns)).alias("row"))
        .where(F.col("n") > 0)
    )
    failure = F.raise_error(F.lit(f"more than one row for {what}"))
    return found.select(F.when(F.col("n") == 1, F.col("row")).otherwise(failure).alias("row")).select("row.*")


def one_or_none(df: DataFrame, key: str, value) -> DataFrame:
    """The row with this key, or no row."""
    return _at_most_one(df, F.col(key) == F.lit(value), key)


def with_related(
    hit: DataFrame, related: DataFrame, foreign_key: str, related_key: str, columns: list[str], name: str
) -> DataFrame:
    """Nest the related row of a single-row ``hit`` as a struct.

    The key travels as a scalar subquery, so it reaches the scan of ``related`` as a filter; what
    is broadcast is the one row found there.
    """
    key = hit.select(foreign_key).scalar()
    partner = _at_most_one(related, F.col(related_key) == key, related_key).select(
        F.col(related_key).alias("_related_key"), F.struct(*columns).alias(name)
    )
    return hit.join(F.broadcast(partner), F.col(foreign_key) == F.col("_related_key"), "left").drop("_related_key")
