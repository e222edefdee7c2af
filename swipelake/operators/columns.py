"""Column shaping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def trim_column_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.strip() for name in df.columns])


def stamp_date(df: DataFrame, date: str | None = None, column: str = "situation_date") -> DataFrame:
    """Put the load date on every row: the given one, else today's."""
    value = F.current_date() if date is None else F.lit(date).cast("date")
    return df.withColumn(column, value)


def with_year_month(df: DataFrame, date: str = "situation_date") -> DataFrame:
    return df.withColumns({"year": F.year(date), "month": F.month(date)})


def keys_as_text(df: DataFrame, *keys: str) -> DataFrame:
    """Join keys as trimmed text; null stays null."""
    return df.withColumns({k: F.trim(F.col(k).cast("string")) for k in keys})


def prefix_shared(df: DataFrame, taken: list[str], prefix: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Prefix the columns whose names the other join side already has."""
    clash = {c: f"{prefix}{c}" for c in df.columns if c in set(taken) and c not in keep}
    return df.withColumnsRenamed(clash)


def nested(df: DataFrame, columns: list[str], name: str) -> Column:
    return F.struct(*[df[c] for c in columns]).alias(name)
