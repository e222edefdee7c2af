"""Column statistics and the row and column filters that follow from them.

Statistics of all columns come from one aggregation, whatever the number of columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Columns that name things, the target, the text put in for a missing category
# description, and the share of cells a row must have.
ID_COLUMNS = ("transaction_id", "card_id", "client_id")
TARGET = "is_fraud"
MISSING_TEXT = {"mcc_description": "unknown"}
MIN_FILLED_SHARE = 0.8


def key_bounds(df: DataFrame, key: str) -> DataFrame:
    return df.agg(F.min(key).alias("lo"), F.max(key).alias("hi"))


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n"))


def drop_sparse_rows(df: DataFrame, share: float = MIN_FILLED_SHARE) -> DataFrame:
    """Keep rows in which at least that share of all columns, rounded down, is filled."""
    return df.dropna(thresh=int(share * len(df.columns)))


def feature_roles(
    df: DataFrame, ids: tuple[str, ...] = ID_COLUMNS, target: str = TARGET
) -> tuple[list[str], list[str]]:
    """(numeric, categorical) feature columns by type. Dates are categories, as they are text
    in a file of merged rows."""
    skip = set(ids) | {target}
    numeric, categorical = [], []
    for field in df.schema.fields:
        if field.name in skip:
            continue
        if isinstance(field.dataType, T.NumericType):
            numeric.append(field.name)
        elif isinstance(field.dataType, (T.StringType, T.DateType)):
            categorical.append(field.name)
    return numeric, categorical


def null_presence(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row: does the column hold a null or, for floating point, a NaN?"""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    tests = []
    for c in columns or df.columns:
        missing = F.col(c).isNull()
        if isinstance(kinds[c], (T.DoubleType, T.FloatType)):
            missing = missing | F.isnan(c)
        tests.append(F.coalesce(F.bool_or(missing), F.lit(False)).alias(c))
    return df.agg(*tests)


def number(c: str) -> Column:
    """The column as double, NaN taken as missing."""
    return F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))


def column_stats(df: DataFrame, columns: list[str]) -> dict[str, dict[str, float]]:
    """Mean, sample and population deviation and null count per numeric column, in one pass."""
    if not columns:
        return {}
    aggs = []
    for i, c in enumerate(columns):
        v = number(c)
        aggs += [
            F.avg(v).alias(f"mean_{i}"),
            F.stddev_samp(v).alias(f"samp_{i}"),
            F.stddev_pop(v).alias(f"pop_{i}"),
            F.count_if(v.isNull()).alias(f"nulls_{i}"),
        ]
    row = df.agg(*aggs).first()
    return {
        c: {kind: row[f"{kind}_{i}"] for kind in ("mean", "samp", "pop", "nulls")} for i, c in enumerate(columns)
    }


def fill_missing_text(df: DataFrame, fills: dict[str, str] | None = None) -> DataFrame:
    return df.na.fill(MISSING_TEXT if fills is None else fills)


def impute_means(df: DataFrame, columns: list[str], stats: dict | None = None) -> DataFrame:
    """Put the column's mean where a number is missing; other columns are left alone."""
    stats = column_stats(df, columns) if stats is None else stats
    gaps = {c: s["mean"] for c, s in stats.items() if s["nulls"] and s["mean"] is not None}
    return df.withColumns({c: F.coalesce(number(c), F.lit(mean)) for c, mean in gaps.items()}) if gaps else df


def constant_columns(df: DataFrame, columns: list[str], stats: dict | None = None) -> list[str]:
    """Numeric columns without spread. Filling gaps with the mean adds none, so statistics from
    before the filling serve as well."""
    stats = column_stats(df, columns) if stats is None else stats
    return [c for c, s in stats.items() if s["pop"] == 0]


def drop_constant_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.drop(*constant_columns(df, columns))
