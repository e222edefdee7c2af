"""Dictionaries whose keys are data: JSON objects and map literals turned into rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swipelake.schemas import JSON_DICTIONARY


def explode_map(df: DataFrame, mapping: Column, key: str, value: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per map entry; a null or empty map gives none."""
    return df.select(*keep, F.explode(mapping).alias(key, value))


def columns_to_rows(df: DataFrame, columns: list[str], key: str, value: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per (row, column): the column's name and its content."""
    names = F.array(*[F.lit(c) for c in columns])
    return explode_map(df, F.map_from_arrays(names, F.array(*[F.col(c) for c in columns])), key, value, keep)


def json_object_to_rows(
    df: DataFrame, text: str, key: str, value: str, keep: tuple[str, ...] = (), key_type: str = "int"
) -> DataFrame:
    """One row per field of a JSON object held as text.

    Fields stay data: no schema of one column per field is ever built. Broken JSON and a key that
    does not fit ``key_type`` fail the query; null text gives no rows.
    """
    parsed = F.from_json(F.col(text), JSON_DICTIONARY, {"mode": "FAILFAST"})
    rows = explode_map(df, parsed, key, value, keep)
    return rows.withColumn(key, F.col(key).cast(key_type))
