"""Catalog tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from swipelake.sources.files import counted

ROWS = "loaded_rows"


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def replace_table(df: DataFrame, name: str) -> int:
    """Create or replace a managed parquet table. The number of rows written, which the table keeps as a property."""
    counting, rows = counted(df)
    counting.write.format("parquet").mode("overwrite").saveAsTable(name)
    df.sparkSession.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{ROWS}' = '{rows()}')")
    return rows()


def loaded_rows(spark: SparkSession, name: str) -> int | None:
    """Rows of the last load, without reading the table."""
    found = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    return int(found[ROWS]) if ROWS in found else None
