"""Sparse vectors as columns: a struct of positions and values, and the ML vector that is stored as that struct."""

from __future__ import annotations

import uuid

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from swipelake.session import ensure_checkpoint_dir, release_shuffles, remove_folder

# The marks of the two kinds of ML vectors.
SPARSE, DENSE = 0, 1


def sparse_struct(size: Column, indices: Column, values: Column) -> Column:
    """The struct behind a sparse ML vector; positions ascend."""
    return F.struct(
        F.lit(SPARSE).cast("tinyint").alias("type"), size.cast("int").alias("size"), indices.cast("array<int>").alias("indices"), values.cast("array<double>").alias("values")
    )


def entries(vector: Column) -> Column:
    """(size, indices, values) of an ML vector, its zeros left out; null of a null vector."""
    held = F.unwrap_udt(vector)
    places = F.when(held["type"] == DENSE, F.sequence(F.lit(0), F.size(held["values"]) - 1)).otherwise(held["indices"])
    places = F.when((held["type"] == DENSE) & (F.size(held["values"]) == 0), F.array().cast("array<int>")).otherwise(places)
    kept = F.filter(F.arrays_zip(places.alias("i"), held["values"].alias("v")), lambda e: (e["v"] != 0) | F.isnan(e["v"]))
    size = F.when(held["type"] == DENSE, F.size(held["values"])).otherwise(held["size"])
    return F.when(
        held.isNotNull(),
        F.struct(size.alias("size"), F.transform(kept, lambda e: e["i"]).alias("indices"), F.transform(kept, lambda e: e["v"]).alias("values")),
    )


def read_with_vectors(df: DataFrame, path: str, columns: list[str]) -> DataFrame:
    """Parquet written from ``df``, with these struct columns as ML vectors."""
    kinds = [T.StructField(f.name, VectorUDT() if f.name in columns else f.dataType) for f in df.schema.fields]
    return df.sparkSession.read.schema(T.StructType(kinds)).parquet(path)


def stored_vectors(df: DataFrame, columns: list[str], path: str | None = None) -> DataFrame:
    """Store ``df`` as Parquet (by default in the checkpoint folder) and read the struct columns back as ML vectors.

    A vector column is stored as its struct, so nothing is converted and no Python runs. A file at a ``path`` of its own is
    written once more from there, so that any reader finds vectors in it.
    """
    spark = df.sparkSession
    folder = f"{ensure_checkpoint_dir(spark)}/vectors-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(folder)
    stored = read_with_vectors(df, folder, columns)
    del df
    release_shuffles(spark)
    if path is None:
        return stored
    stored.write.mode("overwrite").option("compression", "zstd").parquet(path)
    remove_folder(spark, folder)
    return spark.read.schema(stored.schema).parquet(path)
