"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from swipelake.session import ensure_checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def store(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder and read it back.

    The lineage ends there: a lost executor costs a read of the files. They go with the session.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop_path)
    return spark.read.schema(df.schema).parquet(path)


def drop(stored: DataFrame) -> None:
    """Delete a stored table that nothing will read again."""
    spark = stored.sparkSession
    for file in stored.inputFiles()[:1]:
        folder = spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def fold_of(key: str, folds: int) -> Column:
    """crc32 of the key as text, modulo ``folds``; a null key counts as empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % folds


def positional(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` under names by position, which clash with nothing, and the new name of each column."""
    names = {c: f"column_{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


SMALL_ROWS = 20_000


def small(stored: DataFrame, rows: int = SMALL_ROWS) -> DataFrame:
    """A stored table with a broadcast hint if it is counted to have at most so many rows.

    Beyond that Spark chooses the join by size; the result is the same.
    """
    return F.broadcast(stored) if stored.count() <= rows else stored
