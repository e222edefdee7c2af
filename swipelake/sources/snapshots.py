"""Raw data in dated snapshots: ``<root>/situation_date=YYYY-MM-DD/...``.

A day counts from when its load has published it (see ``manifests``). Under a root that was never written here, with no
manifests beside it, every day counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from swipelake.operators.columns import stamp_date
from swipelake.sources import manifests
from swipelake.sources.files import csv_reader, write_partitioned

SNAPSHOT = "situation_date"
_DATE_GLOB = "[0-9][0-9][0-9][0-9]-[0-9][0-9]-[0-9][0-9]"


class NoSnapshot(FileNotFoundError):
    pass


class ChangedSource(RuntimeError):
    """Other rows were written than had been counted; the days stay unpublished."""


def snapshot_dates(spark: SparkSession, root: str) -> list[str]:
    """Dates under ``root``, oldest first; other entries do not count.

    One listing of the root's own entries. Reading the root as a table would list every file of
    every date first.
    """
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{SNAPSHOT}={_DATE_GLOB}")
    file_system = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = file_system.globStatus(pattern) or []
    return sorted(status.getPath().getName().split("=", 1)[1] for status in found if status.isDirectory())


def whole_dates(spark: SparkSession, root: str) -> list[str]:
    """Dates whose load is complete, oldest first."""
    found, published = snapshot_dates(spark, root), manifests.published_dates(spark, root)
    return found if published is None else sorted(set(found) & set(published))


def latest_date(spark: SparkSession, root: str) -> str:
    dates = whole_dates(spark, root)
    if not dates:
        raise NoSnapshot(f"no whole {SNAPSHOT}= directory under {root}")
    return dates[-1]


def read_snapshot(
    spark: SparkSession,
    root: str,
    fmt: str,
    schema: T.StructType | None = None,
    date: str | None = None,
    keep_date: bool = False,
    infer: bool = True,
) -> DataFrame:
    """The rows of one snapshot, by default the latest; directories below the date become columns."""
    leaf = f"{root}/{SNAPSHOT}={date or latest_date(spark, root)}"
    if fmt == "csv":
        reader = csv_reader(spark, schema, infer).format(fmt)
    else:
        reader = spark.read.format(fmt) if schema is None else spark.read.format(fmt).schema(schema)
    if keep_date:
        reader = reader.option("basePath", root)
    return reader.load(leaf)


def write_snapshot(
    df: DataFrame, root: str, fmt: str, date: str | None = None, below: tuple[str, ...] = (), mode: str = "dynamic"
) -> dict[str, int]:
    """Stamp the load date unless the rows carry one, write by it, and publish the days written: {date: rows}.

    The rows of a stamped load are counted while it is written. Rows that carry their dates are counted by date first, in one
    pass over that column, which also tells the days to withdraw; the number written must be the same. An appended day's rows
    add up. A stamped load without rows leaves its date without rows, too, unless it appends.
    """
    spark = df.sparkSession
    if SNAPSHOT in df.columns and date is None:
        dated = df
        rows = {None if r[0] is None else str(r[0]): r["n"] for r in df.groupBy(SNAPSHOT).agg(F.count("*").alias("n")).collect()}
    else:
        day = date or str(spark.range(1).select(F.current_date()).first()[0])
        dated, rows = stamp_date(df, day, SNAPSHOT), {day: None}
    days = [d for d in rows if d is not None]
    before = {d: _rows_before(spark, root, d, fmt) for d in days} if mode == "append" else dict.fromkeys(days, 0)
    manifests.withdraw(spark, root, None if mode == "static" else days)
    if mode == "dynamic" and dated is not df and df.isEmpty():  # reads a first row only; a write would leave the date as it was
        old = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{SNAPSHOT}={day}")
        old.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(old, True)
        return {day: 0}
    written = write_partitioned(dated, root, fmt, [SNAPSHOT, *below], mode)
    if dated is not df:
        rows = {day: written}
    elif written != sum(rows.values()):
        raise ChangedSource(f"{written} rows written to {root}, {sum(rows.values())} counted before")
    total = {d: n + before[d] for d, n in rows.items() if d is not None}
    for d, n in total.items():
        manifests.publish(spark, root, f"{root}/{SNAPSHOT}={d}", d, n)
    return total


def _rows_before(spark: SparkSession, root: str, day: str, fmt: str) -> int:
    """Rows a day has: by its manifest, else counted."""
    known = manifests.rows_of(spark, root, day)
    if known is not None:
        return known
    return read_snapshot(spark, root, fmt, date=day, infer=False).count() if day in snapshot_dates(spark, root) else 0


def latest_rows(df: DataFrame, date: str = SNAPSHOT) -> DataFrame:
    """Rows of the greatest date of a table. The date is a scalar subquery over that one column:
    it prunes partitions, or reaches the scan as a pushed filter."""
    return df.where(F.col(date) == df.agg(F.max(date).alias("latest")).scalar())
