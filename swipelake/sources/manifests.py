"""Manifests of loads: which days of a snapshot root are whole, and how many rows, files and bytes each has.

They lie beside the root, in ``<root>_published/<date>.json``, so a load that replaces the root leaves them alone. A load withdraws
the manifests of its days before it writes anything, and puts new ones in place by one rename after everything is written.
A reader that goes by them never sees a day whose load is running or has died.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

SCHEMA = T.StructType(
    [T.StructField("date", T.StringType()), *(T.StructField(c, T.LongType()) for c in ("rows", "files", "bytes"))]
)
_END = ".json"


def folder_of(root: str) -> str:
    return f"{root.rstrip('/')}_published"


def _path(spark: SparkSession, path: str):
    """A path and its file system."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def published_dates(spark: SparkSession, root: str) -> list[str] | None:
    """Days with a manifest, oldest first; None for a root that no load with manifests has touched."""
    folder, file_system = _path(spark, folder_of(root))
    if not file_system.exists(folder):
        return None
    names = [status.getPath().getName() for status in file_system.listStatus(folder)]
    return sorted(name.removesuffix(_END) for name in names if name.endswith(_END) and name[0] not in "._")


def withdraw(spark: SparkSession, root: str, dates: list[str] | None = None) -> None:
    """Take back the manifests of these days, or of all. From now on the root's days count only with one."""
    folder, file_system = _path(spark, folder_of(root))
    file_system.mkdirs(folder)
    for date in (published_dates(spark, root) or []) if dates is None else dates:
        file_system.delete(_path(spark, f"{folder_of(root)}/{date}{_END}")[0], False)


def publish(spark: SparkSession, root: str, leaf: str, date: str, rows: int) -> None:
    """Put a day's manifest in place; files and bytes come from one summary of its directory."""
    directory, file_system = _path(spark, leaf)
    files = size = 0
    if file_system.exists(directory):
        found = file_system.listFiles(directory, True)
        while found.hasNext():
            status = found.next()
            if status.getPath().getName()[0] not in "._":
                files, size = files + 1, size + status.getLen()
    text = json.dumps({"date": date, "rows": rows, "files": files, "bytes": size})
    draft, _ = _path(spark, f"{folder_of(root)}/_{uuid.uuid4().hex}")
    out = file_system.create(draft)
    out.write(bytearray(text.encode()))
    out.close()
    final = _path(spark, f"{folder_of(root)}/{date}{_END}")[0]
    if not file_system.rename(draft, final):
        file_system.delete(draft, False)
        raise FileExistsError(f"{final.toString()} is there: two loads of one day at a time")


def manifests(spark: SparkSession, root: str) -> DataFrame:
    """(date, rows, files, bytes), one row per published day."""
    if not published_dates(spark, root):
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).json(folder_of(root))


def rows_of(spark: SparkSession, root: str, date: str) -> int | None:
    """The rows of a published day."""
    if date not in (published_dates(spark, root) or []):
        return None
    return int(spark.read.schema(SCHEMA).json(f"{folder_of(root)}/{date}{_END}").first()["rows"])
