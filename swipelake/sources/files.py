"""CSV, JSON and parquet files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, DataFrameReader, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from swipelake import schemas

# One entry of a flat JSON object of labels, for instance  "10649266": "No", with what may stand around it:
# opening braces and the name of the object, closing braces. Runs are possessive: no text can exhaust the stack.
LABEL_ENTRY = (
    r'^[\s{]*(?:"(?:[^"\\]++|\\.)*+"\s*:\s*\{\s*)?"(-?\d+)"\s*:\s*'
    r'("(?:[^"\\]++|\\.)*+"|null|true|false|-?[0-9][0-9.eE+-]*)[\s}]*$'
)
NO_ENTRY = r'^[\s{}]*(?:"(?:[^"\\]++|\\.)*+"\s*:\s*\{)?[\s{}]*$'


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None, infer: bool = True) -> DataFrame:
    """CSV with a header line. Without a schema the types are inferred, at the cost of a second pass."""
    return csv_reader(spark, schema, infer).csv(path)


def csv_reader(spark: SparkSession, schema: T.StructType | None, infer: bool = True) -> DataFrameReader:
    """A header that does not name the schema's columns in their order fails the read. Without
    schema and inference all columns are text, read in one pass."""
    reader = spark.read.option("header", True)
    return reader.schema(schema).option("enforceSchema", False) if schema else reader.option("inferSchema", infer)


def read_json(spark: SparkSession, path: str, multi_line: bool = False, schema: T.StructType | None = None) -> DataFrame:
    """JSON, one object per line or per file; malformed rows come out as nulls."""
    reader = spark.read.option("mode", "PERMISSIVE").option("multiLine", multi_line)
    return (reader.schema(schema) if schema else reader).json(path)


def read_json_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """Column ``entries``: each file's JSON object as a map, whatever its fields are. For small
    dictionaries: a file is parsed in one piece, and a broken one fails the query."""
    text = spark.read.text(path, wholetext=True)
    return text.select(F.from_json("value", schemas.JSON_DICTIONARY, {"mode": "FAILFAST"}).alias("entries"))


def read_label_object(spark: SparkSession, path: str) -> DataFrame:
    """(id, target) from one JSON object with a field per transaction id.

    Such a file has an entry per transaction and no lines. It is read in splits with the comma
    as record separator, so that neither a task nor the schema ever holds the whole object.
    Texts may hold commas and escapes; the literal null gives null, numbers and truth values their
    text. A piece that is neither an entry nor braces fails the query: no entry is ever left out.
    """
    pieces = spark.read.option("lineSep", ",").text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),  # ascending within a block
    )
    bare = F.regexp_replace("value", r"\\.", "")
    pieces = pieces.withColumn("quotes", F.length(bare) - F.length(F.replace(bare, F.lit('"'), F.lit(""))))
    if pieces.where("quotes % 2 = 1").head(1):
        pieces = _joined_at_commas(pieces)
    entry = F.col("value").rlike(LABEL_ENTRY)
    broken = F.raise_error(F.concat(F.lit("not a label entry: "), F.left("value", F.lit(200))))
    whole = pieces.where(F.when(F.col("value").rlike(NO_ENTRY), False).when(entry, True).otherwise(broken.cast("boolean")))
    value = F.regexp_extract("value", LABEL_ENTRY, 2)
    text = F.from_json(F.concat(F.lit("["), value, F.lit("]")), "array<string>", {"mode": "FAILFAST"})
    return whole.select(F.regexp_extract("value", LABEL_ENTRY, 1).cast("bigint").alias("id"), text[0].alias("target"))


def _joined_at_commas(pieces: DataFrame) -> DataFrame:
    """Put pieces together again that a comma inside a text has parted.

    A piece goes on inside a text when an odd number of quotes stands before it in its file. Quotes
    are summed up by block of the file, and within a block; a block is one task's share of the file.
    """
    blocks = pieces.groupBy("file", "block").agg(F.sum("quotes").alias("in_block"))
    by_file = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.withColumn("before_block", F.coalesce(F.sum("in_block").over(by_file), F.lit(0))).drop("in_block")
    in_block = Window.partitionBy("file", "block").orderBy("place")
    before = F.coalesce(F.sum("quotes").over(in_block.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    marked = pieces.join(starts, ["file", "block"]).withColumn("opens", (F.col("before_block") + before) % 2 == 0)
    numbered = marked.withColumn("entry", F.sum(F.col("opens").cast("long")).over(in_block.rowsBetween(Window.unboundedPreceding, 0)))
    # What opens a block in the middle of a text belongs to the last entry before it, some blocks back.
    last = numbered.groupBy("file", "block").agg(F.max("entry").alias("last_entry"))
    open_block = F.last(F.when(F.col("last_entry") > 0, F.struct("block", "last_entry")), ignorenulls=True).over(by_file)
    previous = last.withColumn("owner", open_block).select("file", "block", "owner")
    owned = numbered.join(previous, ["file", "block"]).withColumn(
        "owner", F.when(F.col("entry") > 0, F.struct("block", F.col("entry").alias("last_entry"))).otherwise(F.col("owner"))
    )
    alone = owned.where("opens and quotes % 2 = 0").select("value")
    parted = owned.where("not (opens and quotes % 2 = 0)").groupBy("file", "owner").agg(
        F.array_sort(F.collect_list(F.struct("block", "place", "value"))).alias("parts")
    )
    return alone.union(parted.select(F.array_join(F.transform("parts", lambda x: x["value"]), ",").alias("value")))


def even_files(df: DataFrame, *columns: str) -> DataFrame:
    """Bring rows of the same output directory together without making one task write it all:
    adaptive execution splits a large directory over tasks and merges small ones."""
    return df.hint("rebalance", *columns)


def counted(df: DataFrame) -> tuple[DataFrame, Callable[[], int]]:
    """``df``, and the number of its rows once it is written: counted on the way, not by a second pass.

    To be called on what is written as it is, after any exchange: a task of the writing stage counts once, also if it ran again.
    """
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), lambda: int(seen.get.get("rows", 0))


def write_partitioned(
    df: DataFrame, path: str, fmt: str, partitions: list[str], mode: str = "dynamic", shuffle: bool = True
) -> int:
    """Write by partition columns; the number of rows written.

    ``dynamic`` replaces the partitions that ``df`` holds rows for, so a repeated load leaves its
    rows once; ``static`` replaces everything under ``path``; ``append`` adds.
    """
    if mode not in ("dynamic", "static", "append"):
        raise ValueError(f"unknown mode {mode}")
    df, rows = counted(even_files(df, *partitions) if shuffle else df)
    writer = df.write.partitionBy(*partitions).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    if mode == "append":
        writer = writer.mode("append")
    else:
        writer = writer.mode("overwrite").option("partitionOverwriteMode", mode)
    writer.save(path)
    return rows()


def write_parquet(df: DataFrame, path: str, max_files: int | None = None) -> int:
    """Snappy parquet, replaced; ``max_files`` is an upper bound that also bounds the tasks. The number of rows written."""
    out, rows = counted(even_files(df) if max_files is None else df.coalesce(max_files))
    out.write.mode("overwrite").option("compression", "snappy").parquet(path)
    return rows()
