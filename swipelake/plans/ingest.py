"""Bring files and the relational source into the raw zone as dated snapshots."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from swipelake import schemas
from swipelake.operators.columns import with_year_month
from swipelake.session import get_session
from swipelake.sources import files, jdbc, snapshots


def ingest_csv(
    spark: SparkSession, source: str, root: str, schema=None, date: str | None = None, mode: str = "dynamic", infer: bool = True
) -> None:
    """CSV as it is, plus the load date. Earlier dates stay unless ``mode`` is ``static``."""
    snapshots.write_snapshot(files.read_csv(spark, source, schema, infer), root, "csv", date, mode=mode)


def ingest_json_object(
    spark: SparkSession, source: str, root: str, date: str | None = None, mode: str = "dynamic", fields: bool = False
) -> None:
    """A JSON object that may span many lines; one line per object in the raw zone.

    The object's fields are data and are carried as a map. With ``fields`` each becomes a typed
    column first, which suits objects of few and fixed fields.
    """
    if fields:
        snapshots.write_snapshot(files.read_json(spark, source, multi_line=True), root, "json", date, mode=mode)
    else:
        lines = files.read_json_dictionary(spark, source).select(F.to_json("entries").alias("value"))
        snapshots.write_snapshot(lines, root, "text", date, mode=mode)


def ingest_labels(
    spark: SparkSession,
    source: str,
    root: str,
    fmt: str = "csv",
    date: str | None = None,
    mode: str = "dynamic",
) -> None:
    """Fraud labels into one dated dataset, from CSV, JSON rows or one JSON object keyed by id.

    Rows without an id, such as malformed ones, go to ``root`` with ``_malformed`` behind it; of JSON
    rows the text as it came is there, too.
    """
    if fmt == "csv":
        labels = files.read_csv(spark, source, schemas.FRAUD_LABELS)
    elif fmt == "json":
        labels = files.read_json(spark, source, schema=schemas.RAW_FRAUD_LABELS)
    elif fmt == "json_object":
        labels = files.read_label_object(spark, source)
    else:
        raise ValueError(f"unknown label format {fmt}")
    snapshots.write_snapshot(labels.where("id IS NOT NULL").select("id", "target"), root, "parquet", date, mode=mode)
    snapshots.write_snapshot(labels.where("id IS NULL"), f"{root}_malformed", "parquet", date, mode=mode)


def ingest_transactions(source: DataFrame, root: str, mode: str = "dynamic") -> None:
    """Transactions by load date, year and month of that date.

    One load usually holds one date: the write is spread by size, not by the partition columns
    alone. ``append`` keeps the rows of an earlier run of the same date, ``dynamic`` replaces them.
    """
    snapshots.write_snapshot(with_year_month(source), root, "parquet", below=("year", "month"), mode=mode)


def main() -> None:
    args = argparse.ArgumentParser(description="load the raw zone")
    args.add_argument("--raw", required=True, help="root folder of the raw zone")
    args.add_argument("--cards")
    args.add_argument("--users")
    args.add_argument("--mcc")
    args.add_argument("--labels")
    args.add_argument("--labels-format", default="csv", choices=["csv", "json", "json_object"])
    args.add_argument("--transactions-table", help="read over JDBC; SOURCE_URL, SOURCE_USER, SOURCE_PASSWORD")
    args.add_argument("--partitions", type=int, default=jdbc.READ_PARTITIONS)
    args.add_argument("--date")
    args.add_argument("--mode", default="dynamic", choices=["dynamic", "static", "append"])
    a = args.parse_args()
    spark = get_session("ingest")
    if a.cards:
        ingest_csv(spark, a.cards, f"{a.raw}/cards_data", None, a.date, a.mode, infer=False)
    if a.users:
        ingest_csv(spark, a.users, f"{a.raw}/users_data", schemas.USERS_FILE, a.date, a.mode)
    if a.mcc:
        ingest_json_object(spark, a.mcc, f"{a.raw}/mcc_codes", a.date, a.mode)
    if a.labels:
        ingest_labels(spark, a.labels, f"{a.raw}/fraud_labels", a.labels_format, a.date, a.mode)
    if a.transactions_table:
        db = jdbc.Database.from_env("SOURCE")
        source = jdbc.read_in_ranges(spark, db, a.transactions_table, partitions=a.partitions)
        ingest_transactions(source, f"{a.raw}/transactions", a.mode)
    spark.stop()


if __name__ == "__main__":
    main()
