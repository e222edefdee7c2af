"""Load the transactions file, or a sample of it, into the relational source for one date."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from swipelake import schemas
from swipelake.operators.columns import stamp_date
from swipelake.operators.sampling import bernoulli_sample, hash_sample
from swipelake.session import get_session
from swipelake.sources import files, jdbc

# Fixed value: rows per batch.
SEED_BATCH = 2000


def seed_rows(
    spark: SparkSession, path: str, percentage: float = 100, date: str | None = None, repeatable: bool = True, seed=None
) -> DataFrame:
    """The sampled rows, dated. A repeatable sample is drawn from the id: a larger percentage on
    a later date holds the rows of the smaller one."""
    rows = files.read_csv(spark, path, schemas.TRANSACTION_FILE)
    rows = rows.withColumn("date", F.col("date").cast("date"))
    sampled = hash_sample(rows, "id", percentage) if repeatable else bernoulli_sample(rows, percentage, seed)
    return stamp_date(sampled, date)


def seed(
    spark: SparkSession,
    path: str,
    db: jdbc.Database,
    table: str = "transactions",
    percentage: float = 100,
    date: str | None = None,
    batch: int = SEED_BATCH,
    clear: bool = False,
    repeatable: bool = True,
    draw: int | None = None,
) -> int:
    """Append the rows in batches, or empty the table first; a missing table is created, with its defaults."""
    jdbc.ensure_table(spark, db, table, schemas.SOURCE_TABLE_COLUMNS)
    return jdbc.write_table(
        seed_rows(spark, path, percentage, date, repeatable, draw),
        db,
        table,
        mode="overwrite" if clear else "append",
        truncate=clear,
        batch=batch,
    )


def main() -> None:
    args = argparse.ArgumentParser(description="seed the source; SOURCE_URL, SOURCE_USER, SOURCE_PASSWORD")
    args.add_argument("path")
    args.add_argument("--date")
    args.add_argument("--percentage", type=float, default=100)
    args.add_argument("--batch", type=int, default=SEED_BATCH)
    args.add_argument("--clear", action="store_true")
    args.add_argument("--independent", action="store_true", help="draw each row anew instead of by its id")
    args.add_argument("--draw", type=int, help="number that an independent draw depends on")
    a = args.parse_args()
    spark = get_session("seed")
    db = jdbc.Database.from_env("SOURCE")
    rows = seed(spark, a.path, db, "transactions", a.percentage, a.date, a.batch, a.clear, not a.independent, a.draw)
    print(f"{rows} rows")
    spark.stop()


if __name__ == "__main__":
    main()
