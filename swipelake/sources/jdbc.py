"""Relational sources and sinks over JDBC.

SQL texts and options are built by plain functions; the calls that talk to a database are the few
lines around them.
"""

from __future__ import annotations

import re
import os
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from swipelake.operators.histogram import RangeCounts, equal_load_cuts

# Parallel reads and rows per round trip.
READ_PARTITIONS = 8
FETCH_SIZE = 10_000
# A sink takes at most this many connections at once.
WRITE_CONNECTIONS = 16
WRITE_BATCH = 10_000

Query = Callable[[str], DataFrame]


class IncompleteWrite(RuntimeError):
    """The table does not hold the rows that were sent; a replace can simply be run again."""


@dataclass
class Database:
    """Where and how to connect; user and password come from the environment, never from code."""

    url: str
    driver: str | None = None
    properties: dict[str, str] = field(default_factory=dict)

    @classmethod
    def from_env(cls, prefix: str) -> Database:
        names = {"user": f"{prefix}_USER", "password": f"{prefix}_PASSWORD"}
        login = {k: os.environ[v] for k, v in names.items() if v in os.environ}
        return cls(os.environ[f"{prefix}_URL"], os.environ.get(f"{prefix}_DRIVER"), login)

    def options(self) -> dict[str, str]:
        driver = {"driver": self.driver} if self.driver else {}
        return {"url": self.url, **driver, **self.properties}


def derived_table(sql: str, alias: str = "q") -> str:
    """A query in place of a table name: it runs in the database."""
    return f"({sql}) {alias}"


def run_query(spark: SparkSession, db: Database) -> Query:
    def run(sql: str) -> DataFrame:
        return spark.read.format("jdbc").options(**db.options()).option("dbtable", derived_table(sql)).load()

    return run


def create_statement(table: str, columns: dict[str, str]) -> str:
    """Creates the table unless it is there; a column's definition may hold NOT NULL and a default."""
    return f"CREATE TABLE IF NOT EXISTS {table} ({', '.join(f'{name} {kind}' for name, kind in columns.items())})"


def ensure_table(spark: SparkSession, db: Database, table: str, columns: dict[str, str]) -> None:
    """Run the statement over one connection of the driver; Spark's own writer could give types only."""
    options = db.options()
    if db.driver:
        spark._jvm.java.lang.Class.forName(db.driver)
    login = spark._jvm.java.util.Properties()
    for name, value in db.properties.items():
        login.setProperty(name, value)
    connection = spark._jvm.java.sql.DriverManager.getConnection(options["url"], login)
    try:
        connection.createStatement().execute(create_statement(table, columns))
    finally:
        connection.close()


# How databases say that a table is missing: standard states, and texts of drivers that give no state.
MISSING_TABLE = re.compile(r"TABLE_OR_VIEW_NOT_FOUND|\b42P01\b|\b42S02\b|(table|relation)\b.*(does not|doesn't) exist|no such table", re.I | re.S)


def bounds_sql(table: str, key: str) -> str:
    return f"SELECT MIN({key}) AS lo, MAX({key}) AS hi FROM {table}"


def count_sql(table: str) -> str:
    return f"SELECT COUNT(*) AS n FROM {table}"


def range_counts_sql(table: str, key: str, low: int, width: int, ranges: int) -> str:
    """Rows per equal-width key range; written without dialect features."""
    inner = (
        f"SELECT FLOOR(({key} - {low}) / {width}) AS r FROM {table} "
        f"WHERE {key} >= {low} AND {key} <= {low + width * ranges - 1}"
    )
    return f"SELECT r, COUNT(*) AS n FROM ({inner}) h GROUP BY r"


def key_bounds(run: Query, table: str, key: str) -> tuple[int, int] | None:
    """Least and greatest key, found by the database; None for an empty table."""
    row = run(bounds_sql(table, key)).first()
    return None if row is None or row[0] is None else (int(row[0]), int(row[1]))


def range_counts(run: Query, table: str, key: str) -> RangeCounts:
    def count(low: int, width: int, ranges: int) -> dict[int, int]:
        return {int(r[0]): int(r[1]) for r in run(range_counts_sql(table, key, low, width, ranges)).collect()}

    return count


def range_predicates(key: str, cuts: list[int]) -> list[str]:
    """One condition per part. Together they take every row once: null keys and keys outside the
    bounds, which may appear between counting and reading, are in the first and last part."""
    if not cuts:
        return ["1 = 1"]
    middle = [f"{key} >= {a} AND {key} < {b}" for a, b in zip(cuts, cuts[1:])]
    return [f"{key} < {cuts[0]} OR {key} IS NULL", *middle, f"{key} >= {cuts[-1]}"]


def stride_options(key: str, bounds: tuple[int, int] | None, partitions: int, fetch_size: int) -> dict[str, str]:
    """Options of a read in equal key strides; an empty table is read as one part."""
    options = {"fetchsize": str(fetch_size)}
    if bounds is not None:
        options |= {
            "partitionColumn": key,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    return options


def read_table(spark: SparkSession, db: Database, table: str, fetch_size: int = FETCH_SIZE) -> DataFrame:
    return (
        spark.read.format("jdbc").options(**db.options()).option("dbtable", table).option("fetchsize", fetch_size).load()
    )


def read_in_ranges(
    spark: SparkSession,
    db: Database,
    table: str,
    key: str = "id",
    partitions: int = READ_PARTITIONS,
    fetch_size: int = FETCH_SIZE,
    balanced: bool = True,
) -> DataFrame:
    """Parallel read by key ranges.

    ``balanced`` cuts the key range where the rows are, from counts made in the database: with
    equal strides a few far-off keys would leave nearly all rows to one task.
    """
    run = run_query(spark, db)
    bounds = key_bounds(run, table, key)
    if bounds is None or not balanced:
        options = stride_options(key, bounds, partitions, fetch_size)
        return spark.read.format("jdbc").options(**db.options()).option("dbtable", table).options(**options).load()
    cuts = equal_load_cuts(range_counts(run, table, key), *bounds, partitions)
    connection = {k: v for k, v in db.options().items() if k != "url"} | {"fetchsize": str(fetch_size)}
    return spark.read.jdbc(db.url, table, predicates=range_predicates(key, cuts), properties=connection)


def rows_in(run: Query, table: str) -> int:
    """Rows of a table; a table that is not there yet has none. Any other error goes through."""
    try:
        return int(run(count_sql(table)).first()[0])
    except Exception as error:
        if MISSING_TABLE.search(str(error)):
            return 0
        raise


def write_options(
    truncate: bool = False,
    batch: int = WRITE_BATCH,
    connections: int = WRITE_CONNECTIONS,
    column_types: str | None = None,
) -> dict[str, str]:
    options = {"truncate": str(truncate).lower(), "batchsize": str(batch), "numPartitions": str(connections)}
    return options | ({"createTableColumnTypes": column_types} if column_types else {})


def write_table(
    df: DataFrame,
    db: Database,
    table: str,
    mode: str = "overwrite",
    truncate: bool = False,
    batch: int = WRITE_BATCH,
    connections: int = WRITE_CONNECTIONS,
    column_types: str | None = None,
    verify: bool = True,
) -> int:
    """Replace or append to a table in batches; gives the number of rows sent.

    A task that is lost after its commit is run again and would leave its rows twice. The rows
    sent are counted on the way and compared with what the table holds more than before.
    """
    spark = df.sparkSession
    run = run_query(spark, db)
    before = rows_in(run, table) if verify and mode == "append" else 0
    sent = Observation()
    options = write_options(truncate, batch, connections, column_types)
    watched = df.observe(sent, F.count(F.lit(1)).alias("n"))
    watched.write.format("jdbc").options(**db.options()).option("dbtable", table).options(**options).mode(mode).save()
    rows = int(sent.get["n"])
    if verify:
        after = rows_in(run, table)
        if after - before != rows:
            raise IncompleteWrite(f"{table}: sent {rows} rows, holds {after - before} new ones")
    return rows
