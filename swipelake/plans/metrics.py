"""Managed tables to the datamart: two copies and eight metric tables."""

from __future__ import annotations

import argparse
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from swipelake.operators import metrics
from swipelake.operators.ranking import top_clients
from swipelake.session import cut_lineage, get_session
from swipelake.sources import jdbc
from swipelake.sources.tables import read_table

# (rows, table name, few rows expected) -> None
Publish = Callable[[DataFrame, str, bool], object]


def jdbc_publisher(db: jdbc.Database) -> Publish:
    """Replace datamart tables; a small table is sent over one connection."""

    def publish(df: DataFrame, table: str, small: bool) -> int:
        return jdbc.write_table(df, db, table, connections=1 if small else jdbc.WRITE_CONNECTIONS)

    return publish


def transaction_metric_tables(tx: DataFrame) -> dict[str, DataFrame]:
    """Both transaction metric tables from one scan of the transactions."""
    cube = cut_lineage(metrics.transaction_cube(tx))
    return {
        "transactions_yearly_metrics": metrics.yearly_from_cube(cube),
        "use_chip_metrics": metrics.category_from_cube(cube),
    }


def client_metric_tables(users: DataFrame, tx: DataFrame) -> dict[str, DataFrame]:
    """Five metric tables from one scan of the clients, and the top clients."""
    cube = cut_lineage(metrics.client_cube(users))
    tables = metrics.client_metrics_from_cube(cube)
    tables["top_10_clients"] = top_clients(metrics.client_totals(tx), users)
    return tables


def publish_all(spark: SparkSession, publish: Publish, database: str = "default") -> None:
    tx = read_table(spark, f"{database}.transactions")
    users = read_table(spark, f"{database}.users")
    publish(tx.drop("year", "month"), "transactions", False)
    publish(users, "users", False)
    for tables in (transaction_metric_tables(tx), client_metric_tables(users, tx)):
        for name, df in tables.items():
            publish(df, name, True)


def main() -> None:
    args = argparse.ArgumentParser(description="fill the datamart; MART_URL, MART_USER, MART_PASSWORD")
    args.add_argument("--database", default="default")
    a = args.parse_args()
    spark = get_session("metrics", hive=True)
    publish_all(spark, jdbc_publisher(jdbc.Database.from_env("MART")), a.database)
    spark.stop()


if __name__ == "__main__":
    main()
