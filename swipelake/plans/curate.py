"""Latest raw snapshots to managed tables: parsed money, masked cards, labels, errors apart."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from swipelake import schemas
from swipelake.functions.text import currency_mark, has_text, mask_card, parse_money
from swipelake.operators.dictionaries import json_object_to_rows
from swipelake.operators.joins import attach_labels, require_unique
from swipelake.session import get_session
from swipelake.sources.snapshots import latest_date, read_snapshot
from swipelake.sources.tables import replace_table

# Client columns that hold money as text.
USER_MONEY = ["per_capita_income", "yearly_income", "total_debt"]


def error_rows(tx: DataFrame) -> DataFrame:
    return tx.select("id", "errors").where(has_text("errors"))


def curate_transactions(tx: DataFrame, labels: DataFrame) -> DataFrame:
    parsed = tx.drop("errors").select(
        "*", currency_mark("amount").alias("currency"), parse_money("amount").alias("_amount")
    )
    plain = parsed.withColumn("amount", F.col("_amount")).drop("_amount")
    return attach_labels(plain, labels)


def curate_cards(cards: DataFrame) -> DataFrame:
    return cards.withColumns(
        {
            "card_number": mask_card("card_number"),
            "credit_limit_currency": currency_mark("credit_limit"),
            "credit_limit": parse_money("credit_limit"),
        }
    ).drop("cvv")


def curate_users(users: DataFrame) -> DataFrame:
    money = {c: parse_money(c) for c in USER_MONEY}
    return users.withColumns({"currency": currency_mark(USER_MONEY[0]), **money}).drop("latitude", "longitude")


def curate_mcc(objects: DataFrame, text: str = "value") -> DataFrame:
    """(mcc, label) from the JSON object of codes held as text."""
    return json_object_to_rows(objects, text, "mcc", "label", key_type="int")


def curate(spark: SparkSession, raw: str, database: str = "default") -> None:
    """Each input at its own latest date; transactions and labels need not share one."""
    # mcc: the text of the leaf, so the date directory never turns into a code
    leaf = f"{raw}/mcc_codes/situation_date={latest_date(spark, f'{raw}/mcc_codes')}"
    replace_table(curate_mcc(spark.read.text(leaf)), f"{database}.mcc")
    cards = read_snapshot(spark, f"{raw}/cards_data", "csv", infer=False)
    numbers = {c: F.col(c).cast("int") for c in schemas.CARD_NUMBERS if c in cards.columns}
    replace_table(curate_cards(cards.withColumns(numbers)), f"{database}.cards")
    users = read_snapshot(spark, f"{raw}/users_data", "csv", schemas.USERS_FILE)
    replace_table(curate_users(users), f"{database}.users")
    tx = read_snapshot(spark, f"{raw}/transactions", "parquet")
    labels = require_unique(read_snapshot(spark, f"{raw}/fraud_labels", "parquet"), "id")
    replace_table(curate_transactions(tx, labels), f"{database}.transactions")
    replace_table(error_rows(tx), f"{database}.errors")


def main() -> None:
    args = argparse.ArgumentParser(description="build the managed tables")
    args.add_argument("--raw", required=True)
    args.add_argument("--database", default="default")
    a = args.parse_args()
    spark = get_session("curate", hive=True)
    curate(spark, a.raw, a.database)
    spark.stop()


if __name__ == "__main__":
    main()
