"""To-one lookups.

No join here carries a broadcast hint: labels, cards and clients grow with the data. Spark
broadcasts a side only when its measured size is below the session's threshold and shuffles both
sides otherwise; a hot or null key on the fact side is then split by adaptive execution, which a
left join against a unique key allows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from swipelake.operators.columns import prefix_shared


# Rows a hinted broadcast may have; only narrow helper tables (one row per class) are hinted.
BROADCAST_ROWS = 100_000


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast after counting the rows; a larger table is joined by a shuffle.

    For helper tables that are already stored: the count runs the query behind ``df``.
    """
    return F.broadcast(df) if df.count() <= max_rows else df


class DuplicateKey(ValueError):
    """A lookup table holds a key twice and would multiply the rows joined with it."""


def require_unique(df: DataFrame, key: str) -> DataFrame:
    """Fail before a join when ``key`` is not unique. Reads only the key column."""
    twice = df.where(F.col(key).isNotNull()).groupBy(key).count().where(F.col("count") > 1).head(1)
    if twice:
        raise DuplicateKey(f"{key}={twice[0][key]!r} occurs {twice[0]['count']} times")
    return df


def lookup_join(
    facts: DataFrame, lookup: DataFrame, fact_key: str, lookup_key: str, prefix: str = "lookup_", how: str = "left"
) -> DataFrame:
    """Add the columns of the matching lookup row; the lookup key itself is not kept.

    Columns that both sides have get ``prefix`` on the lookup's side.
    """
    right = prefix_shared(lookup.withColumnRenamed(lookup_key, "_lookup_key"), facts.columns, prefix)
    return facts.join(right, facts[fact_key] == right["_lookup_key"], how).drop("_lookup_key")


def attach_labels(tx: DataFrame, labels: DataFrame, name: str = "has_fraud", key: str = "id") -> DataFrame:
    """Fraud label by transaction id; null where there is none."""
    return lookup_join(tx, labels.select(F.col("id").alias("_id"), F.col("target").alias(name)), key, "_id")


def attach_mcc_text(tx: DataFrame, mcc: DataFrame, code: str = "mcc", name: str = "mcc_description") -> DataFrame:
    """Merchant-category text by code; null for a missing code."""
    return lookup_join(tx, mcc.select(F.col("mcc").alias("_mcc"), F.col("label").alias(name)), code, "_mcc")


def enrich_transactions(
    tx: DataFrame, labels: DataFrame | None, mcc: DataFrame, cards: DataFrame, users: DataFrame
) -> DataFrame:
    """Transactions with label, category text, card and client; one row per transaction.

    The client of a transaction is the one the transaction names, not the owner of the card.
    """
    merged = tx if labels is None else attach_labels(tx, labels, "is_fraud")
    merged = attach_mcc_text(merged.withColumnRenamed("id", "transaction_id"), mcc)
    merged = lookup_join(merged, cards.drop("client_id"), "card_id", "id", "card_")
    return lookup_join(merged, users, "client_id", "id", "user_")
