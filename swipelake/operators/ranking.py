"""Top rows by rank, ties included."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from swipelake.operators.joins import broadcast_if_small
from swipelake.session import cut_lineage


def top_by_rank(scored: DataFrame, value: str, k: int = 10, rank: str = "rank") -> DataFrame:
    """Rows whose rank by ``value``, highest first and nulls last, is at most ``k``.

    A rank within the first k needs only the k highest values: every row above such a value is
    among them. So k rows are ranked, and all rows, however many tie, are matched against at
    most k distinct values by a broadcast. No window ever holds the tied rows.
    """
    scored = cut_lineage(scored)
    high_first = F.col("_ranked_value").desc_nulls_last()
    ranks = (
        scored.select(F.col(value).alias("_ranked_value"))
        .orderBy(high_first)
        .limit(k)
        .withColumn(rank, F.rank().over(Window.orderBy(high_first)))
        .distinct()
    )
    return scored.join(
        F.broadcast(ranks), F.col(value).eqNullSafe(F.col("_ranked_value")), "inner"
    ).drop("_ranked_value")


def top_clients(
    totals: DataFrame,
    users: DataFrame,
    client: str = "client_id",
    user_key: str = "id",
    total: str = "total_sent",
    k: int = 10,
) -> DataFrame:
    """All columns of the top clients' user rows, their total and rank, highest first.

    Ranks are given before the join: a ranked client without a user row is left out and the
    other ranks stay as they are. The ranked rows are stored, counted and, if few, broadcast, so the
    users are scanned once and not shuffled; should very many tie, both sides are shuffled instead.
    """
    ranked = broadcast_if_small(cut_lineage(top_by_rank(totals, total, k))).alias("ranked")
    people = users.alias("people")
    return (
        ranked.join(people, F.col(f"ranked.{client}") == F.col(f"people.{user_key}"), "inner")
        .select("people.*", F.col(f"ranked.{total}"), F.col("ranked.rank"))
        .orderBy(F.desc(total))
    )
