"""The read side: what an API call returns, as a DataFrame over the datamart tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from swipelake.operators.lookup import one_or_none, with_related
from swipelake.operators.paging import DEFAULT_LIMIT, first_rows_of, page_after, page_envelope, page_rows
from swipelake.schemas import CLIENT_VIEW, TRANSACTION_VIEW


class NotFound(LookupError):
    pass


def _found(rows: DataFrame) -> DataFrame:
    if rows.isEmpty():
        raise NotFound("no such row")
    return rows


def client_view(users: DataFrame) -> DataFrame:
    return users.withColumnRenamed("current_age", "age").select(*CLIENT_VIEW)


def transaction_page(tx: DataFrame, page: int = 1, limit: int = DEFAULT_LIMIT) -> DataFrame:
    return page_envelope(page_rows(tx.select(*TRANSACTION_VIEW), page, limit), page, limit)


def client_page(users: DataFrame, page: int = 1, limit: int = DEFAULT_LIMIT) -> DataFrame:
    return page_envelope(page_rows(client_view(users), page, limit), page, limit)


def transactions_after(tx: DataFrame, last_id=None, limit: int = DEFAULT_LIMIT) -> DataFrame:
    return page_after(tx.select(*TRANSACTION_VIEW), last_id, limit)


def transaction_with_client(tx: DataFrame, users: DataFrame, tx_id: int) -> DataFrame:
    """One transaction with its client nested; fails when there is none."""
    hit = _found(one_or_none(tx.select(*TRANSACTION_VIEW), "id", tx_id))
    return with_related(hit, client_view(users), "client_id", "id", CLIENT_VIEW, "client")


def transactions_of(tx: DataFrame, client_id: int) -> DataFrame:
    """The client's first ten transactions; fails when there are none."""
    return _found(first_rows_of(tx.select(*TRANSACTION_VIEW), "client_id", client_id))
