"""Pages of a table in key order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from swipelake.operators.histogram import narrow_by_ranges, narrow_to_offset
from swipelake.operators.positions import with_positions
from swipelake.session import cut_lineage

# Page size by default and at most.
DEFAULT_LIMIT = 50
MAX_LIMIT = 1000

# An offset up to this many rows is sorted in one top-n pass; a deeper page is located first.
SHALLOW_ROWS = 100_000

# Rows from one fence to the next.
FENCE_ROWS = 10_000


def _check(page: int, limit: int) -> None:
    if page < 1:
        raise ValueError("page must be at least 1")
    if not 1 <= limit <= MAX_LIMIT:
        raise ValueError(f"limit must be between 1 and {MAX_LIMIT}")


def make_fences(df: DataFrame, key: str = "id", every: int = FENCE_ROWS, path: str | None = None) -> DataFrame:
    """(rank, key), stored: every so many rows the key at that place. Made once per state of a table, read by all its pages.

    One shuffle of the key column; a row in ``every`` stays. Keys are of any type that can be ordered, unique, nulls left out.
    """
    ranked = with_positions(df.select(key).where(F.col(key).isNotNull()), [key], "rank").where(F.col("rank") % every == 0)
    fences = ranked.select("rank", F.col(key).alias("key"))
    if path is None:
        return cut_lineage(fences)
    fences.repartitionByRange(1 + fences.count() // 1_000_000, "rank").sortWithinPartitions("rank").write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(fences.schema).parquet(path)


def _between_fences(df: DataFrame, key: str, fences: DataFrame, offset: int, limit: int) -> tuple[DataFrame, int]:
    """The keys between the fences around a page, and the page's offset there: a pushed filter, no shuffle."""
    fence = F.struct("rank", "key")
    edges = fences.agg(
        F.max(F.when(F.col("rank") <= offset, fence)).alias("lo"), F.min(F.when(F.col("rank") >= offset + limit, fence)).alias("hi")
    ).first()
    keys = df.select(key).where(F.col(key).isNotNull())
    if edges["lo"] is None:
        return keys.limit(0), 0
    keys = keys.where(F.col(key) >= F.lit(edges["lo"]["key"]))
    return keys if edges["hi"] is None else keys.where(F.col(key) <= F.lit(edges["hi"]["key"])), offset - edges["lo"]["rank"]


def page_rows(
    df: DataFrame,
    page: int = 1,
    limit: int = DEFAULT_LIMIT,
    key: str = "id",
    shallow_rows: int = SHALLOW_ROWS,
    fences: DataFrame | None = None,
) -> DataFrame:
    """Rows ``(page-1)*limit`` to ``page*limit`` in key order. The key is unique and not null.

    The page's least and greatest key are looked up first, from the key column alone. As
    constants they reach the scan, so the other columns are read only where the page lies.

    A top-n pass keeps offset + limit keys in every task, so a deep page is first narrowed by
    counting: whole-number keys by ranges of equal width, keys of any other type by ranges that
    hold about equally many of them. Few keys are sorted at any depth. With ``fences`` (see
    ``make_fences``) nothing is counted or shuffled: the keys between two fences are sorted.
    """
    _check(page, limit)
    offset = (page - 1) * limit
    keys = df.select(key).where(F.col(key).isNotNull())
    if fences is not None:
        keys, offset = _between_fences(df, key, fences, offset, limit)
    elif offset > shallow_rows:
        whole = isinstance(df.schema[key].dataType, T.IntegralType)
        narrow = narrow_to_offset if whole else narrow_by_ranges
        keys, offset = narrow(keys, key, offset, shallow_rows)
    on_page = keys.orderBy(key).offset(offset).limit(limit)
    edges = on_page.agg(F.min(key).alias("lo"), F.max(key).alias("hi")).first()
    if edges["lo"] is None:
        return df.limit(0)
    return df.where(F.col(key).between(F.lit(edges["lo"]), F.lit(edges["hi"]))).orderBy(key).limit(limit)


def page_after(df: DataFrame, last_key=None, limit: int = DEFAULT_LIMIT, key: str = "id") -> DataFrame:
    """The page that follows ``last_key``: the key filter reaches the scan, no row is skipped over."""
    _check(1, limit)
    rest = df if last_key is None else df.where(F.col(key) > F.lit(last_key))
    return rest.orderBy(key).limit(limit)


def page_envelope(rows: DataFrame, page: int, limit: int, key: str = "id") -> DataFrame:
    """One row: page, limit, count, next_page, prev_page and the page's rows in ``data``.

    A full page announces a next one, also when the table ends exactly there. An empty page
    fails unless it is the first.
    """
    _check(page, limit)
    whole = rows.agg(
        F.count("*").alias("count"),
        F.array_sort(F.collect_list(F.struct(key, *[c for c in rows.columns if c != key]))).alias("data"),
    )
    in_range = (F.col("count") > 0) | F.lit(page == 1)
    return whole.select(
        F.when(in_range, F.lit(page)).otherwise(F.raise_error(F.lit("Page out of range")).cast("int")).alias("page"),
        F.lit(limit).alias("limit"),
        "count",
        F.when(F.col("count") == limit, F.lit(page + 1)).alias("next_page"),
        F.lit(page - 1 if page > 1 else None).cast("int").alias("prev_page"),
        "data",
    )


def first_rows_of(df: DataFrame, owner: str, owner_id, limit: int = 10, key: str = "id") -> DataFrame:
    """The first rows, by key, that belong to one owner."""
    return df.where(F.col(owner) == F.lit(owner_id)).orderBy(key).limit(limit)
