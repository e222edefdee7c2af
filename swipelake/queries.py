"""Queries over the test tables, one or more per operator, and the SQL that must agree with them.

The star-schema tables stand in for transactions, clients, cards and labels.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from swipelake.functions.text import currency_mark, has_text, mask_card, parse_money
from swipelake.operators import balance, evaluate, features, hashed_neighbours, joins, lookup, metrics, model, neighbours, paging, profile, ranking, sampling
from swipelake.operators.columns import keys_as_text, stamp_date, trim_column_names, with_year_month
from swipelake.operators.dictionaries import columns_to_rows, explode_map, json_object_to_rows
from swipelake import schemas
from swipelake.plans import curate, ingest
from swipelake.plans import metrics as metric_jobs
from swipelake.plans import seed as seeding
from swipelake.plans import train as training
from swipelake.session import cut_lineage, ensure_checkpoint_dir
from swipelake.sources import files, manifests, snapshots, tables

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_ORACLE: dict[str, str] = {}


def _query(sql: str | None = None):
    def register(fn: Query) -> Query:
        _QUERIES[fn.__name__] = fn
        if sql is not None:
            _ORACLE[fn.__name__] = sql
        return fn

    return register


def _read(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# --- stand-ins ---------------------------------------------------------------------------


def raw_transactions(spark: SparkSession, sf: str) -> DataFrame:
    """Orders in the shape of the raw transactions."""
    status = F.col("o_orderstatus")
    return _read(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderdate").cast("date").alias("date"),
        F.col("o_custkey").alias("client_id"),
        F.concat(F.when(status == "P", "$-").otherwise("$"), F.format_number("o_totalprice", 2)).alias("amount"),
        F.col("o_orderpriority").alias("use_chip"),
        F.when(status == "P", "Bad PIN").when(status == "O", "").alias("errors"),
    )


_RAW_TX_SQL = """
  SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS date, o_custkey AS client_id,
         (CASE WHEN o_orderstatus = 'P' THEN '$-' ELSE '$' END) || format('{:,.2f}', o_totalprice) AS amount,
         o_orderpriority AS use_chip,
         CASE o_orderstatus WHEN 'P' THEN 'Bad PIN' WHEN 'O' THEN '' END AS errors
  FROM orders"""


def fraud_labels(spark: SparkSession, sf: str) -> DataFrame:
    """A label for orders that are not pending."""
    orders = _read(spark, sf, "orders").where("o_orderstatus <> 'P'")
    return orders.select(
        F.col("o_orderkey").alias("id"), F.when(F.col("o_orderstatus") == "F", "Yes").otherwise("No").alias("target")
    )


_LABELS_SQL = """
  SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'F' THEN 'Yes' ELSE 'No' END AS target
  FROM orders WHERE o_orderstatus <> 'P'"""


def raw_users(spark: SparkSession, sf: str) -> DataFrame:
    """Customers in the shape of the raw clients."""
    nation, key = F.col("c_nationkey"), F.col("c_custkey")
    return _read(spark, sf, "customer").select(
        key.alias("id"),
        (F.lit(18) + nation * 3).alias("current_age"),
        (F.lit(60) + key % 11).cast("int").alias("retirement_age"),
        F.col("c_mktsegment").alias("gender"),
        F.col("c_name").alias("address"),
        F.lit(0.5).alias("latitude"),
        F.lit(1.5).alias("longitude"),
        F.concat(F.lit("$"), F.format_number(nation * 1000, 0)).alias("per_capita_income"),
        F.concat(F.lit("$"), F.format_number(nation * 2000, 0)).alias("yearly_income"),
        F.concat(F.lit("$"), F.format_number("c_acctbal", 2)).alias("total_debt"),
        (F.lit(500) + key % 350).cast("int").alias("credit_score"),
    )


_USERS_SQL = """
  SELECT c_custkey AS id, 18 + c_nationkey * 3 AS current_age, CAST(60 + c_custkey % 11 AS INTEGER) AS retirement_age,
         c_mktsegment AS gender, c_name AS address,
         CAST(c_nationkey * 1000 AS DOUBLE) AS per_capita_income, CAST(c_nationkey * 2000 AS DOUBLE) AS yearly_income,
         c_acctbal AS total_debt, CAST(500 + c_custkey % 350 AS INTEGER) AS credit_score, '$' AS currency
  FROM customer"""

# --- transaction and client metrics ------------------------------------------------------


@_query("""
  SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS total_transactions,
         round(sum(o_totalprice), 2) AS total_amount, round(avg(o_totalprice), 2) AS avg_amount,
         CAST(round(100 * CAST(avg(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END) AS DECIMAL(6,5)), 2)
              AS DECIMAL(8,2)) AS pct_fraud
  FROM orders GROUP BY 1""")
def yearly_metrics(spark, sf):
    return metrics.yearly_metrics(_read(spark, sf, "orders"), "o_orderdate", "o_totalprice", "o_orderstatus", "F")


@_query("""
  SELECT o_orderpriority, count(*) AS total_transactions,
         round(100 * avg(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END), 2) AS fraud_pct,
         round(avg(o_totalprice), 2) AS avg_amount
  FROM orders GROUP BY 1""")
def category_metrics(spark, sf):
    return metrics.category_metrics(_read(spark, sf, "orders"), "o_orderpriority", "o_totalprice", "o_orderstatus", "F")


@_query("""
  SELECT c_mktsegment, round(avg(c_acctbal), 2) AS avg_balance, round(avg(c_nationkey), 2) AS avg_nation
  FROM customer GROUP BY 1""")
def group_means(spark, sf):
    means = {"avg_balance": "c_acctbal", "avg_nation": "c_nationkey"}
    return metrics.group_means(_read(spark, sf, "customer"), "c_mktsegment", means)


@_query("""
  SELECT round(avg(l_discount / NULLIF(l_tax, 0)), 2) AS avg_ratio,
         round(max(l_discount / NULLIF(l_tax, 0)), 2) AS max_ratio
  FROM lineitem""")
def ratio_stats(spark, sf):
    return metrics.ratio_stats(_read(spark, sf, "lineitem"), "l_discount", "l_tax", "avg_ratio", "max_ratio")


@_query("""
  SELECT CAST(floor(p_size / 10) * 10 AS BIGINT) AS size_bucket, round(avg(p_retailprice), 2) AS avg_price,
         round(avg(p_size), 2) AS avg_size, count(*) AS total
  FROM part GROUP BY 1""")
def bucket_metrics(spark, sf):
    means = {"avg_price": "p_retailprice", "avg_size": "p_size"}
    return metrics.bucket_metrics(_read(spark, sf, "part"), "p_size", means, bucket="size_bucket")


@_query("""
  SELECT CASE WHEN c_acctbal < 0 THEN 'Poor' WHEN c_acctbal < 4000 THEN 'Fair' WHEN c_acctbal < 8000 THEN 'Good'
              ELSE 'Excellent' END AS score_band,
         round(avg(c_acctbal), 2) AS avg_balance, round(avg(c_nationkey), 2) AS avg_nation, count(*) AS num_customers
  FROM customer GROUP BY 1""")
def band_metrics(spark, sf):
    means = {"avg_balance": "c_acctbal", "avg_nation": "c_nationkey"}
    bounds = [(0, "Poor"), (4000, "Fair"), (8000, "Good")]
    return metrics.band_metrics(_read(spark, sf, "customer"), "c_acctbal", means, bounds)


@_query("""
  SELECT round(avg(50 - p_size), 2) AS avg_years_left, min(50 - p_size) AS min_years_left,
         max(50 - p_size) AS max_years_left
  FROM part""")
def difference_stats(spark, sf):
    return metrics.difference_stats(_read(spark, sf, "part"), F.lit(50), F.col("p_size"))


@_query("SELECT o_custkey AS client_id, round(sum(o_totalprice), 2) AS total_sent FROM orders GROUP BY 1")
def client_totals(spark, sf):
    totals = metrics.client_totals(_read(spark, sf, "orders"), "o_custkey", "o_totalprice")
    return totals.select(F.col("o_custkey").alias("client_id"), F.round("total_sent", 2).alias("total_sent"))


_TOP_SQL = """
  WITH totals AS (SELECT o_custkey, sum(o_totalprice) AS total_sent FROM orders GROUP BY 1),
       ranked AS (SELECT *, rank() OVER (ORDER BY total_sent DESC NULLS LAST) AS rank FROM totals)
  SELECT c.*, round(total_sent, 2) AS total_sent, CAST(rank AS INTEGER) AS rank
  FROM ranked JOIN customer c ON c_custkey = o_custkey WHERE rank <= 10"""


@_query(_TOP_SQL)
def top10_clients(spark, sf):
    totals = metrics.client_totals(_read(spark, sf, "orders"), "o_custkey", "o_totalprice")
    top = ranking.top_clients(totals, _read(spark, sf, "customer"), "o_custkey", "c_custkey")
    return top.withColumn("total_sent", F.round("total_sent", 2))


@_query("""
  WITH counts AS (SELECT p_size, count(*) AS n FROM part GROUP BY 1),
       ranked AS (SELECT *, rank() OVER (ORDER BY n DESC NULLS LAST) AS rank FROM counts)
  SELECT p_size, n, CAST(rank AS INTEGER) AS rank FROM ranked WHERE rank <= 10""")
def rank_with_ties(spark, sf):
    counts = _read(spark, sf, "part").groupBy("p_size").agg(F.count("*").alias("n"))
    return ranking.top_by_rank(counts, "n", 10)


def _cube_source(spark, sf):
    return curate.curate_transactions(raw_transactions(spark, sf), fraud_labels(spark, sf))


_CURATED_TX_SQL = f"""
  SELECT t.id, t.date, t.client_id, t.use_chip, regexp_extract(t.amount, '^([^0-9]+)', 1) AS currency,
         TRY_CAST(regexp_replace(t.amount, '[^0-9.-]', '', 'g') AS DOUBLE) AS amount, l.target AS has_fraud
  FROM ({_RAW_TX_SQL}) t LEFT JOIN ({_LABELS_SQL}) l ON t.id = l.id"""


@_query(_CURATED_TX_SQL)
def curate_transactions(spark, sf):
    return _cube_source(spark, sf)


@_query(f"""
  WITH t AS ({_CURATED_TX_SQL})
  SELECT CAST(year(date) AS INTEGER) AS year, count(*) AS total_transactions, round(sum(amount), 2) AS total_amount,
         round(avg(amount), 2) AS avg_amount,
         CAST(round(100 * CAST(avg(CASE WHEN has_fraud = 'Yes' THEN 1.0 ELSE 0.0 END) AS DECIMAL(6,5)), 2)
              AS DECIMAL(8,2)) AS pct_fraud
  FROM t GROUP BY 1""")
def cube_yearly_metrics(spark, sf):
    return metric_jobs.transaction_metric_tables(_cube_source(spark, sf))["transactions_yearly_metrics"]


@_query(f"""
  WITH t AS ({_CURATED_TX_SQL})
  SELECT use_chip, count(*) AS total_transactions,
         round(100 * avg(CASE WHEN has_fraud = 'Yes' THEN 1 ELSE 0 END), 2) AS fraud_pct,
         round(avg(amount), 2) AS avg_amount
  FROM t GROUP BY 1""")
def cube_category_metrics(spark, sf):
    return metric_jobs.transaction_metric_tables(_cube_source(spark, sf))["use_chip_metrics"]


@_query(_USERS_SQL)
def curate_users(spark, sf):
    return curate.curate_users(raw_users(spark, sf))


def _client_table(name: str, sql: str) -> None:
    def run(spark, sf):
        cube = cut_lineage(metrics.client_cube(curate.curate_users(raw_users(spark, sf))))
        return metrics.client_metrics_from_cube(cube)[name]

    _QUERIES[f"cube_{name}"] = run
    _ORACLE[f"cube_{name}"] = f"WITH u AS ({_USERS_SQL}) {sql}"


_client_table(
    "gender_metrics",
    """SELECT gender, round(avg(total_debt), 2) AS avg_total_debt, round(avg(credit_score), 2) AS avg_credit_score,
              round(avg(yearly_income), 2) AS avg_yearly_income FROM u GROUP BY 1""",
)
_client_table(
    "dti_metrics",
    """SELECT round(avg(total_debt / NULLIF(yearly_income, 0)), 2) AS avg_dti,
              round(max(total_debt / NULLIF(yearly_income, 0)), 2) AS max_dti FROM u""",
)
_client_table(
    "age_bucket_metrics",
    """SELECT CAST(floor(current_age / 10) * 10 AS BIGINT) AS age_bucket, round(avg(yearly_income), 2) AS avg_income,
              round(avg(total_debt), 2) AS avg_debt, round(avg(credit_score), 2) AS avg_credit_score, count(*) AS total
       FROM u GROUP BY 1""",
)
_client_table(
    "score_classification",
    """SELECT CASE WHEN credit_score < 580 THEN 'Poor' WHEN credit_score < 670 THEN 'Fair'
                   WHEN credit_score < 740 THEN 'Good' ELSE 'Excellent' END AS score_band,
              round(avg(yearly_income), 2) AS avg_income, round(avg(total_debt), 2) AS avg_debt,
              count(*) AS num_customers FROM u GROUP BY 1""",
)
_client_table(
    "retirement_stats",
    """SELECT round(avg(retirement_age - current_age), 2) AS avg_years_left,
              min(retirement_age - current_age) AS min_years_left,
              max(retirement_age - current_age) AS max_years_left FROM u""",
)

# --- parsing, masking, splitting, labelling ----------------------------------------------


@_query("""
  SELECT o_orderkey, regexp_extract('$' || o_totalprice, '^([^0-9]+)', 1) AS currency,
         TRY_CAST(regexp_replace('$' || o_totalprice, '[^0-9.-]', '', 'g') AS DOUBLE) AS amount
  FROM orders""")
def money_parse(spark, sf):
    text = F.concat(F.lit("$"), F.col("o_totalprice").cast("string"))
    return _read(spark, sf, "orders").select(
        "o_orderkey", currency_mark(text).alias("currency"), parse_money(text).alias("amount")
    )


@_query("""
  SELECT c_custkey, repeat('*', greatest(length(c_name) - 3, 0)) || right(c_name, 3) AS masked_name,
         repeat('*', greatest(length(CAST(c_custkey AS VARCHAR)) - 3, 0)) || right(CAST(c_custkey AS VARCHAR), 3) AS masked_key
  FROM customer""")
def mask(spark, sf):
    return _read(spark, sf, "customer").select(
        "c_custkey", mask_card("c_name").alias("masked_name"), mask_card("c_custkey").alias("masked_key")
    )


@_query("""
  SELECT c_custkey AS id, c_nationkey AS client_id,
         repeat('*', greatest(length(c_name) - 3, 0)) || right(c_name, 3) AS card_number,
         CASE WHEN c_acctbal < 0 THEN '$-' ELSE '$' END AS credit_limit_currency, c_acctbal AS credit_limit
  FROM customer""")
def curate_cards(spark, sf):
    cards = _read(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_nationkey").alias("client_id"),
        F.col("c_name").alias("card_number"),
        F.col("c_nationkey").alias("cvv"),
        F.concat(F.lit("$"), F.format_number("c_acctbal", 2)).alias("credit_limit"),
    )
    return curate.curate_cards(cards)


@_query("SELECT event_id, props FROM events WHERE event_type = 'error' AND props IS NOT NULL AND props <> ''")
def error_split(spark, sf):
    """Error events with a text; both conditions reach the scan. ``non_empty_text`` has all events."""
    events = _read(spark, sf, "events").where("event_type = 'error'")
    return events.select("event_id", "props").where(has_text("props"))


_MAYBE_TEXT = "CASE event_type WHEN 'error' THEN props WHEN 'click' THEN '' WHEN 'view' THEN '  ' END"


@_query(f"SELECT event_id, event_type, content FROM (SELECT *, {_MAYBE_TEXT} AS content FROM events) e WHERE content IS NOT NULL AND content <> ''")
def non_empty_text(spark, sf):
    """All events, of which some have an empty or no text."""
    events = _read(spark, sf, "events").withColumn("content", F.expr(_MAYBE_TEXT))
    return events.select("event_id", "event_type", "content").where(has_text("content"))


@_query(f"SELECT id, errors FROM ({_RAW_TX_SQL}) t WHERE errors IS NOT NULL AND errors <> ''")
def error_rows(spark, sf):
    return curate.error_rows(raw_transactions(spark, sf))


_DOCS_LABELLED = "FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"


@_query(f"SELECT d.doc_id, d.lang, d.source, l.quality, l.toxic {_DOCS_LABELLED}")
def label_enrich(spark, sf):
    docs = _read(spark, sf, "documents").select("doc_id", "lang", "source")
    labels = joins.require_unique(_read(spark, sf, "labels"), "doc_id").withColumnRenamed("doc_id", "label_doc")
    return joins.lookup_join(docs, labels, "doc_id", "label_doc")


@_query("""
  SELECT l_orderkey, l_linenumber, 'l_discount' AS code, l_discount AS label FROM lineitem
  UNION ALL SELECT l_orderkey, l_linenumber, 'l_tax', l_tax FROM lineitem""")
def map_explode(spark, sf):
    """A map per row, exploded: two columns per entry."""
    entries = F.create_map(F.lit("l_discount"), "l_discount", F.lit("l_tax"), "l_tax")
    return explode_map(_read(spark, sf, "lineitem"), entries, "code", "label", ("l_orderkey", "l_linenumber"))


@_query("""
  SELECT c_custkey, 'c_name' AS field, c_name AS content FROM customer
  UNION ALL SELECT c_custkey, 'c_mktsegment', c_mktsegment FROM customer""")
def columns_as_rows(spark, sf):
    return columns_to_rows(
        _read(spark, sf, "customer"), ["c_name", "c_mktsegment"], "field", "content", keep=("c_custkey",)
    )


@_query("""
  SELECT event_id, k AS field, props ->> ('$.' || k) AS content
  FROM (SELECT event_id, props, unnest(json_keys(props)) AS k FROM events) e""")
def json_map_explode(spark, sf):
    events = _read(spark, sf, "events")
    return json_object_to_rows(events, "props", "field", "content", keep=("event_id",), key_type="string")


@_query("""
  SELECT o_orderkey, CAST(o_custkey % 30 AS BIGINT) AS code, n_name AS label
  FROM orders LEFT JOIN nation ON n_nationkey = o_custkey % 30""")
def mcc_lookup(spark, sf):
    """Codes without an entry give null."""
    codes = _read(spark, sf, "nation").select(F.col("n_nationkey").alias("mcc"), F.col("n_name").alias("label"))
    orders = _read(spark, sf, "orders").select("o_orderkey", (F.col("o_custkey") % 30).alias("code"))
    return joins.attach_mcc_text(orders, codes, "code", "label")


# --- snapshots, dates, pages, lookups ----------------------------------------------------


@_query("SELECT * FROM orders WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders)")
def latest_snapshot(spark, sf):
    return snapshots.latest_rows(_read(spark, sf, "orders"), "o_orderdate")


@_query("""
  SELECT o_orderkey, o_custkey, o_totalprice, 1 AS month, CAST(year(o_orderdate) AS INTEGER) AS year
  FROM orders WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders)""")
def raw_snapshot_roundtrip(spark, sf):
    """Orders written as one snapshot per year into the shared folder; the latest read back."""
    orders = _read(spark, sf, "orders")
    dated = orders.withColumn("situation_date", F.trunc(F.col("o_orderdate").cast("date"), "year"))
    columns = ["o_orderkey", "o_custkey", "o_totalprice", "situation_date", "year", "month"]
    with _scratch(spark) as root:
        snapshots.write_snapshot(with_year_month(dated).select(*columns), root, "parquet", below=("year", "month"))
        return cut_lineage(snapshots.read_snapshot(spark, root, "parquet"))


@_query("""
  SELECT o_orderkey, DATE '2025-05-22' AS situation_date, CAST(year(o_orderdate) AS INTEGER) AS year,
         CAST(month(o_orderdate) AS INTEGER) AS month
  FROM orders""")
def year_month(spark, sf):
    orders = with_year_month(_read(spark, sf, "orders"), "o_orderdate")
    return stamp_date(orders.select("o_orderkey", "year", "month"), "2025-05-22")


@_query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 50 OFFSET 100")
def page(spark, sf):
    rows = _read(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return paging.page_rows(rows, 3, 50, "o_orderkey")


@_query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 50 OFFSET 1000")
def page_deep(spark, sf):
    """The same by counting key ranges first, as for offsets beyond what a top-n pass should hold."""
    rows = _read(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return paging.page_rows(rows, 21, 50, "o_orderkey", shallow_rows=200)


@_query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderkey > 149 ORDER BY o_orderkey LIMIT 50")
def page_keyset(spark, sf):
    rows = _read(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return paging.page_after(rows, 149, 50, "o_orderkey")


@_query("""
  SELECT 2 AS page, 50 AS "limit", 50::BIGINT AS "count", 3 AS next_page, 1 AS prev_page, o_orderkey, o_totalprice
  FROM (SELECT * FROM orders ORDER BY o_orderkey LIMIT 50 OFFSET 50) o""")
def page_envelope(spark, sf):
    rows = paging.page_rows(_read(spark, sf, "orders").select("o_orderkey", "o_totalprice"), 2, 50, "o_orderkey")
    return paging.page_envelope(rows, 2, 50, "o_orderkey").select(
        "page", "limit", "count", "next_page", "prev_page", F.inline("data")
    )


@_query("""
  SELECT o_orderkey, o_custkey, o_totalprice, c_custkey, c_name, c_mktsegment
  FROM orders LEFT JOIN customer ON c_custkey = o_custkey WHERE o_orderkey = 42""")
def point_lookup(spark, sf):
    orders = _read(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    hit = lookup.one_or_none(orders, "o_orderkey", 42)
    client = ["c_custkey", "c_name", "c_mktsegment"]
    full = lookup.with_related(hit, _read(spark, sf, "customer"), "o_custkey", "c_custkey", client, "client")
    return full.select("o_orderkey", "o_custkey", "o_totalprice", "client.*")


@_query("""
  SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_custkey = 7 ORDER BY o_orderkey LIMIT 10""")
def client_transactions(spark, sf):
    rows = _read(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return paging.first_rows_of(rows, "o_custkey", 7, 10, "o_orderkey")


@_query("SELECT min(o_orderkey) AS lo, max(o_orderkey) AS hi FROM orders")
def bounds(spark, sf):
    return profile.key_bounds(_read(spark, sf, "orders"), "o_orderkey")


@_query("SELECT count(*) AS n FROM lineitem")
def row_count(spark, sf):
    return profile.row_count(_read(spark, sf, "lineitem"))


@_query("""
  SELECT o_orderkey, o_totalprice FROM orders
  WHERE CAST('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8) AS BIGINT) < CAST(floor(4294967296 * 0.7) AS BIGINT)""")
def hash_sample(spark, sf):
    return sampling.hash_sample(_read(spark, sf, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey", 70)


@_query("""
  SELECT count(*) AS total, true AS all_of_table, true AS each_once, true AS near_share, true AS whole FROM orders""")
def bernoulli_sample(spark, sf):
    """What is determined of a draw, over whole rows: only rows of the table, none more often than there, about 70 % of them,
    and all of them at 100 %. The drawn rows themselves are ``bernoulli_rows``."""
    orders = _read(spark, sf, "orders")
    parts = {"there": orders, "times": sampling.bernoulli_sample(orders, 70, 42), "at_100": sampling.bernoulli_sample(orders, 100)}
    marked = [rows.select(*orders.columns, *(F.lit(int(part == p)).alias(p) for p in parts)) for part, rows in parts.items()]
    # one group per different row, null keys and repeated rows included
    counts = functools.reduce(DataFrame.unionByName, marked).groupBy(*orders.columns).agg(*(F.sum(p).alias(p) for p in parts))
    n, k = (F.coalesce(F.sum(p), F.lit(0)) for p in ("there", "times"))
    return counts.agg(
        n.alias("total"),
        (F.count_if((F.col("times") > 0) & (F.col("there") == 0)) == 0).alias("all_of_table"),
        (F.count_if(F.col("times") > F.col("there")) == 0).alias("each_once"),
        (F.abs(k - 0.7 * n) <= 6 * F.sqrt(0.21 * n) + 1).alias("near_share"),
        (F.count_if(F.col("at_100") != F.col("there")) == 0).alias("whole"),
    )


@_query()
def bernoulli_rows(spark, sf):
    """The drawn rows with all their columns; which ones depends on the engine's generator, so what is determined of them is ``bernoulli_sample``."""
    return sampling.bernoulli_sample(_read(spark, sf, "orders"), 70, 42)


@_query("""
  SELECT count(*) AS total, true AS all_of_table, true AS each_once, true AS near_share, true AS whole FROM orders""")
def bernoulli_bounds(spark, sf):
    """What a draw must hold: rows of the table, each once, about 70 % of them, and all of them at 100 %."""
    orders = _read(spark, sf, "orders").select("o_orderkey")
    drawn = sampling.bernoulli_sample(orders, 70, 42).groupBy("o_orderkey").agg(F.count("*").alias("times"))
    whole = sampling.bernoulli_sample(orders, 100).groupBy("o_orderkey").agg(F.count("*").alias("at_100"))
    all_ = orders.withColumn("in_table", F.lit(True))
    both = all_.join(drawn, "o_orderkey", "full").join(whole, "o_orderkey", "full")
    n, k = F.count_if("in_table"), F.count("times")
    return both.agg(
        n.alias("total"),
        (F.count_if(F.col("times").isNotNull() & F.col("in_table").isNull()) == 0).alias("all_of_table"),
        (F.coalesce(F.max("times"), F.lit(1)) == 1).alias("each_once"),
        (F.abs(k - 0.7 * n) <= 6 * F.sqrt(0.21 * n) + 1).alias("near_share"),
        (F.count_if(F.col("at_100") == 1) == n).alias("whole"),
    )


_DRAW = "CAST('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8) AS BIGINT)"


@_query(f"""
  SELECT o_orderkey, o_orderpriority FROM orders
  WHERE {_DRAW} < CASE o_orderpriority WHEN '1-URGENT' THEN 4294967296 WHEN '2-HIGH' THEN 2147483648 ELSE CAST(floor(4294967296 * 0.1) AS BIGINT) END""")
def chance_sample(spark, sf):
    """A chance per class, drawn in one pass."""
    orders = _read(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return sampling.sample_by_chance(orders, "o_orderpriority", "o_orderkey", {"1-URGENT": 1.0, "2-HIGH": 0.5}, 0.1)


@_query(f"SELECT o_orderkey, o_orderstatus, {_DRAW} < CAST(floor(4294967296 * 0.2) AS BIGINT) AS is_test FROM orders")
def chance_split(spark, sf):
    """About a fifth of every class as test rows, in one pass."""
    return sampling.split_by_chance(_read(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), "o_orderkey", 0.2)


# --- preparation -------------------------------------------------------------------------


@_query("""
  SELECT l.l_orderkey, l.l_linenumber, l.l_quantity, o.o_custkey, o.o_totalprice, c.c_name, c.c_mktsegment,
         p.p_name, p.p_size
  FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey LEFT JOIN customer c ON o.o_custkey = c.c_custkey
       LEFT JOIN part p ON l.l_partkey = p.p_partkey""")
def enrich_all(spark, sf):
    lines = _read(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
    orders = _read(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    customer = _read(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    part = _read(spark, sf, "part").select("p_partkey", "p_name", "p_size")
    merged = joins.lookup_join(lines, orders, "l_orderkey", "o_orderkey")
    merged = joins.lookup_join(merged, customer, "o_custkey", "c_custkey")
    return joins.lookup_join(merged, part, "l_partkey", "p_partkey").drop("l_partkey")


@_query(f"""
  WITH t AS ({_CURATED_TX_SQL}), u AS ({_USERS_SQL})
  SELECT t.id AS transaction_id, t.date, t.client_id, t.use_chip, t.currency, t.amount, l.target AS is_fraud,
         t.client_id % 25 AS mcc, n.n_name AS mcc_description, t.id % 100 AS card_id,
         s.s_name AS card_number, s.s_acctbal AS credit_limit,
         u.current_age, u.retirement_age, u.gender, u.address, u.per_capita_income, u.yearly_income, u.total_debt,
         u.credit_score, u.currency AS user_currency
  FROM t LEFT JOIN ({_LABELS_SQL}) l ON t.id = l.id LEFT JOIN nation n ON n.n_nationkey = t.client_id % 25
       LEFT JOIN supplier s ON s.s_suppkey = t.id % 100 LEFT JOIN u ON u.id = t.client_id""")
def enrich_transactions(spark, sf):
    """Curated transactions with label, category text, card and client."""
    tx = curate_transactions(spark, sf).drop("has_fraud").withColumns(
        {"mcc": F.col("client_id") % 25, "card_id": F.col("id") % 100}
    )
    mcc = _read(spark, sf, "nation").select(F.col("n_nationkey").alias("mcc"), F.col("n_name").alias("label"))
    cards = _read(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("id"),
        F.col("s_nationkey").alias("client_id"),
        F.col("s_name").alias("card_number"),
        F.col("s_acctbal").alias("credit_limit"),
    )
    return joins.enrich_transactions(tx, fraud_labels(spark, sf), mcc, cards, curate_users(spark, sf))


@_query("""
  SELECT trim(CAST(l_orderkey AS VARCHAR)) AS l_orderkey, trim(CAST(l_partkey AS VARCHAR)) AS l_partkey, l_quantity
  FROM lineitem""")
def text_keys(spark, sf):
    lines = _read(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    padded = lines.toDF(*[f" {c} " for c in lines.columns])
    return keys_as_text(trim_column_names(padded), "l_orderkey", "l_partkey")


def _docs_labelled(spark, sf):
    docs = _read(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")
    labels = _read(spark, sf, "labels").withColumnRenamed("doc_id", "label_doc")
    return joins.lookup_join(docs, labels, "doc_id", "label_doc")


_SPARSE = {"a": "quality = 1", "b": "quality = 0", "c": "toxic = 1", "d": "toxic = 0", "e": "n_chars > 1000"}
_SPARSE_SQL = ", ".join(f"CASE WHEN {rule} THEN 1 END AS {c}" for c, rule in _SPARSE.items())
_SPARSE_COLUMNS = ["doc_id", "lang", "source", "n_chars", "quality", "toxic", *_SPARSE]
_FILLED = " + ".join(f"({c} IS NOT NULL)::INT" for c in _SPARSE_COLUMNS)


@_query(f"""
  SELECT * FROM (SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic, {_SPARSE_SQL} {_DOCS_LABELLED}) t
  WHERE {_FILLED} >= 8""")
def drop_sparse(spark, sf):
    """Eleven columns, of which int(0.8 * 11) = 8 must be filled."""
    rows = _docs_labelled(spark, sf).select(*_SPARSE_COLUMNS[:6])
    return profile.drop_sparse_rows(rows.withColumns({c: F.when(F.expr(rule), 1) for c, rule in _SPARSE.items()}))


@_query(f"SELECT d.doc_id, coalesce(CASE WHEN l.quality = 1 THEN 'good' END, 'unknown') AS mcc_description {_DOCS_LABELLED}")
def fill_constant(spark, sf):
    text = F.when(F.col("quality") == 1, "good").alias("mcc_description")
    return profile.fill_missing_text(_docs_labelled(spark, sf).select("doc_id", text))


@_query(f"""
  WITH t AS (SELECT d.doc_id, CAST(l.quality AS DOUBLE) AS q, CAST(l.toxic AS DOUBLE) AS x {_DOCS_LABELLED})
  SELECT doc_id, round(coalesce(q, (SELECT avg(q) FROM t)), 6) AS quality,
         round(coalesce(x, (SELECT avg(x) FROM t)), 6) AS toxic FROM t""")
def impute_mean(spark, sf):
    filled = profile.impute_means(_docs_labelled(spark, sf), ["quality", "toxic"])
    return filled.select("doc_id", F.round("quality", 6).alias("quality"), F.round("toxic", 6).alias("toxic"))


@_query(f"SELECT bool_or(d.lang IS NULL) AS lang, bool_or(l.quality IS NULL) AS quality {_DOCS_LABELLED}")
def null_presence(spark, sf):
    return profile.null_presence(_docs_labelled(spark, sf), ["lang", "quality"])


@_query("SELECT l_orderkey, l_linenumber, l_quantity, l_tax FROM lineitem")
def zero_variance(spark, sf):
    lines = _read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_tax", F.lit(7.0).alias("same"))
    return profile.drop_constant_columns(lines, ["l_quantity", "l_tax", "same"])


@_query("""
  SELECT c_custkey, round((c_acctbal - (SELECT avg(c_acctbal) FROM customer))
                          / (SELECT stddev_pop(c_acctbal) FROM customer), 6) AS balance,
         round((c_nationkey - (SELECT avg(c_nationkey) FROM customer))
               / (SELECT stddev_pop(c_nationkey) FROM customer), 6) AS nation
  FROM customer""")
def standardize(spark, sf):
    customer = _read(spark, sf, "customer")
    out = features.scaled(customer, ["c_acctbal", "c_nationkey"])
    return out.select("c_custkey", F.round("c_acctbal", 6).alias("balance"), F.round("c_nationkey", 6).alias("nation"))


_ONE_HOT_SQL = """
  SELECT c_custkey, (SELECT count(DISTINCT {column}) FROM customer)::INTEGER AS width,
         (dense_rank() OVER (ORDER BY {column}))::BIGINT AS position
  FROM customer"""


def _one_hot(spark, sf, column):
    """Width of the vector and place of its one, counted from 1."""
    rows = features.one_hot(_read(spark, sf, "customer"), column, "hot")
    hot = F.unwrap_udt(F.col("hot"))
    return rows.select("c_custkey", hot["size"].alias("width"), (hot["indices"][0] + 1).cast("bigint").alias("position"))


@_query(_ONE_HOT_SQL.format(column="c_mktsegment"))
def one_hot(spark, sf):
    return _one_hot(spark, sf, "c_mktsegment")


@_query(_ONE_HOT_SQL.format(column="c_name"))
def one_hot_wide(spark, sf):
    """A category per row: the dictionary is as large as the table."""
    return _one_hot(spark, sf, "c_name")


@_query("""
  WITH s AS (SELECT avg(c_acctbal) AS m, stddev_pop(c_acctbal) AS d FROM customer),
       k AS (SELECT c_mktsegment, row_number() OVER (ORDER BY c_mktsegment) + 1 AS place
             FROM (SELECT DISTINCT c_mktsegment FROM customer) x)
  SELECT c_custkey, round((c_acctbal - m) / d, 6) AS balance, place::BIGINT AS place
  FROM customer JOIN k USING (c_mktsegment), s""")
def feature_vector(spark, sf):
    """Scaled number first, then one position per category."""
    rows = features.with_text_categories(_read(spark, sf, "customer"), ["c_mktsegment"])
    fitted = features.feature_pipeline(rows, ["c_acctbal"], ["c_mktsegment"])
    parts = vector_to_array("features")
    place = F.array_position(F.transform(parts, lambda v, i: F.when(i == 0, 0.0).otherwise(v)), 1.0)
    return fitted.transform(rows).select("c_custkey", F.round(parts[0], 6).alias("balance"), place.alias("place"))


# --- classes, splits, evaluation ---------------------------------------------------------

_RULE = "CASE WHEN doc_id % 3 = 0 THEN 1 - quality ELSE quality END"


def _predicted(spark, sf):
    """Labels with a prediction from a rule."""
    return _read(spark, sf, "labels").withColumn("predicted", F.expr(_RULE).cast("int"))


@_query("SELECT quality, count(*) AS n FROM labels GROUP BY 1")
def class_distribution(spark, sf):
    return evaluate.class_counts(_read(spark, sf, "labels"), "quality")


@_query(f"SELECT quality AS actual, {_RULE} AS predicted, count(*) AS n FROM labels GROUP BY 1, 2")
def confusion(spark, sf):
    return evaluate.confusion_counts(_predicted(spark, sf), "quality", "predicted")


@_query(f"""
  SELECT quality AS actual, count(*) FILTER ({_RULE} = 0) AS predicted_0, count(*) FILTER ({_RULE} = 1) AS predicted_1
  FROM labels GROUP BY 1""")
def confusion_matrix(spark, sf):
    counts = evaluate.confusion_counts(_predicted(spark, sf), "quality", "predicted")
    return evaluate.confusion_matrix(counts, [0, 1]).toDF("actual", "predicted_0", "predicted_1")


@_query(f"""
  WITH p AS (SELECT quality AS a, {_RULE} AS p FROM labels),
       c AS (SELECT k AS class, (SELECT count(*) FROM p WHERE a = k AND p = k) AS h,
                    (SELECT count(*) FROM p WHERE p = k) AS pr, (SELECT count(*) FROM p WHERE a = k) AS support
             FROM (SELECT DISTINCT a AS k FROM p UNION SELECT DISTINCT p FROM p) k),
       r AS (SELECT class, CASE WHEN pr > 0 THEN h * 1.0E0 / pr ELSE 0.0E0 END AS prec,
                    CASE WHEN support > 0 THEN h * 1.0E0 / support ELSE 0.0E0 END AS rec,
                    CASE WHEN pr + support > 0 THEN 2.0E0 * h / (pr + support) ELSE 0.0E0 END AS f, support FROM c)
  SELECT CAST(class AS VARCHAR) AS class, round(prec, 4) AS precision, round(rec, 4) AS recall, round(f, 4) AS f1,
         CAST(support AS BIGINT) AS support FROM r
  UNION ALL SELECT 'accuracy', NULL, NULL, round((SELECT avg(CASE WHEN a = p THEN 1.0E0 ELSE 0.0E0 END) FROM p), 4),
                   CAST(sum(support) AS BIGINT) FROM r
  UNION ALL SELECT 'macro avg', round(avg(prec), 4), round(avg(rec), 4), round(avg(f), 4),
                   CAST(sum(support) AS BIGINT) FROM r
  UNION ALL SELECT 'weighted avg', round(sum(prec * support) / sum(support), 4),
                   round(sum(rec * support) / sum(support), 4), round(sum(f * support) / sum(support), 4),
                   CAST(sum(support) AS BIGINT) FROM r""")
def report(spark, sf):
    counts = evaluate.confusion_counts(_predicted(spark, sf), "quality", "predicted")
    return evaluate.classification_report(counts)


@_query(f"SELECT avg(CASE WHEN quality = {_RULE} THEN 1.0E0 ELSE 0.0E0 END) AS accuracy FROM labels")
def accuracy(spark, sf):
    return evaluate.accuracy(_predicted(spark, sf), "quality", "predicted")


@_query(f"""
  WITH p AS (SELECT quality AS a, {_RULE} AS p FROM labels),
       m AS (SELECT k, (SELECT count(*) FROM p WHERE a = k AND p = k) AS h, (SELECT count(*) FROM p WHERE p = k) AS pr,
                    (SELECT count(*) FROM p WHERE a = k) AS support FROM (SELECT DISTINCT a AS k FROM p UNION SELECT DISTINCT p FROM p) x)
  SELECT 'confusion' AS part, a || ' as ' || p AS name, CAST(count(*) AS DOUBLE) AS value FROM p GROUP BY a, p
  UNION ALL SELECT 'recall', CAST(k AS VARCHAR), round(CASE WHEN support > 0 THEN h * 1.0E0 / support ELSE 0.0E0 END, 4) FROM m
  UNION ALL SELECT 'precision', CAST(k AS VARCHAR), round(CASE WHEN pr > 0 THEN h * 1.0E0 / pr ELSE 0.0E0 END, 4) FROM m
  UNION ALL SELECT 'accuracy', 'all', round(avg(CASE WHEN a = p THEN 1.0E0 ELSE 0.0E0 END), 4) FROM p""")
def evaluation_bundle(spark, sf):
    """All parts of an evaluation from one call, as rows."""
    found = model.evaluate(_predicted(spark, sf), "quality", "predicted")
    classes = found.report.where(~F.col("class").isin("accuracy", "macro avg", "weighted avg"))
    parts = [found.confusion.select(F.lit("confusion").alias("part"), F.concat_ws(" as ", "actual", "predicted").alias("name"), F.col("n").cast("double").alias("value"))]
    parts += [classes.select(F.lit(c).alias("part"), F.col("class").alias("name"), F.col(c).alias("value")) for c in ("recall", "precision")]
    parts.append(found.accuracy.select(F.lit("accuracy").alias("part"), F.lit("all").alias("name"), F.round("accuracy", 4).alias("value")))
    return functools.reduce(DataFrame.unionByName, parts)


_SPLIT_SQL = """
  WITH c AS (SELECT quality, count(*) AS n FROM labels GROUP BY 1),
       t AS (SELECT *, sum(n) OVER () AS total, CAST(ceil(sum(n) OVER () * 0.2) AS BIGINT) AS test FROM c),
       q AS (SELECT quality, (n * test) // total AS base, (n * test) % total AS rem,
                    test - sum((n * test) // total) OVER () AS extra,
                    row_number() OVER (ORDER BY (n * test) % total DESC, quality) AS place FROM t),
       r AS (SELECT *, row_number() OVER (PARTITION BY quality ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id) AS rn
             FROM labels)
  SELECT r.doc_id, r.quality, r.rn <= q.base + (q.place <= q.extra)::INT AS is_test
  FROM r JOIN q ON r.quality = q.quality"""


@_query(_SPLIT_SQL)
def stratified_split(spark, sf):
    labels = _read(spark, sf, "labels").select("doc_id", "quality")
    return sampling.stratified_split(labels, "quality", "doc_id", 0.2)


# --- balancing and the model -------------------------------------------------------------

_NEAR_SQL = """
  SELECT grp, pid, near_pid, dist FROM (
    SELECT a.label AS grp, a.vec_id AS pid, b.vec_id AS near_pid,
           list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS dist,
           row_number() OVER (PARTITION BY a.vec_id
                              ORDER BY list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), b.vec_id) AS place
    FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id <> b.vec_id) x
  WHERE place <= 5"""


WIDTH = 64
_COORDINATES = ", ".join(
    f"round(a.embedding[{i}]::DOUBLE + p.u * (b.embedding[{i}]::DOUBLE - a.embedding[{i}]::DOUBLE), 6) AS x{i}" for i in range(1, WIDTH + 1)
)


@_query(f"SELECT grp, pid, near_pid, round(dist, 6) AS dist FROM ({_NEAR_SQL}) n")
def neighbours_of_many_cells(spark, sf):
    """The same in cells of about ten points, so that pivots, routing and rounds take part."""
    points = cut_lineage(neighbours.distinct_points(_read(spark, sf, "embeddings"), "label", "vec_id", "embedding"))
    near = neighbours.nearest_neighbours(points, 5, cell_rows=10)
    return near.select("grp", "pid", "near_pid", F.round("dist", 6).alias("dist"))


@_query(f"SELECT grp, pid, near_pid, round(dist, 6) AS dist FROM ({_NEAR_SQL}) n")
def class_neighbours(spark, sf):
    """The five nearest vectors of the same class."""
    points = cut_lineage(neighbours.distinct_points(_read(spark, sf, "embeddings"), "label", "vec_id", "embedding"))
    near = neighbours.nearest_neighbours(points, 5)
    return near.select("grp", "pid", "near_pid", F.round("dist", 6).alias("dist"))


@_query(f"SELECT count(*) AS neighbours, true AS recall_reached, true AS true_distances FROM ({_NEAR_SQL}) n")
def hashed_recall(spark, sf):
    """Neighbours by random projections against the exact ones: nine tenths are found, and all distances are true."""
    points = cut_lineage(neighbours.distinct_points(_read(spark, sf, "embeddings"), "label", "vec_id", "embedding"))
    exact = cut_lineage(neighbours.nearest_neighbours(points, 5))
    hashed = cut_lineage(hashed_neighbours.hashed_neighbours(points, 5))
    vectors = points.select("pid", "vec")
    ends = hashed.join(vectors, "pid").join(vectors.select(F.col("pid").alias("near_pid"), F.col("vec").alias("near_vec")), "near_pid")
    squares = F.aggregate(F.zip_with("vec", "near_vec", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda x, y: x + y)
    true = ends.agg(F.bool_and(F.abs(F.sqrt(squares) - F.col("dist")) < 1e-9).alias("true_distances"))
    found = hashed_neighbours.recall(exact, hashed)
    return found.select("neighbours", (F.col("recall") >= 0.9).alias("recall_reached"), true.scalar().alias("true_distances"))


@_query(f"""
  WITH near AS (SELECT grp, pid, near_pid,
                       row_number() OVER (PARTITION BY pid ORDER BY dist, near_pid) - 1 AS slot FROM ({_NEAR_SQL}) n),
       c AS (SELECT label, count(*) AS n FROM embeddings GROUP BY 1),
       need AS (SELECT label, n, (SELECT max(n) FROM c) - n AS need FROM c),
       base AS (SELECT e.label, e.vec_id, need // n +
                       (row_number() OVER (PARTITION BY e.label ORDER BY md5(CAST(vec_id AS VARCHAR)), vec_id)
                        <= need % n)::INT AS quota
                FROM embeddings e JOIN need ON e.label = need.label),
       draws AS (SELECT label, vec_id, unnest(range(CAST(quota AS BIGINT))) AS draw FROM base),
       dig AS (SELECT *, md5(vec_id || ':' || draw) AS d FROM draws),
       pick AS (SELECT *, CAST('0x' || substr(d, 1, 8) AS BIGINT) / 4294967296.0E0 AS u,
                       CAST('0x' || substr(d, 9, 8) AS BIGINT) % 5 AS slot FROM dig)
  SELECT p.label, p.vec_id AS base_key, p.draw,
         {_COORDINATES}
  FROM pick p JOIN near ON near.pid = p.vec_id AND near.slot = p.slot
       JOIN embeddings a ON a.vec_id = p.vec_id JOIN embeddings b ON b.vec_id = near.near_pid""")
def synthetic_points(spark, sf):
    """The points that make all classes equally large."""
    made = balance.synthetic_points(_read(spark, sf, "embeddings"), "label", "vec_id", "embedding")
    coordinates = [F.round(F.col("embedding")[i], 6).alias(f"x{i + 1}") for i in range(WIDTH)]
    return made.select("label", "base_key", "draw", *coordinates)


@_query("""
  WITH c AS (SELECT label, count(*) AS n FROM embeddings GROUP BY 1)
  SELECT label, (SELECT max(n) FROM c) AS n, (SELECT max(n) FROM c) - n AS synthetic FROM c""")
def balanced_counts(spark, sf):
    rows = balance.balance_classes(_read(spark, sf, "embeddings"), "label", "vec_id", "embedding")
    return rows.groupBy("label").agg(F.count("*").alias("n"), F.count_if("is_synthetic").alias("synthetic"))


_TEST_SQL = """
  WITH c AS (SELECT {label} AS label, count(*) AS n FROM {rows} GROUP BY 1),
       t AS (SELECT *, sum(n) OVER () AS total, CAST(ceil(sum(n) OVER () * 0.2) AS BIGINT) AS test FROM c),
       q AS (SELECT label, (n * test) // total AS base, test - sum((n * test) // total) OVER () AS extra,
                    row_number() OVER (ORDER BY (n * test) % total DESC, label) AS place FROM t),
       r AS (SELECT {key} AS key, {label} AS label,
                    row_number() OVER (PARTITION BY {label} ORDER BY md5(CAST({key} AS VARCHAR)), {key}) AS rn FROM {rows})
  SELECT r.key AS {key}, CAST(r.label AS DOUBLE) AS label, {found}
  FROM r JOIN q ON r.label = q.label WHERE r.rn <= q.base + (q.place <= q.extra)::INT"""


def _probability(predictions: DataFrame, key: str) -> DataFrame:
    """key, label, prediction and the predicted class's probability."""
    chance = vector_to_array("probability")[F.col("prediction").cast("int")]
    return predictions.select(key, "label", "prediction", F.round(chance, 6).alias("probability"))


def _through_forest(spark, rows: DataFrame, key: str, trees: int = model.TREES, max_depth: int = model.MAX_DEPTH) -> DataFrame:
    """Split, balance, train, store the model, predict the test part with the stored one. Columns: key, label, features (array)."""
    split = cut_lineage(sampling.stratified_split(rows, "label", key, 0.2))
    train_part = balance.balance_classes(split.where(~F.col("is_test")), "label", key, "features")
    train = train_part.select(F.col("label").cast("double"), array_to_vector("features").alias("features"))
    test = split.where("is_test").select(key, F.col("label").cast("double"), array_to_vector("features").alias("features"))
    with _scratch(spark) as folder:
        model.save_model(model.train_forest(train, trees=trees, max_depth=max_depth), f"{folder}/model")
        return cut_lineage(_probability(model.predict(model.load_model(f"{folder}/model"), test), key))


# The class follows from each feature alone, so a forest that works makes no mistake: all its trees agree.
_SHARE_ROWS = "(SELECT vec_id, CASE WHEN vec_id % 8 >= 5 THEN 1 ELSE 0 END AS label FROM embeddings) e"


@_query(_TEST_SQL.format(label="label", key="vec_id", rows=_SHARE_ROWS, found="CAST(r.label AS DOUBLE) AS prediction, 1.0E0 AS probability"))
def forest_predictions(spark, sf):
    """Predictions and their probabilities where the features determine them."""
    share = F.col("vec_id") % 8
    label = F.when(share >= 5, 1).otherwise(0)
    rows = _read(spark, sf, "embeddings").select("vec_id", label.alias("label"), F.array(share, share * share + 1, -3 * share).cast("array<double>").alias("features"))
    return _through_forest(spark, rows, "vec_id")


@_query()
def forest_vectors(spark, sf):
    """Predictions of the vectors' classes. The classes don't follow from the vectors, so no SQL can say them."""
    return _through_forest(spark, _read(spark, sf, "embeddings").select("vec_id", "label", F.col("embedding").alias("features")), "vec_id")


_FRAUD_ROWS = f"(SELECT id AS transaction_id, CASE target WHEN 'Yes' THEN 1 ELSE 0 END AS label FROM ({_LABELS_SQL}) l) f"


def _fraud_model(spark, sf, drop=(), **how) -> DataFrame:
    """Enriched transactions to predictions, through the stored stages: merge, prepare, split, encode, balance, train, predict."""
    with _scratch(spark) as folder:
        enrich_transactions(spark, sf).where("is_fraud IS NOT NULL").drop(*drop).write.parquet(f"{folder}/merged")
        result = training.train(spark.read.parquet(f"{folder}/merged"), features_path=f"{folder}/features", **how)
        return cut_lineage(_probability(result.predictions, "transaction_id"))


@_query()
def fraud_model(spark, sf):
    """Predictions and their probabilities on all features. What is determined of them is ``fraud_model_rows``."""
    return _fraud_model(spark, sf)


@_query(_TEST_SQL.format(label="label", key="transaction_id", rows=_FRAUD_ROWS, found="true AS in_classes, true AS a_chance"))
def fraud_model_rows(spark, sf):
    """The same through a small forest, without the columns that have a category per client or day: test rows and labels,
    predictions that are classes, chances of at least a half."""
    found = _fraud_model(spark, sf, drop=("address", "date"), trees=3, max_depth=4)
    return found.select("transaction_id", "label", F.col("prediction").isin(0.0, 1.0).alias("in_classes"), F.col("probability").between(0.5, 1).alias("a_chance"))


@_query(f"""
  WITH c AS (SELECT CAST(label AS DOUBLE) AS label, count(*) AS n FROM {_FRAUD_ROWS} GROUP BY 1),
       t AS (SELECT *, sum(n) OVER () AS total, CAST(ceil(sum(n) OVER () * 0.2) AS BIGINT) AS test FROM c),
       q AS (SELECT label, n, (n * test) // total AS base, test - sum((n * test) // total) OVER () AS extra,
                    row_number() OVER (ORDER BY (n * test) % total DESC, label) AS place FROM t),
       r AS (SELECT label, CAST(n - base - (place <= extra)::INT AS BIGINT) AS n FROM q)
  SELECT label, max(n) OVER () AS n, max(n) OVER () - n AS synthetic, true AS sparse FROM r""")
def fraud_balanced(spark, sf):
    """All features, a position for every address, card and day: encoded and balanced without unfolding a vector."""
    with _scratch(spark) as folder:
        enrich_transactions(spark, sf).where("is_fraud IS NOT NULL").write.parquet(f"{folder}/merged")
        fitted, _, balanced = training.balanced_features(spark.read.parquet(f"{folder}/merged"))
        held = F.unwrap_udt("features")
        sparse = (held["type"] == 0) & (held["size"] == fitted.width) & (F.size(held["indices"]) <= 4 * len(fitted.numeric + fitted.categorical))
        return cut_lineage(balanced.groupBy("label").agg(F.count("*").alias("n"), F.count_if("is_synthetic").alias("synthetic"), F.bool_and(sparse).alias("sparse")))


# --- files, tables and stages ------------------------------------------------------------


@contextmanager
def _scratch(spark):
    """A folder below the checkpoint folder, removed afterwards by the file system that made it."""
    folder = f"{ensure_checkpoint_dir(spark)}/stage-{uuid.uuid4().hex}"
    yield folder
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


_LABEL_TEXT = "CASE doc_id % 5 WHEN 0 THEN NULL WHEN 1 THEN 'No, really' WHEN 2 THEN 'a \"quoted\" \\ word,' WHEN 3 THEN ',' ELSE 'Yes' END"


@_query(f"SELECT doc_id AS id, {_LABEL_TEXT} AS target FROM labels")
def label_object(spark, sf):
    """Labels written as JSON objects of 200 fields without line ends, some texts with commas, quotes and nulls, and read back."""
    labels = _read(spark, sf, "labels").select("doc_id", F.expr(_LABEL_TEXT.replace("\\", "\\\\")).alias("target"))
    quoted = F.regexp_replace(F.regexp_replace("target", r"\\", r"\\\\"), '"', r'\\"')
    value = F.coalesce(F.concat(F.lit('"'), quoted, F.lit('"')), F.lit("null"))
    entry = F.concat(F.lit('"'), F.col("doc_id").cast("string"), F.lit('": '), value)
    objects = labels.groupBy(F.floor(F.col("doc_id") / 200).alias("part")).agg(F.array_join(F.collect_list(entry), ", ").alias("entries"))
    with _scratch(spark) as folder:
        text = objects.select(F.concat(F.lit('{"target": {'), "entries", F.lit("}}")).alias("value"))
        text.write.option("lineSep", ",").text(f"{folder}/labels")
        return cut_lineage(files.read_label_object(spark, f"{folder}/labels"))


@_query("""
  SELECT CASE WHEN doc_id % 4 > 0 THEN doc_id END AS id, CASE WHEN doc_id % 4 > 0 THEN CAST(quality AS VARCHAR) END AS target FROM labels""")
def permissive_labels(spark, sf):
    """A line of JSON per label, every fourth one broken: the broken ones stay as rows without values."""
    good = F.format_string('{"id": %d, "target": "%d"}', "doc_id", "quality")
    lines = _read(spark, sf, "labels").select(F.when(F.col("doc_id") % 4 > 0, good).otherwise("{broken " + "line").alias("value"))
    with _scratch(spark) as folder:
        lines.write.text(f"{folder}/labels")
        return cut_lineage(files.read_json(spark, f"{folder}/labels", schema=schemas.FRAUD_LABELS))


_CSV_SQL = "SELECT c_custkey AS id, repeat('0', 16 - length(CAST(c_custkey AS VARCHAR))) || c_custkey AS card_number, c_name, c_acctbal FROM customer"


@_query(_CSV_SQL)
def csv_snapshot(spark, sf):
    """A dated CSV snapshot written and read back by schema; leading zeros stay."""
    rows = _read(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.lpad(F.col("c_custkey").cast("string"), 16, "0").alias("card_number"), "c_name", "c_acctbal"
    )
    kind = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema.fields])
    with _scratch(spark) as folder:
        snapshots.write_snapshot(rows, f"{folder}/cards", "csv", "2025-05-22")
        return cut_lineage(snapshots.read_snapshot(spark, f"{folder}/cards", "csv", kind))


@_query("SELECT CAST(c_custkey AS VARCHAR) AS id, repeat('0', 16 - length(CAST(c_custkey AS VARCHAR))) || c_custkey AS card_number FROM customer")
def csv_as_text(spark, sf):
    """The raw CSV job and its reading without inference: every column as text, in one pass."""
    rows = _read(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.lpad(F.col("c_custkey").cast("string"), 16, "0").alias("card_number")
    )
    with _scratch(spark) as folder:
        rows.write.option("header", True).csv(f"{folder}/source")
        ingest.ingest_csv(spark, f"{folder}/source", f"{folder}/raw", date="2025-05-22", infer=False)
        return cut_lineage(snapshots.read_snapshot(spark, f"{folder}/raw", "csv", infer=False))


@_query("SELECT CAST(s_suppkey AS INTEGER) AS mcc, s_name AS label FROM supplier")
def json_dictionaries(spark, sf):
    """JSON objects of 50 fields over many lines through the raw zone into the table of codes."""
    entry = F.format_string('\n  "%d": "%s"', "s_suppkey", "s_name")
    objects = _read(spark, sf, "supplier").groupBy(F.floor(F.col("s_suppkey") / 50)).agg(F.array_join(F.collect_list(entry), ",").alias("entries"))
    with _scratch(spark) as folder:
        text = objects.select(F.concat(F.lit("{"), "entries", F.lit("\n}")).alias("value"))
        # One object a file: as many partitions as objects, and a file is read whole.
        text.repartition(64, "value").write.option("maxRecordsPerFile", 1).text(f"{folder}/source")
        ingest.ingest_json_object(spark, f"{folder}/source", f"{folder}/raw", "2025-05-22")
        return cut_lineage(curate.curate_mcc(spark.read.text(f"{folder}/raw/situation_date=2025-05-22")))


@_query("SELECT o_orderkey, o_custkey, o_totalprice, true AS few_files FROM orders")
def snappy_files(spark, sf):
    """Parquet in at most four files, read back."""
    with _scratch(spark) as folder:
        rows = _read(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
        files.write_parquet(rows.repartition(16), f"{folder}/orders", max_files=4)
        back = spark.read.parquet(f"{folder}/orders")
        return cut_lineage(back.withColumn("few_files", F.lit(len(back.inputFiles()) <= 4)))


@_query("SELECT s_suppkey AS id, s_name, s_acctbal FROM supplier")
def managed_table(spark, sf):
    """A managed table created, replaced and read; it is dropped in the end."""
    name = f"stage_{uuid.uuid4().hex}"
    rows = _read(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), "s_name", "s_acctbal")
    try:
        tables.replace_table(rows.limit(1), name)
        tables.replace_table(rows, name)
        return cut_lineage(tables.read_table(spark, name))
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


@_query(f"SELECT t.id, t.client_id, l.target AS has_fraud FROM ({_RAW_TX_SQL}) t LEFT JOIN ({_LABELS_SQL}) l ON t.id = l.id")
def two_roots(spark, sf):
    """Transactions and labels, each at its own latest date."""
    with _scratch(spark) as folder:
        tx, labels = raw_transactions(spark, sf), fraud_labels(spark, sf)
        snapshots.write_snapshot(tx.limit(5), f"{folder}/transactions", "parquet", "2025-05-20")
        snapshots.write_snapshot(tx, f"{folder}/transactions", "parquet", "2025-05-23")
        snapshots.write_snapshot(labels.limit(5), f"{folder}/labels", "parquet", "2025-05-19")
        snapshots.write_snapshot(labels, f"{folder}/labels", "parquet", "2025-05-22")
        latest = [snapshots.read_snapshot(spark, f"{folder}/{name}", "parquet") for name in ("transactions", "labels")]
        return cut_lineage(joins.attach_labels(*latest).select("id", "client_id", "has_fraud"))


@_query("SELECT o_orderkey, o_totalprice, DATE '2025-05-22' AS situation_date FROM orders WHERE o_orderkey % 2 = 0")
def snapshot_in_progress(spark, sf):
    """The newest day's load is not published: readers get the day before, whole."""
    orders = _read(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    with _scratch(spark) as folder:
        snapshots.write_snapshot(orders.where("o_orderkey % 2 = 0"), f"{folder}/raw", "parquet", "2025-05-22")
        manifests.withdraw(spark, f"{folder}/raw", ["2025-05-23"])  # as a load begins, which then writes some of its rows
        files.write_partitioned(stamp_date(orders, "2025-05-23"), f"{folder}/raw", "parquet", ["situation_date"])
        return cut_lineage(snapshots.read_snapshot(spark, f"{folder}/raw", "parquet", keep_date=True))


@_query("""
  SELECT CAST(year(o_orderdate) AS VARCHAR) || '-01-01' AS date, count(*) AS manifest_rows, count(*) AS table_rows, count(*) AS returned, true AS has_files
  FROM orders GROUP BY 1
  UNION ALL SELECT 'table', count(*), count(*), count(*), true FROM orders""")
def load_counts(spark, sf):
    """Rows of each day by its manifest, by the day's files and by the load's result; and of a table by its property."""
    orders = _read(spark, sf, "orders").select("o_orderkey", F.trunc(F.col("o_orderdate").cast("date"), "year").alias("situation_date"))
    name = f"stage_{uuid.uuid4().hex}"
    with _scratch(spark) as folder:
        returned = snapshots.write_snapshot(orders, f"{folder}/raw", "parquet")
        by_files = spark.read.parquet(f"{folder}/raw").groupBy(F.col("situation_date").cast("string").alias("date")).agg(F.count("*").alias("table_rows"))
        counted = manifests.manifests(spark, f"{folder}/raw").join(by_files, "date", "full")
        said = spark.createDataFrame(list(returned.items()), "date string, returned long")
        days = counted.join(said, "date", "full").select("date", F.col("rows").alias("manifest_rows"), "table_rows", "returned", ((F.col("files") > 0) & (F.col("bytes") > 0)).alias("has_files"))
        try:
            written = tables.replace_table(orders, name)
            held = tables.read_table(spark, name).agg(F.lit("table").alias("date"), F.lit(tables.loaded_rows(spark, name)).cast("long").alias("manifest_rows"), F.count("*").alias("table_rows"), F.lit(written).cast("long").alias("returned"), F.lit(True).alias("has_files"))
            return cut_lineage(days.unionByName(held))
        finally:
            spark.sql(f"DROP TABLE IF EXISTS {name}")


@_query(f"""
  SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS date, o_custkey AS client_id, '$' || CAST(CAST(round(o_totalprice) AS BIGINT) AS VARCHAR) AS amount,
         CASE WHEN o_orderstatus = 'P' THEN 'Bad PIN, Technical' END AS errors, DATE '2025-05-22' AS situation_date
  FROM orders WHERE {_DRAW} < CAST(floor(4294967296 * 0.3) AS BIGINT)""")
def seed_sample(spark, sf):
    """The transactions file through the seeding job: read by its schema, sampled by id, dated."""
    held = {
        "id": "o_orderkey", "date": "concat(CAST(CAST(o_orderdate AS DATE) AS STRING), ' 00:01:00')", "client_id": "o_custkey",
        "amount": "concat('$', CAST(CAST(round(o_totalprice) AS BIGINT) AS STRING))", "errors": "CASE WHEN o_orderstatus = 'P' THEN 'Bad PIN, Technical' END",
    }
    rows = _read(spark, sf, "orders").selectExpr(*(f"{held.get(f.name, 'NULL')} AS {f.name}" for f in schemas.TRANSACTION_FILE.fields))
    with _scratch(spark) as folder:
        rows.withColumns({c: F.col(c).cast("string") for c in rows.columns}).write.option("header", True).csv(f"{folder}/transactions")
        found = seeding.seed_rows(spark, f"{folder}/transactions", 30, "2025-05-22")
        return cut_lineage(found.select("id", "date", "client_id", "amount", "errors", "situation_date"))


@_query("SELECT o_orderkey, current_date AS situation_date FROM orders")
def stamp_today(spark, sf):
    return stamp_date(_read(spark, sf, "orders").select("o_orderkey"))


@_query("SELECT c_custkey, c_name AS k1, c_mktsegment AS k2 FROM customer")
def trimmed_keys(spark, sf):
    """Keys with blanks around them."""
    blanks = F.repeat(F.lit(" "), (F.col("c_custkey") % 4).cast("int"))
    rows = _read(spark, sf, "customer").select(
        "c_custkey", F.concat(blanks, "c_name", F.lit(" ")).alias("k1"), F.concat(F.lit(" "), "c_mktsegment", blanks).alias("k2")
    )
    return keys_as_text(rows, "k1", "k2")


@_query(f"""
  SELECT c AS name, CASE WHEN c IN ('n_chars', 'quality', 'toxic') THEN 'numeric' ELSE 'categorical' END AS role, n AS filled
  FROM (SELECT 'n_chars' AS c, count(n_chars) AS n {_DOCS_LABELLED} UNION ALL SELECT 'quality', count(quality) {_DOCS_LABELLED}
        UNION ALL SELECT 'toxic', count(toxic) {_DOCS_LABELLED} UNION ALL SELECT 'lang', count(lang) {_DOCS_LABELLED}
        UNION ALL SELECT 'source', count(source) {_DOCS_LABELLED}) t""")
def feature_roles(spark, sf):
    """Role of each feature column, and its filled rows."""
    rows = _docs_labelled(spark, sf).select(F.col("doc_id").alias("transaction_id"), "lang", "source", "n_chars", "quality", "toxic")
    numeric, categorical = profile.feature_roles(rows)
    names = numeric + categorical
    counts = rows.agg(*[F.count(c).alias(c) for c in names])
    role = F.when(F.col("name").isin(numeric), "numeric").otherwise("categorical")
    return columns_to_rows(counts, names, "name", "filled").select("name", role.alias("role"), "filled")


@_query(f"""
  WITH r AS (SELECT d.doc_id, CAST(l.quality AS DOUBLE) AS q {_DOCS_LABELLED})
  SELECT doc_id, round(coalesce((q - (SELECT avg(q) FROM r)) / (SELECT stddev_pop(q) FROM r), 0), 6) AS scaled FROM r""")
def gaps_to_zero(spark, sf):
    """A missing or NaN number becomes zero in the vector."""
    rows = _docs_labelled(spark, sf).select("doc_id", F.col("quality").cast("double").alias("quality"))
    rows = rows.withColumn("quality", F.when(F.col("quality").isNull() & (F.col("doc_id") % 2 == 0), float("nan")).otherwise(F.col("quality")))
    fitted = features.feature_pipeline(rows, ["quality"], [])
    return fitted.transform(rows).select("doc_id", F.round(vector_to_array("features")[0], 6).alias("scaled"))


_TEXT_PAGE = "SELECT c_name, c_custkey FROM customer ORDER BY c_name LIMIT 20 OFFSET 60"
_HALF_PAGE = "SELECT c_custkey / 4.0E0 AS k, c_name FROM customer ORDER BY k LIMIT 20 OFFSET 60"


def _text_keys(spark, sf):
    return _read(spark, sf, "customer").select("c_name", "c_custkey")


def _fractions(spark, sf):
    return _read(spark, sf, "customer").select((F.col("c_custkey") / 4.0).alias("k"), "c_name")


@_query(_TEXT_PAGE)
def page_text(spark, sf):
    return paging.page_rows(_text_keys(spark, sf), 4, 20, "c_name")


@_query(_TEXT_PAGE.replace("OFFSET 60", "OFFSET 600"))
def page_text_deep(spark, sf):
    """A page found from fences, which are made once."""
    rows = _text_keys(spark, sf)
    return paging.page_rows(rows, 31, 20, "c_name", fences=paging.make_fences(rows, "c_name", 100))


@_query(f"SELECT 31 AS page, * FROM ({_TEXT_PAGE.replace('OFFSET 60', 'OFFSET 600')}) a UNION ALL SELECT 40, * FROM ({_TEXT_PAGE.replace('OFFSET 60', 'OFFSET 780')}) b")
def pages_from_one_fence(spark, sf):
    """Two deep pages of text keys from one stored fence table."""
    rows = _text_keys(spark, sf)
    with _scratch(spark) as folder:
        fences = paging.make_fences(rows, "c_name", 64, f"{folder}/fences")
        pages = [paging.page_rows(rows, n, 20, "c_name", fences=fences).select(F.lit(n).alias("page"), "c_name", "c_custkey") for n in (31, 40)]
        return cut_lineage(pages[0].unionByName(pages[1]))


@_query(_HALF_PAGE)
def page_fraction(spark, sf):
    return paging.page_rows(_fractions(spark, sf), 4, 20, "k")


@_query(_HALF_PAGE.replace("OFFSET 60", "OFFSET 600"))
def page_fraction_deep(spark, sf):
    rows = _fractions(spark, sf)
    return paging.page_rows(rows, 31, 20, "k", fences=paging.make_fences(rows, "k", 100))


@_query(_HALF_PAGE.replace("OFFSET 60", "OFFSET 640"))
def page_fraction_counted(spark, sf):
    """The same without fences: ranges are made and counted for the one page."""
    return paging.page_rows(_fractions(spark, sf), 33, 20, "k", shallow_rows=200)


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLE)
