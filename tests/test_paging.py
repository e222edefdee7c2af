import random

import pytest
from pyspark.errors import PySparkException

from swipelake.operators import paging
from swipelake.operators.histogram import equal_load_cuts, narrow_to_offset, range_counts
from swipelake.operators.lookup import one_or_none, with_related


def ids(df, key="id"):
    return [r[key] for r in df.collect()]


def test_pages_concatenate_to_the_table(spark):
    keys = random.Random(1).sample(range(10_000), 95)
    df = spark.createDataFrame([(k, f"v{k}") for k in keys], "id bigint, v string")
    pages = [ids(paging.page_rows(df, p, 20)) for p in range(1, 7)]
    assert [k for p in pages for k in p] == sorted(keys)
    deep = [ids(paging.page_rows(df, p, 20, shallow_rows=3)) for p in range(1, 7)]
    assert deep == pages
    after, last = [], None
    while got := ids(paging.page_after(df, last, 20)):
        after, last = after + got, got[-1]
    assert after == sorted(keys)


def test_deep_offset_in_unevenly_spread_keys(spark):
    keys = sorted([*range(5000), 2**62, -(2**61), *range(10**12, 10**12 + 700)])
    df = spark.createDataFrame([(k,) for k in keys], "id bigint")
    for offset in (0, 1, 2500, 4999, 5003, len(keys) - 1, len(keys), len(keys) + 9):
        near, rest = narrow_to_offset(df, "id", offset, 10)
        assert rest <= 10 or offset <= 10
        assert ids(near.orderBy("id").offset(rest).limit(2)) == keys[offset : offset + 2]


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_cuts_share_out_the_rows(spark, parts):
    keys = [*range(3000), 10**15, *range(10**9, 10**9 + 3000)]
    df = spark.createDataFrame([(k,) for k in keys], "id bigint")
    cuts = equal_load_cuts(range_counts(df, "id"), min(keys), max(keys), parts)
    assert cuts == sorted(set(cuts)) and len(cuts) == parts - 1
    edges = [min(keys), *cuts, max(keys) + 1]
    loads = [sum(a <= k < b for k in keys) for a, b in zip(edges, edges[1:])]
    assert sum(loads) == len(keys) and max(loads) <= len(keys) / parts * 1.1 + 5


def test_envelope(spark):
    df = spark.range(40).selectExpr("id", "id * 2 AS v")

    def envelope(page, limit):
        return paging.page_envelope(paging.page_rows(df, page, limit), page, limit)

    row = envelope(2, 20).first()  # ends exactly at the end of the table
    assert (row["page"], row["limit"], row["count"], row["next_page"], row["prev_page"]) == (2, 20, 20, 3, 1)
    assert [d["id"] for d in row["data"]] == list(range(20, 40))
    row = envelope(1, 50).first()
    assert (row["count"], row["next_page"], row["prev_page"]) == (40, None, None)
    with pytest.raises(PySparkException, match="Page out of range"):
        envelope(3, 20).collect()
    empty = paging.page_envelope(paging.page_rows(df.where("id < 0"), 1, 5), 1, 5).first()
    assert (empty["count"], empty["data"]) == (0, [])


@pytest.mark.parametrize(("page", "limit"), [(0, 10), (1, 0), (1, 1001)])
def test_bounds(spark, page, limit):
    with pytest.raises(ValueError):
        paging.page_rows(spark.range(3), page, limit)


def test_first_rows_of_owner(spark):
    df = spark.range(100).selectExpr("99 - id AS id", "(99 - id) % 4 AS client_id")
    assert ids(paging.first_rows_of(df, "client_id", 1)) == [1 + 4 * i for i in range(10)]


def test_lookup(spark, tmp_path, explain):
    tx = spark.createDataFrame([(1, 7), (2, 8), (2, 9), (3, 70)], "id int, client_id int")
    users = spark.createDataFrame([(i, f"u{i}") for i in range(20)], "id int, name string")
    users.write.parquet(f"{tmp_path}/u")
    users = spark.read.parquet(f"{tmp_path}/u")
    full = with_related(one_or_none(tx, "id", 1), users, "client_id", "id", ["id", "name"], "client")
    assert full.first().asDict(recursive=True) == {"id": 1, "client_id": 7, "client": {"id": 7, "name": "u7"}}
    assert "EqualTo(id,ScalarSubquery" in full._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    assert with_related(one_or_none(tx, "id", 3), users, "client_id", "id", ["id"], "client").first()["client"] is None
    assert one_or_none(tx, "id", 99).count() == 0
    with pytest.raises(PySparkException, match="more than one row"):
        one_or_none(tx, "id", 2).collect()


@pytest.mark.parametrize("kind", ["string", "double", "date"])
def test_pages_of_other_keys_at_any_depth(spark, kind):
    key = {"string": "lpad(cast(id * 7919 % 1000 AS string), 5, '0')", "double": "(id * 7919 % 1000) / 4", "date": "date_add(DATE '2000-01-01', cast(id * 7919 % 1000 AS int))"}[kind]
    df = spark.range(1000).selectExpr(f"{key} AS k", "id").repartition(5)
    want = sorted(map(tuple, df.collect()))
    for page in (1, 7, 50, 51):
        for shallow in (5, 100, 10_000):
            got = paging.page_rows(df, page, 20, "k", shallow_rows=shallow).collect()
            assert [tuple(r) for r in got] == want[(page - 1) * 20 : page * 20]


@pytest.mark.parametrize("kind", ["bigint", "string", "double", "date"])
def test_pages_between_fences(spark, tmp_path, kind):
    """All pages of a table from one fence table, whatever the type of the key; no page shuffles or counts the keys."""
    values = {"bigint": "id * 7 - 900", "string": "concat('k', lpad(CAST(id * 7 AS STRING), 6, '0'))", "double": "id / 7D", "date": "date_add(DATE '2000-01-01', CAST(id AS INT))"}
    df = spark.range(500).selectExpr(f"{values[kind]} AS k", "id AS v").union(spark.sql(f"SELECT CAST(NULL AS {kind}), 0L")).repartition(7)
    fences = paging.make_fences(df, "k", 30, f"{tmp_path}/fences")
    want = [r["k"] for r in df.where("k is not null").orderBy("k").collect()]
    assert [(r["rank"], r["key"]) for r in fences.orderBy("rank").collect()] == [(i, want[i]) for i in range(0, 500, 30)]
    got = [[r["k"] for r in paging.page_rows(df, p, 40, "k", fences=fences).collect()] for p in range(1, 15)]
    assert [k for page in got for k in page] == want and got[13] == []


def test_a_page_between_fences_shuffles_no_keys(spark, tmp_path, explain, monkeypatch):
    spark.range(5000).selectExpr("concat('k', lpad(CAST(id AS STRING), 6, '0')) AS k", "id AS v").write.parquet(f"{tmp_path}/rows")
    df = spark.read.parquet(f"{tmp_path}/rows")
    fences = paging.make_fences(df, "k", 100)
    keys, offset = paging._between_fences(df, "k", fences, 2030, 20)
    plan = explain(keys.orderBy("k").offset(offset).limit(20))
    assert offset == 30 and "Exchange" not in plan and "PushedFilters: [IsNotNull(k), GreaterThanOrEqual(k,k002000), LessThanOrEqual(k,k002100)]" in plan
    monkeypatch.setattr(type(df), "repartitionByRange", lambda *a: pytest.fail("keys are dealt again"))
    assert [r["v"] for r in paging.page_rows(df, 102, 20, "k", fences=fences).collect()] == list(range(2020, 2040))


def test_fences_of_an_empty_table(spark):
    df = spark.range(0).selectExpr("id AS k")
    assert paging.page_rows(df, 1, 5, "k", fences=paging.make_fences(df, "k")).count() == 0
