import hashlib
import random

import pytest
from pyspark.sql import functions as F

from swipelake import queries as registered
from swipelake.operators import sampling


def test_hash_samples_are_nested_and_repeatable(spark):
    df = spark.range(5000)
    kept = [{r["id"] for r in sampling.hash_sample(df, "id", p).collect()} for p in (30, 70, 100)]
    assert kept[0] < kept[1] < kept[2] and len(kept[2]) == 5000
    assert abs(len(kept[1]) - 3500) < 150
    assert kept[1] == {r["id"] for r in sampling.hash_sample(df.repartition(5), "id", 70).collect()}


@pytest.mark.parametrize("percentage", [0, -1, 101])
def test_percentage_range(spark, percentage):
    for sample in (lambda: sampling.hash_sample(spark.range(3), "id", percentage),
                   lambda: sampling.bernoulli_sample(spark.range(3), percentage)):
        with pytest.raises(ValueError):
            sample()


def test_bernoulli(spark):
    assert sampling.bernoulli_sample(spark.range(50), 100).count() == 50
    assert 600 < sampling.bernoulli_sample(spark.range(1000), 70, 1).count() < 800


def digest(i):
    return hashlib.md5(str(i).encode()).hexdigest()


def test_grants_follow_the_digest_order(spark):
    rng = random.Random(2)
    rows = [(i, "hot" if i % 10 else f"s{i % 30}", rng.randint(1, 4)) for i in range(1500)]
    df = spark.createDataFrame(rows, "id bigint, s string, w bigint")
    quotas = {"hot": 777, "s0": 0, "s10": 10**6, "s20": 1}
    q = spark.createDataFrame(list(quotas.items()), "s string, quota bigint")
    got = {r["id"]: r["granted"] for r in sampling.grant_quotas(df, "s", "id", q, F.col("w")).collect()}
    for stratum, quota in quotas.items():
        left = quota
        for i, _, w in sorted((r for r in rows if r[1] == stratum), key=lambda r: digest(r[0])):
            assert got[i] == max(0, min(w, left))
            left -= got[i]


def test_split_is_exact_and_complete(spark):
    sizes = {"a": 1, "b": 5, "c": 1000, "d": 33}
    rows = [(i, label) for i, label in enumerate(c for c, n in sizes.items() for _ in range(n))]
    df = spark.createDataFrame(rows, "id bigint, label string")
    got = sampling.stratified_split(df, "label", "id").collect()
    assert len(got) == len(rows) and len({r["id"] for r in got}) == len(rows)
    test = {c: sum(r["is_test"] for r in got if r["label"] == c) for c in sizes}
    assert all(abs(test[c] - 0.2 * n) <= 1 for c, n in sizes.items())
    assert sum(test.values()) == -(-len(rows) // 5)
    chosen = {r["id"] for r in got if r["label"] == "c" and r["is_test"]}
    first = sorted((i for i, c in rows if c == "c"), key=digest)[: test["c"]]
    assert chosen == set(first)


def test_null_keys_fail(spark):
    rows = spark.createDataFrame([(None if i % 2 else i, i % 3) for i in range(100)], "id long, label int")
    with pytest.raises(Exception, match="a row has no id"):
        sampling.stratified_split(rows, "label", "id", 0.2).collect()


def test_a_key_that_repeats_at_the_cut_fails(spark):
    rows = spark.createDataFrame([(i % 10, 1) for i in range(100)], "id long, label int")
    with pytest.raises(Exception, match="repeats where a quota ends"):
        sampling.stratified_split(rows, "label", "id", 0.15).collect()


def test_a_chance_per_class(spark):
    """About the asked share of each class, keys of the table, nested in larger chances; no count is run."""
    df = spark.range(20_000).selectExpr("id", "CASE WHEN id % 100 = 0 THEN NULL WHEN id % 3 = 0 THEN 'a' ELSE 'b' END AS c")
    small = sampling.sample_by_chance(df, "c", "id", {"a": 0.2, "b": 0.05}, 0.5)
    n = {r["c"]: r["count"] for r in small.groupBy("c").count().collect()}
    whole = {r["c"]: r["count"] for r in df.groupBy("c").count().collect()}
    for c, share in (("a", 0.2), ("b", 0.05), (None, 0.5)):
        assert abs(n[c] - share * whole[c]) < 5 * (whole[c] * share * (1 - share)) ** 0.5
    large = sampling.sample_by_chance(df, "c", "id", {"a": 0.3, "b": 0.05, "x": 1}, 0.5)
    assert small.exceptAll(large).count() == 0 and small.exceptAll(df).count() == 0
    assert sampling.sample_by_chance(df.repartition(3), "c", "id", {"a": 0.2, "b": 0.05}, 0.5).exceptAll(small).count() == 0
    assert sampling.sample_by_chance(df, "c", "id", {"a": 1}).count() == whole["a"]
    with pytest.raises(ValueError):
        sampling.sample_by_chance(df, "c", "id", {"a": 1.2})


def test_split_by_chance(spark):
    df = spark.range(10_000).selectExpr("id", "id % 10 = 0 AS rare")
    marked = sampling.split_by_chance(df, "id", 0.2)
    for rare in (True, False):
        rows = marked.where(F.col("rare") == rare)
        assert abs(rows.where("is_test").count() / rows.count() - 0.2) < 0.07
    assert marked.count() == 10_000 and "Exchange" not in marked._jdf.queryExecution().toString()
    with pytest.raises(ValueError):
        sampling.split_by_chance(df, "id", 1)


def test_a_draw_is_checked_over_whole_rows(spark, tmp_path):
    rows = [(i if i % 50 else None, f"c{i % 7}", i * 0.5) for i in range(1000)] * 2  # null keys, and every row twice
    spark.createDataFrame(rows, "o_orderkey bigint, o_comment string, o_totalprice double").write.parquet(f"{tmp_path}/orders.parquet")
    assert "bernoulli_sample" in registered.oracle_sql()
    found = registered.queries()["bernoulli_sample"](spark, str(tmp_path))
    assert [tuple(r) for r in found.collect()] == [(2000, True, True, True, True)]
    drawn = registered.queries()["bernoulli_rows"](spark, str(tmp_path))
    assert drawn.columns == ["o_orderkey", "o_comment", "o_totalprice"] and 1200 < drawn.count() < 1600
