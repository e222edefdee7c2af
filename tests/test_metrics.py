import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from swipelake.operators import metrics
from swipelake.operators.ranking import top_by_rank, top_clients

TX = "id bigint, date date, client_id int, amount double, use_chip string, has_fraud string"
USERS = (
    "id int, current_age int, retirement_age int, gender string, yearly_income double, total_debt double, credit_score int"
)


@pytest.fixture(scope="module")
def tx(spark):
    rng = random.Random(3)
    rows = [
        (i, date(2010 + i % 7, 1 + i % 12, 1), i % 9, rng.choice([None, round(rng.uniform(-50, 500), 2)]),
         rng.choice(["Swipe", "Chip", None]), rng.choice(["Yes", "No", None]))
        for i in range(800)
    ]
    return spark.createDataFrame(rows, TX).cache()


@pytest.fixture(scope="module")
def users(spark):
    rng = random.Random(4)
    rows = [
        (i, rng.randint(18, 90), rng.randint(60, 70), rng.choice(["Male", "Female"]),
         rng.choice([0.0, None, round(rng.uniform(1, 9e4), 2)]), round(rng.uniform(0, 9e4), 2),
         rng.choice([None, rng.randint(400, 850)]))
        for i in range(400)
    ]
    return spark.createDataFrame(rows, USERS).cache()


def same(a, b):
    assert a.columns == b.columns and a.dtypes == b.dtypes
    key = lambda r: repr(r[0])
    rows = list(zip(sorted(a.collect(), key=key), sorted(b.collect(), key=key), strict=True))
    for x, y in rows:
        assert [pytest.approx(float(v), abs=0.011) if isinstance(v, float) else v for v in x] == list(y)


def test_cube_gives_the_direct_transaction_metrics(tx):
    cube = metrics.transaction_cube(tx)
    same(metrics.yearly_metrics(tx), metrics.yearly_from_cube(cube))
    same(metrics.category_metrics(tx), metrics.category_from_cube(cube))
    assert metrics.yearly_metrics(tx).agg(F.sum("total_transactions")).first()[0] == tx.count()


def test_cube_gives_the_direct_client_metrics(users):
    tables = metrics.client_metrics_from_cube(metrics.client_cube(users))
    same(
        metrics.group_means(
            users, "gender", {"avg_total_debt": "total_debt", "avg_credit_score": "credit_score", "avg_yearly_income": "yearly_income"}
        ),
        tables["gender_metrics"],
    )
    same(metrics.ratio_stats(users, "total_debt", "yearly_income"), tables["dti_metrics"])
    same(
        metrics.bucket_metrics(
            users, "current_age", {"avg_income": "yearly_income", "avg_debt": "total_debt", "avg_credit_score": "credit_score"}
        ),
        tables["age_bucket_metrics"],
    )
    same(
        metrics.band_metrics(users, "credit_score", {"avg_income": "yearly_income", "avg_debt": "total_debt"}),
        tables["score_classification"],
    )
    same(metrics.difference_stats(users, F.col("retirement_age"), F.col("current_age")), tables["retirement_stats"])


def test_decimal_percentage_of_a_year(spark):
    rows = [(i, date(2020, 1, 1), 1, 1.0, "Chip", "Yes" if i < 74 else "No") for i in range(231)]
    df = spark.createDataFrame(rows, TX)
    assert float(metrics.yearly_metrics(df).first()["pct_fraud"]) == 32.04
    assert metrics.category_metrics(df).first()["fraud_pct"] == 32.03


def test_ranks_with_ties_and_missing_users(spark):
    # ranks 1, 2, ..., 9, then five clients that share the tenth place, then one below
    totals = [(c, 1000.0 - c) for c in range(9)] + [(c, 500.0) for c in range(9, 14)] + [(14, 1.0), (15, None)]
    totals = spark.createDataFrame(totals, "client_id int, total_sent double")
    users = spark.createDataFrame([(i, f"u{i}") for i in range(16) if i != 3], "id int, name string")
    top = top_clients(totals, users).collect()
    assert [r["id"] for r in top][:8] == [0, 1, 2, 4, 5, 6, 7, 8]
    assert {r["id"]: r["rank"] for r in top} == {0: 1, 1: 2, 2: 3, 4: 5, 5: 6, 6: 7, 7: 8, 8: 9} | {c: 10 for c in range(9, 14)}
    assert [r["total_sent"] for r in top] == sorted((r["total_sent"] for r in top), reverse=True)


def test_rank_by_definition(spark):
    rng = random.Random(5)
    for _ in range(4):
        rows = [(i, rng.choice([None, float("nan"), *map(float, range(6))])) for i in range(rng.randint(1, 40))]
        df = spark.createDataFrame(rows, "k int, v double")
        expected = df.createOrReplaceTempView("t") or spark.sql(
            "SELECT * FROM (SELECT *, rank() OVER (ORDER BY v DESC NULLS LAST) AS rank FROM t) WHERE rank <= 10"
        )
        got = top_by_rank(df, "v", 10)
        assert sorted(map(repr, got.collect())) == sorted(map(repr, expected.collect()))


def test_no_window_over_all_rows(spark, explain):
    df = spark.range(1000).select("id", (F.col("id") % 3).cast("double").alias("v"))
    plan = explain(top_by_rank(df, "v", 10))
    assert "TakeOrderedAndProject(limit=10" in plan and "BroadcastHashJoin" in plan
    assert top_by_rank(df, "v", 10).count() == 333
