import pytest
from pyspark.sql import functions as F

from swipelake.operators import joins


def test_labels(spark):
    tx = spark.createDataFrame([(1,), (2,), (3,), (None,)], "id bigint")
    labels = spark.createDataFrame([(1, "Yes"), (2, "No"), (9, "Yes")], "id bigint, target string")
    got = {r["id"]: r["has_fraud"] for r in joins.attach_labels(tx, labels).collect()}
    assert got == {1: "Yes", 2: "No", 3: None, None: None}


def test_duplicate_label_is_refused(spark):
    labels = spark.createDataFrame([(1, "Yes"), (1, "No"), (None, "x"), (None, "y")], "id bigint, target string")
    with pytest.raises(joins.DuplicateKey):
        joins.require_unique(labels, "id")
    joins.require_unique(labels.where("target <> 'No'"), "id")


def test_enrichment(spark):
    tx = spark.createDataFrame(
        [(1, 10, 100, 5812, "$"), (2, 11, 101, 1, "$"), (3, 99, 999, None, "$")],
        "id bigint, client_id int, card_id int, mcc int, currency string",
    )
    labels = spark.createDataFrame([(1, "Yes")], "id bigint, target string")
    mcc = spark.createDataFrame([(5812, "Eating")], "mcc int, label string")
    cards = spark.createDataFrame([(100, 55, "***1"), (101, 11, "***2")], "id int, client_id int, card_number string")
    users = spark.createDataFrame([(10, "F", "$"), (11, "M", "$")], "id int, gender string, currency string")
    out = joins.enrich_transactions(tx, labels, mcc, cards, users)
    assert out.columns == [
        "transaction_id", "client_id", "card_id", "mcc", "currency", "is_fraud", "mcc_description", "card_number",
        "gender", "user_currency",
    ]
    rows = {r["transaction_id"]: r for r in out.collect()}
    assert rows[1]["client_id"] == 10 and rows[1]["gender"] == "F" and rows[1]["mcc_description"] == "Eating"
    assert rows[1]["is_fraud"] == "Yes" and rows[2]["is_fraud"] is None and rows[2]["mcc_description"] is None
    assert rows[3]["card_number"] is None and rows[3]["gender"] is None and len(rows) == 3


def test_small_lookup_is_broadcast_and_large_one_shuffled(spark, explain, tmp_path):
    spark.range(1000).selectExpr("id", "'Yes' AS target").write.parquet(f"{tmp_path}/l")
    labels = spark.read.parquet(f"{tmp_path}/l")
    tx = spark.range(2000)
    assert "BroadcastHashJoin" in explain(joins.attach_labels(tx, labels))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = explain(joins.attach_labels(tx, labels))
        assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_and_null_keys_are_split(spark, explain):
    """A third of the rows on one client, a third without one: both partitions are split."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.col("id") % 500)
        tx = spark.range(0, 60_000, 1, 12).select("id", key.alias("client_id"), F.md5(F.col("id").cast("string")).alias("t"))
        users = spark.range(500).selectExpr("id", "concat('u', id) AS name")
        out = joins.lookup_join(tx, users, "client_id", "id")
        assert out.where("client_id = 7").select("name").distinct().count() == 1
        plan = explain(out, final=True)
        assert "skew=true" in plan
        assert out.count() == 60_000 and out.where("name IS NULL").count() == 20_000
    finally:
        for name in settings:
            spark.conf.unset(name)


def test_counted_broadcast(spark, explain):
    small = spark.range(5)
    assert "BroadcastExchange" in explain(spark.range(10).join(joins.broadcast_if_small(small, 5), "id"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastExchange" not in explain(spark.range(10).join(joins.broadcast_if_small(small, 4), "id"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
