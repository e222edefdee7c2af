"""Files to raw zone to tables to metrics to model, in a temporary folder."""

import csv
import json
import random
from datetime import date

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from swipelake import schemas
from swipelake.operators import model
from swipelake.plans import curate, ingest, metrics, seed, serve, train
from swipelake.sources import files, manifests, snapshots, tables


def write_csv(path, header, rows):
    with open(path, "w", newline="") as f:
        out = csv.writer(f)
        out.writerow(header)
        out.writerows(rows)
    return str(path)


CLIENTS = 30


@pytest.fixture(scope="module")
def inputs(tmp_path_factory):
    d = tmp_path_factory.mktemp("inputs")
    rng = random.Random(11)
    user_rows = [
        [i, rng.randint(20, 80), 66, 1970, 1, rng.choice(["Male", "Female"]), f"{i} Road, Town", 1.5, 2.5,
         f"${rng.randint(1, 9) * 1000}", f"${rng.randint(2, 9) * 10_000}", f"${rng.randint(0, 9) * 999}",
         rng.randint(500, 800), 2]
        for i in range(CLIENTS)
    ]
    card_rows = [[100 + i, i, 4344676511950000 + i, 123, f"${i * 500}"] for i in range(CLIENTS)]
    tx_rows = []
    for i in range(1, 401):
        fraud = i % 8 == 0
        amount = f"${rng.uniform(300, 400):,.2f}" if fraud else f"$-{rng.uniform(1, 99):.2f}"
        tx_rows.append([i, f"20{10 + i % 5}-03-0{1 + i % 9} 00:0{i % 10}:00", i % CLIENTS, 100 + i % CLIENTS, amount,
                        rng.choice(["Swipe Transaction", "Chip Transaction"]), 7, "Town, West", "NY", "07008",
                        rng.choice([5812, 5541, 9999]), rng.choice(["", "Bad PIN,Technical Glitch", ""])])
    label_rows = [[i, "Yes" if i % 8 == 0 else "No"] for i in range(1, 381)]
    with open(d / "mcc.json", "w") as f:
        json.dump({"5812": "Eating Places, Restaurants", "5541": "Service Stations"}, f, indent=2)
    with open(d / "labels.json", "w") as f:
        json.dump({"target": {str(i): t for i, t in label_rows}}, f)
    return {
        "users": write_csv(d / "users.csv", schemas.USERS_FILE.names, user_rows),
        "cards": write_csv(d / "cards.csv", ["id", "client_id", "card_number", "cvv", "credit_limit"], card_rows),
        "tx": write_csv(d / "tx.csv", schemas.TRANSACTION_FILE.names, tx_rows),
        "labels": write_csv(d / "labels.csv", ["id", "target"], label_rows),
        "labels_json": str(d / "labels.json"),
        "mcc": str(d / "mcc.json"),
    }


@pytest.fixture(scope="module")
def raw(spark, inputs, tmp_path_factory):
    """Two days: 70 % of the transactions, then all; the second day loaded twice."""
    root = str(tmp_path_factory.mktemp("raw"))
    for day, percentage in (("2025-05-22", 70), ("2025-05-23", 100), ("2025-05-23", 100)):
        ingest.ingest_csv(spark, inputs["users"], f"{root}/users_data", schemas.USERS_FILE, day)
        ingest.ingest_csv(spark, inputs["cards"], f"{root}/cards_data", None, day)
        ingest.ingest_json_object(spark, inputs["mcc"], f"{root}/mcc_codes", day)
        ingest.ingest_transactions(seed.seed_rows(spark, inputs["tx"], percentage, day), f"{root}/transactions")
    ingest.ingest_labels(spark, inputs["labels"], f"{root}/fraud_labels", "csv", "2025-05-21")
    return root


@pytest.fixture(scope="module")
def curated(spark, raw):
    spark.sql("CREATE DATABASE IF NOT EXISTS shop")
    curate.curate(spark, raw, "shop")
    return "shop"


def test_snapshots(spark, raw, tmp_path):
    root = f"{raw}/transactions"
    assert snapshots.snapshot_dates(spark, root) == ["2025-05-22", "2025-05-23"]
    latest = snapshots.read_snapshot(spark, root, "parquet")
    assert latest.count() == 400 and {"year", "month"} <= set(latest.columns) and "situation_date" not in latest.columns
    first = snapshots.read_snapshot(spark, root, "parquet", date="2025-05-22", keep_date=True)
    assert 230 < first.count() < 330
    assert first.select("situation_date").distinct().first()[0] == date(2025, 5, 22)
    with pytest.raises(snapshots.NoSnapshot):
        snapshots.latest_date(spark, str(tmp_path))
    with pytest.raises(snapshots.NoSnapshot):
        snapshots.latest_date(spark, f"{tmp_path}/missing")


def test_stray_entries_are_ignored(spark, tmp_path):
    root = f"{tmp_path}/r"
    snapshots.write_snapshot(spark.range(3), root, "parquet", "2025-01-02")
    spark.range(9).write.parquet(f"{root}/situation_date=9999")
    spark.range(9).write.parquet(f"{root}/other")
    assert snapshots.read_snapshot(spark, root, "parquet").count() == 3


@pytest.mark.parametrize(("mode", "dates", "rows"), [("dynamic", 2, 5), ("static", 1, 5), ("append", 2, 10)])
def test_write_modes(spark, tmp_path, mode, dates, rows):
    root = str(tmp_path)
    for day in ("2025-01-01", "2025-01-02", "2025-01-02"):
        snapshots.write_snapshot(spark.range(5), root, "csv", day, mode=mode)
    assert len(snapshots.snapshot_dates(spark, root)) == dates
    assert snapshots.read_snapshot(spark, root, "csv").count() == rows
    with pytest.raises(ValueError):
        snapshots.write_snapshot(spark.range(5), root, "csv", mode="other")


def test_a_large_day_is_written_by_several_tasks(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    try:
        rows = spark.range(60_000).select("id", F.md5(F.col("id").cast("string")).alias("t"))
        snapshots.write_snapshot(rows, str(tmp_path), "parquet", "2025-01-01")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    back = spark.read.parquet(str(tmp_path))
    assert back.count() == 60_000 and len(back.inputFiles()) > 3


def test_latest_date_prunes_partitions(spark, raw):
    df = snapshots.latest_rows(spark.read.parquet(f"{raw}/transactions"))
    assert df.count() == 400
    plan = df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    assert "PartitionFilters: [isnotnull(situation_date" in plan


def test_label_inputs_agree(spark, inputs):
    a = files.read_csv(spark, inputs["labels"], schemas.FRAUD_LABELS)
    b = files.read_label_object(spark, inputs["labels_json"])
    assert sorted(a.collect()) == sorted(b.collect()) and a.count() == 380


def test_label_object_with_plain_values(spark, tmp_path):
    (tmp_path / "l.json").write_text('{\n "target": {\n  "12": 1,\n  "13": true,\n  "14": "not sure"\n }\n}')
    got = {tuple(r) for r in files.read_label_object(spark, str(tmp_path / "l.json")).collect()}
    assert got == {(12, "1"), (13, "true"), (14, "not sure")}


def test_permissive_json_and_inferred_csv(spark, tmp_path, inputs):
    (tmp_path / "l.json").write_text('{"id": 1, "target": "Yes"}\nnot json\n{"id": 2, "target": "No"}\n')
    rows = files.read_json(spark, str(tmp_path / "l.json"), schema=schemas.FRAUD_LABELS).collect()
    assert len(rows) == 3 and sum(r["id"] is None for r in rows) == 1
    ingest.ingest_labels(spark, str(tmp_path / "l.json"), f"{tmp_path}/raw", "json", "2025-01-01")
    assert snapshots.read_snapshot(spark, f"{tmp_path}/raw", "parquet").count() == 2
    assert dict(files.read_csv(spark, inputs["cards"]).dtypes)["card_number"] == "bigint"
    entries = files.read_json_dictionary(spark, inputs["mcc"]).first()["entries"]
    assert entries["5812"] == "Eating Places, Restaurants"


def test_both_json_layouts_hold_the_same_object(spark, tmp_path, inputs):
    for fields in (False, True):
        ingest.ingest_json_object(spark, inputs["mcc"], f"{tmp_path}/{fields}", "2025-01-01", fields=fields)
    a, b = (
        curate.curate_mcc(snapshots.read_snapshot(spark, f"{tmp_path}/{f}", "text")).collect() for f in (False, True)
    )
    assert sorted(a) == sorted(b) and len(a) == 2
    wide = snapshots.read_snapshot(spark, f"{tmp_path}/True", "json")
    assert sorted(wide.columns) == ["5541", "5812"]


def test_a_header_in_another_order_is_refused(spark, tmp_path):
    path = write_csv(tmp_path / "l.csv", ["target", "id"], [["Yes", 1]])
    with pytest.raises(Exception, match="CSV header does not conform"):
        files.read_csv(spark, path, schemas.FRAUD_LABELS).collect()


def test_the_date_of_a_timestamp_is_kept(spark, inputs):
    rows = seed.seed_rows(spark, inputs["tx"], date="2025-05-22")
    assert dict(rows.dtypes)["date"] == "date" and rows.where("id = 1").first()["date"] == date(2011, 3, 2)
    assert rows.where("date IS NULL").count() == 0 and rows.where("zip = '07008'").count() == 400


def test_plain_parquet(spark, tmp_path):
    files.write_parquet(spark.range(0, 100, 1, 6), f"{tmp_path}/a", max_files=3)
    back = spark.read.parquet(f"{tmp_path}/a")
    assert back.count() == 100 and len(back.inputFiles()) == 3
    files.write_parquet(spark.range(7), f"{tmp_path}/a")
    assert spark.read.parquet(f"{tmp_path}/a").count() == 7


def test_curated_tables(spark, curated):
    tx = tables.read_table(spark, f"{curated}.transactions")
    assert "errors" not in tx.columns and dict(tx.dtypes)["amount"] == "double"
    row = tx.where("id = 1").first()
    assert row["amount"] < 0 and row["currency"] == "$-" and row["has_fraud"] == "No"
    assert tx.where("has_fraud IS NULL").count() == 20 and tx.count() == 400
    errors = tables.read_table(spark, f"{curated}.errors")
    assert errors.columns == ["id", "errors"] and errors.where("errors = ''").count() == 0 < errors.count()
    card = tables.read_table(spark, f"{curated}.cards").where("id = 101").first()
    assert card["card_number"] == "*" * 13 + "001" and card["credit_limit"] == 500.0 and "cvv" not in card.asDict()
    user = tables.read_table(spark, f"{curated}.users")
    assert {"latitude", "longitude"}.isdisjoint(user.columns) and dict(user.dtypes)["yearly_income"] == "double"
    assert user.where("currency = '$'").count() == CLIENTS
    assert {tuple(r) for r in tables.read_table(spark, f"{curated}.mcc").collect()} == {
        (5812, "Eating Places, Restaurants"), (5541, "Service Stations")
    }


def test_datamart(spark, curated):
    mart = {}
    metrics.publish_all(spark, lambda df, name, small: mart.update({name: df}), curated)
    assert set(mart) == {
        "transactions", "users", "transactions_yearly_metrics", "use_chip_metrics", "gender_metrics", "dti_metrics",
        "age_bucket_metrics", "score_classification", "retirement_stats", "top_10_clients",
    }
    assert {"year", "month"}.isdisjoint(mart["transactions"].columns)
    years = mart["transactions_yearly_metrics"].collect()
    assert [r["year"] for r in years] == [2010, 2011, 2012, 2013, 2014] and sum(r["total_transactions"] for r in years) == 400
    top = mart["top_10_clients"].collect()
    assert len(top) >= 10 and top[0]["rank"] == 1 and top[0]["total_sent"] == max(r["total_sent"] for r in top)
    assert mart["users"].count() == CLIENTS


def test_reads(spark, curated):
    tx, users = (tables.read_table(spark, f"{curated}.{t}") for t in ("transactions", "users"))
    page = serve.transaction_page(tx, 8, 50).first()
    assert (page["count"], page["next_page"], page["prev_page"]) == (50, 9, 7)
    assert page["data"][0].asDict().keys() == {*schemas.TRANSACTION_VIEW}
    with pytest.raises(PySparkException, match="Page out of range"):
        serve.transaction_page(tx, 9, 50).collect()
    assert serve.client_page(users).first()["count"] == CLIENTS
    one = serve.transaction_with_client(tx, users, 31).first()
    assert one["client"]["id"] == one["client_id"] == 1 and set(one["client"].asDict()) == set(schemas.CLIENT_VIEW)
    assert [r["id"] for r in serve.transactions_of(tx, 1).collect()] == [1 + 30 * i for i in range(10)]
    assert [r["id"] for r in serve.transactions_after(tx, 398, 5).collect()] == [399, 400]
    for miss in (lambda: serve.transaction_with_client(tx, users, 9999), lambda: serve.transactions_of(tx, 9999)):
        with pytest.raises(serve.NotFound):
            miss()


def test_training(spark, curated, tmp_path):
    parts = [tables.read_table(spark, f"{curated}.{t}") for t in ("transactions", "mcc", "cards", "users")]
    merged = train.training_rows(*parts)
    assert merged.count() == 380 and "mcc_description" in merged.columns
    small = merged.drop("address", "card_number", "date")
    result = train.train(small, trees=10, max_depth=6)
    assert result.predictions.count() == 76  # a fifth
    assert result.evaluation.accuracy.first()[0] > 0.95  # amounts tell the classes apart
    confusion = {(r["actual"], r["predicted"]): r["n"] for r in result.evaluation.confusion.collect()}
    assert sum(confusion.values()) == 76
    again = train.train(small, trees=10, max_depth=6)
    both = result.predictions.select("transaction_id", "prediction").exceptAll(
        again.predictions.select("transaction_id", "prediction")
    )
    assert both.count() == 0
    model.save_model(result.model, f"{tmp_path}/m")
    reloaded = model.predict(model.load_model(f"{tmp_path}/m"), result.predictions.select("transaction_id", "label", "features"))
    assert reloaded.select("transaction_id", "prediction").exceptAll(
        result.predictions.select("transaction_id", "prediction")
    ).count() == 0
    n = {(r["part"], r["label"]): r["n"] for r in result.classes.collect()}
    assert n["train", 0.0] + n["train", 1.0] == 304 and n["test", 1.0] == round(47 * 0.2)
    assert n["balanced", 0.0] == n["balanced", 1.0] == n["train", 0.0] > n["train", 1.0]
    kept = train.train(small, fit_on_all=True, trees=3, max_depth=3, features_path=f"{tmp_path}/features")
    stored = spark.read.parquet(f"{tmp_path}/features")
    assert stored.schema["features"].dataType.typeName() in ("vector", "vectorudt") and stored.count() == 380
    assert kept.predictions.count() == 76


def test_load_without_rows_empties_its_date(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "id long, name string")
    for date in ("2025-01-01", "2025-01-02"):
        snapshots.write_snapshot(rows, f"{tmp_path}/raw", "parquet", date)
    snapshots.write_snapshot(rows.limit(0), f"{tmp_path}/raw", "parquet", "2025-01-02", mode="append")
    assert snapshots.latest_date(spark, f"{tmp_path}/raw") == "2025-01-02"
    snapshots.write_snapshot(rows.limit(0), f"{tmp_path}/raw", "parquet", "2025-01-02")
    assert snapshots.latest_date(spark, f"{tmp_path}/raw") == "2025-01-01"
    assert snapshots.read_snapshot(spark, f"{tmp_path}/raw", "parquet").count() == 2


def test_label_object_loses_nothing(spark, tmp_path):
    texts = {1: "Yes", 2: None, 3: "No, really", 4: 'a"b', 5: ",", 6: "x,", 7: "", 8: "tab\t\\ é", 9: "{}: , \"1\": \"2\""}
    (tmp_path / "l.json").write_text(json.dumps({"target": {str(k): v for k, v in texts.items()}}))
    got = files.read_label_object(spark, str(tmp_path / "l.json")).collect()
    assert dict(map(tuple, got)) == texts and len(got) == len(texts)


def test_label_object_over_many_blocks(spark, tmp_path):
    texts = {i: ("No, " * (i % 7) + "x" if i % 3 else None) for i in range(3000)}
    (tmp_path / "l.json").write_text(json.dumps({str(k): v for k, v in texts.items()}))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        got = files.read_label_object(spark, str(tmp_path / "l.json")).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert dict(map(tuple, got)) == texts and len(got) == len(texts)


@pytest.mark.parametrize("text", ['{"1": "Yes", "two": "No"}', '{"1": "Yes", "2": [1, 2]}', '{"1": "Yes", "2" "No"}', '{"1": Yes}'])
def test_label_object_with_other_things_fails(spark, tmp_path, text):
    (tmp_path / "l.json").write_text(text)
    with pytest.raises(Exception, match="not a label entry"):
        files.read_label_object(spark, str(tmp_path / "l.json")).collect()


def test_malformed_labels_are_put_aside(spark, tmp_path):
    (tmp_path / "l.json").write_text('{"id": 1, "target": "Yes"}\nnot json\n')
    ingest.ingest_labels(spark, str(tmp_path / "l.json"), f"{tmp_path}/raw", "json", "2025-01-01")
    aside = snapshots.read_snapshot(spark, f"{tmp_path}/raw_malformed", "parquet").collect()
    assert [r["_corrupt_record"] for r in aside] == ["not json"]


def test_card_numbers_keep_their_zeros(spark, tmp_path):
    (tmp_path / "c.csv").write_text("id,client_id,card_number,cvv,credit_limit\n1,2,0000111122223333,007,$10.50\n")
    ingest.ingest_csv(spark, str(tmp_path / "c.csv"), f"{tmp_path}/raw", date="2025-01-01", infer=False)
    row = snapshots.read_snapshot(spark, f"{tmp_path}/raw", "csv", infer=False).first()
    assert row["card_number"] == "0000111122223333" and row["cvv"] == "007"


def test_days_count_when_they_are_published(spark, tmp_path):
    """A load that runs or has died isn't seen; a root without manifests beside it is read as it is."""
    root = f"{tmp_path}/raw"
    assert snapshots.write_snapshot(spark.range(5), root, "parquet", "2025-01-01") == {"2025-01-01": 5}
    assert snapshots.write_snapshot(spark.range(7), root, "parquet", "2025-01-02") == {"2025-01-02": 7}
    spark.range(9).write.parquet(f"{root}/situation_date=2025-01-03")  # rows, but no manifest
    assert snapshots.latest_date(spark, root) == "2025-01-02" and snapshots.snapshot_dates(spark, root)[-1] == "2025-01-03"
    manifests.withdraw(spark, root, ["2025-01-02"])  # a load of this day begins again
    assert snapshots.read_snapshot(spark, root, "parquet").count() == 5
    snapshots.write_snapshot(spark.range(8), root, "parquet", "2025-01-02")
    assert {r["date"]: (r["rows"], r["files"] > 0, r["bytes"] > 0) for r in manifests.manifests(spark, root).collect()} == {
        "2025-01-01": (5, True, True), "2025-01-02": (8, True, True)
    }
    spark.range(2).write.parquet(f"{tmp_path}/foreign/situation_date=2025-01-09")
    assert manifests.published_dates(spark, f"{tmp_path}/foreign") is None and snapshots.latest_date(spark, f"{tmp_path}/foreign") == "2025-01-09"


def test_a_load_that_fails_leaves_its_day_unpublished(spark, tmp_path):
    root = f"{tmp_path}/raw"
    for day in ("2025-01-01", "2025-01-02"):
        snapshots.write_snapshot(spark.range(5), root, "parquet", day)
    broken = spark.range(5).select(F.when(F.col("id") < 4, F.col("id")).otherwise(F.raise_error(F.lit("lost")).cast("bigint")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        snapshots.write_snapshot(broken, root, "parquet", "2025-01-02")
    assert snapshots.latest_date(spark, root) == "2025-01-01"


def test_counts_of_dated_rows_and_appends(spark, tmp_path):
    root = f"{tmp_path}/raw"
    rows = spark.range(30).select("id", F.date_add(F.lit("2025-01-01").cast("date"), (F.col("id") % 3).cast("int")).alias("situation_date"))
    assert snapshots.write_snapshot(rows, root, "parquet") == {f"2025-01-0{i}": 10 for i in (1, 2, 3)}
    assert snapshots.write_snapshot(rows.where("id % 3 = 1"), root, "parquet", mode="append") == {"2025-01-02": 20}
    assert {r["date"]: r["rows"] for r in manifests.manifests(spark, root).collect()} == {"2025-01-01": 10, "2025-01-02": 20, "2025-01-03": 10}
    assert snapshots.read_snapshot(spark, root, "parquet", date="2025-01-02").count() == 20
    assert snapshots.write_snapshot(spark.range(4), root, "parquet", "2025-02-01", mode="static") == {"2025-02-01": 4}
    assert manifests.published_dates(spark, root) == ["2025-02-01"]
    foreign = f"{tmp_path}/foreign"
    spark.range(6).write.parquet(f"{foreign}/situation_date=2025-01-01")
    assert snapshots.write_snapshot(spark.range(2), foreign, "parquet", "2025-01-01", mode="append") == {"2025-01-01": 8}
    with pytest.raises(FileExistsError):
        manifests.publish(spark, root, f"{root}/situation_date=2025-02-01", "2025-02-01", 4)


def test_tables_keep_the_rows_of_their_load(spark):
    assert tables.replace_table(spark.range(12), "counted_rows") == 12
    assert tables.loaded_rows(spark, "counted_rows") == 12
    assert tables.replace_table(spark.range(3), "counted_rows") == 3 and tables.loaded_rows(spark, "counted_rows") == 3
    spark.sql("DROP TABLE counted_rows")
