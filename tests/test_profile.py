import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import functions as F
from pyspark.sql import types as T

from swipelake.operators import columns, evaluate, features, profile, vectors


def test_sparse_rows(spark):
    rows = [(1, "a", 1.0, "x", None), (2, None, None, "x", "y"), (3, None, float("nan"), None, "y")]
    df = spark.createDataFrame(rows, "id int, a string, b double, c string, d string")
    assert [r["id"] for r in profile.drop_sparse_rows(df).collect()] == [1]  # int(0.8 * 5) = 4
    assert sorted(r["id"] for r in profile.drop_sparse_rows(df, 0.6).collect()) == [1, 2]


def test_roles(spark):
    df = spark.sql(
        "SELECT 1 AS transaction_id, 'a' AS is_fraud, 2.5D AS amount, 'x' AS gender, DATE'2020-01-01' AS date, 1L AS n, true AS b"
    )
    assert profile.feature_roles(df) == (["amount", "n"], ["gender", "date"])


def test_gaps(spark):
    rows = [(1.0, None, None), (None, 4, "x"), (float("nan"), 8, "y"), (3.0, 8, None)]
    df = spark.createDataFrame(rows, "a double, b int, mcc_description string")
    assert profile.null_presence(df).first().asDict() == {"a": True, "b": True, "mcc_description": True}
    assert profile.null_presence(df.where("b = 8").where("a = 3"), ["a", "b"]).first().asDict() == {"a": False, "b": False}
    filled = profile.fill_missing_text(profile.impute_means(df, ["a", "b"])).collect()
    assert [r["a"] for r in filled] == [1.0, 2.0, 2.0, 3.0]
    assert [round(r["b"], 4) for r in filled] == [6.6667, 4.0, 8.0, 8.0]
    assert [r["mcc_description"] for r in filled] == ["unknown", "x", "y", "unknown"]


def test_constant_columns(spark):
    df = spark.createDataFrame([(1.0, 5, 2.0), (2.0, 5, 2.0)], "a double, b int, c double")
    assert profile.constant_columns(df, ["a", "b", "c"]) == ["b", "c"]
    assert profile.drop_constant_columns(df, ["a", "b", "c"]).columns == ["a"]


def test_scaling(spark):
    x = [1.0, 2.0, 4.0, 9.0]
    df = spark.createDataFrame([(v,) for v in x], "x double")
    for population, ddof in ((True, 0), (False, 1)):
        got = [r["x"] for r in features.scaled(df, ["x"], population=population).collect()]
        assert np.allclose(got, (np.array(x) - np.mean(x)) / np.std(x, ddof=ddof))


def test_feature_vectors(spark):
    train = spark.createDataFrame([(1, 1.0, "b", None), (2, 3.0, "a", "z")], "i int, x double, c string, d string")
    later = spark.createDataFrame([(3, None, "unseen", "z"), (4, float("nan"), "b", None)], "i int, x double, c string, d string")
    train, later = (features.with_text_categories(t, ["c", "d"]) for t in (train, later))
    fitted = features.feature_pipeline(train, ["x"], ["c", "d"])
    vectors = [r[0] for t in (train, later) for r in fitted.transform(t).orderBy("i").select(vector_to_array("features")).collect()]
    assert vectors == [[-1, 0, 1, 1, 0], [1, 1, 0, 0, 1], [0, 0, 0, 0, 1], [0, 0, 1, 1, 0]]


def test_categories_are_ranked_in_ranges(spark):
    """As many categories as rows, over many ranges, nulls left out; the sparse struct is what ML vectors hold."""
    names = [f"c{i * 7919 % 1000:03d}" for i in range(1000)]
    df = spark.createDataFrame([(n, None if i % 3 else f"x{i % 5}") for i, n in enumerate(names)], "a string, b string")
    got = {(r["column"], r["category"]): r["position"] for r in features.category_positions(df, ["a", "b"]).collect()}
    want = sorted({(0, n) for n in names} | {(1, f"x{i % 5}") for i in range(0, 1000, 3)})
    assert got == {pair: i for i, pair in enumerate(want)}


def test_large_dictionary_is_joined_by_shuffle(spark, monkeypatch):
    rows = spark.createDataFrame([(float(i % 9), f"c{i % 40}", "hot" if i % 3 else f"d{i}") for i in range(600)], "x double, c string, d string")
    fitted = features.feature_pipeline(rows, ["x"], ["c", "d"])
    want = sorted(map(str, fitted.transform(rows).select("c", "d", "features").collect()))
    monkeypatch.setattr(features, "BROADCAST_ROWS", 0)
    assert sorted(map(str, fitted.transform(rows).select("c", "d", "features").collect())) == want


def test_feature_model_is_stored(spark, tmp_path):
    rows = spark.createDataFrame([(1.0, "b"), (3.0, "a")], "x double, c string")
    fitted = features.feature_pipeline(rows, ["x"], ["c"])
    fitted.save(str(tmp_path / "m"))
    stored = features.FeatureModel.load(spark, str(tmp_path / "m"))
    later = spark.createDataFrame([(2.0, "a"), (None, "zzz")], "x double, c string")
    assert sorted(r[0] for r in stored.transform(later).select(vector_to_array("features")).collect()) == [[0, 0, 0], [0, 1, 0]]


def test_vector_entries(spark):
    held = [Vectors.dense([0.0, 2.0, float("nan")]), Vectors.sparse(4, [1, 3], [0.0, 5.0]), Vectors.dense([]), None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(held)], T.StructType([T.StructField("i", T.IntegerType()), T.StructField("v", VectorUDT())]))
    got = [r[0] for r in df.orderBy("i").select(vectors.entries(F.col("v"))).collect()]
    assert str(got[0]) == "Row(size=3, indices=[1, 2], values=[2.0, nan])" and tuple(got[1]) == (4, [3], [5.0])
    assert tuple(got[2]) == (0, [], []) and got[3] is None


def test_report_by_hand(spark):
    pairs = [(0, 0)] * 5 + [(0, 1)] * 2 + [(1, 1)] * 3 + [(1, 2)] + [(3, 0)]
    df = spark.createDataFrame(pairs, "y int, p int")
    confusion = evaluate.confusion_counts(df, "y", "p")
    report = {r["class"]: r for r in evaluate.classification_report(confusion).collect()}
    assert (report["0"]["precision"], report["0"]["recall"], report["0"]["support"]) == (0.8333, 0.7143, 7)
    assert (report["1"]["precision"], report["1"]["recall"], report["1"]["f1"]) == (0.6, 0.75, 0.6667)
    assert (report["2"]["precision"], report["2"]["recall"], report["2"]["f1"], report["2"]["support"]) == (0, 0, 0, 0)
    assert (report["3"]["precision"], report["3"]["recall"]) == (0, 0)
    assert report["accuracy"]["f1"] == round(8 / 12, 4) and report["accuracy"]["support"] == 12
    assert report["weighted avg"]["recall"] == report["accuracy"]["f1"]
    assert round(evaluate.accuracy(df, "y", "p").first()[0], 4) == 0.6667
    matrix = evaluate.confusion_matrix(confusion, [0, 1, 2]).collect()
    assert [tuple(r) for r in matrix] == [(0, 5, 2, 0), (1, 0, 3, 1), (3, 1, 0, 0)]


def test_column_shaping(spark):
    df = spark.createDataFrame([(1, " 7 ", None)], [" id ", "k ", "n"], ) if False else spark.sql(
        "SELECT 1 AS ` id `, ' 7 ' AS `k `, CAST(NULL AS int) AS n"
    )
    df = columns.trim_column_names(df)
    assert df.columns == ["id", "k", "n"]
    assert columns.keys_as_text(df, "id", "k", "n").first().asDict() == {"id": "1", "k": "7", "n": None}
    dated = columns.with_year_month(columns.stamp_date(df, "2025-05-22"))
    assert (dated.first()["year"], dated.first()["month"]) == (2025, 5)
    today = columns.stamp_date(df).select(F.col("situation_date") == F.current_date()).first()[0]
    assert today
    assert df.select(columns.nested(df, ["id", "k"], "client")).first()["client"]["k"] == " 7 "
