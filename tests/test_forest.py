import os

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from swipelake.operators import forest, model


def made(spark, n=900):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(n, 6))
    y = (x[:, 0] > 0.3).astype(int) + (x[:, 1] > 1)
    x[rng.random((n, 6)) < 0.1] = 0
    return spark.createDataFrame([(i, float(c), Vectors.dense(v)) for i, (c, v) in enumerate(zip(y, x))], ["id", "label", "features"])


def nodes(grown):
    return sorted(map(str, grown.nodes.select("tree", "node", "place", "cut", "counts").collect()))


def test_trees_are_the_same_from_histograms_and_any_partitions(spark, monkeypatch):
    df = made(spark)
    train, test = df.where("id % 4 <> 0"), df.where("id % 4 = 0")
    whole = model.train_forest(train, trees=6, max_depth=12)
    assert whole.transform(test).where("prediction = label").count() > 0.75 * test.count()
    monkeypatch.setattr(forest, "LOCAL_ENTRIES", 1500)
    assert nodes(model.train_forest(train.repartition(5), trees=6, max_depth=12)) == nodes(whole)


def test_large_leaves_are_not_split_again(spark, monkeypatch):
    rows = [(float(i % 2), Vectors.dense([float(i % 2 and i % 3 > 0), 1.0 * (i % 50)])) for i in range(400)]
    df = spark.createDataFrame(rows, ["label", "features"])
    whole = model.train_forest(df, trees=3, max_depth=2)
    monkeypatch.setattr(forest, "LOCAL_ENTRIES", 20)
    split = model.train_forest(df, trees=3, max_depth=2)
    assert nodes(split) == nodes(whole) and split.nodes.count() == split.nodes.select("tree", "node").distinct().count()


def test_fifty_million_features(spark):
    """What a forest holds grows with the entries: a number per feature and row would be 120 GB."""
    rng = np.random.default_rng(2)
    width = 50_000_000
    rows = [(float(i % 2), Vectors.sparse(width, sorted((int(p), 1.0) for p in rng.choice(width, 5, replace=False)))) for i in range(300)]
    found = model.train_forest(spark.createDataFrame(rows, ["label", "features"]), trees=4)
    got = model.predict(found, spark.createDataFrame(rows[:40], ["label", "features"]))
    p = vector_to_array("probability")
    assert got.where(F.col("prediction").isin(0.0, 1.0) & (F.abs(p[0] + p[1] - 1) < 1e-9)).count() == 40


def test_rows_are_not_copied_per_tree(spark, monkeypatch):
    """While trees grow from counts of wide rows, what lies on disk doesn't grow with trees times entries."""
    rng = np.random.default_rng(3)
    rows = [(float(i % 2), Vectors.sparse(100_000, sorted((int(p), 1.0) for p in rng.choice(100_000, 40, replace=False)))) for i in range(1200)]
    df = spark.createDataFrame(rows, ["label", "features"]).repartition(4)
    whole = model.train_forest(df, trees=40, max_depth=6)
    folder, most = spark.sparkContext.getCheckpointDir().removeprefix("file:"), [0]

    def used():
        return sum(os.path.getsize(os.path.join(at, f)) for at, _, names in os.walk(folder) for f in names)

    before, upper = used(), forest._upper_parts
    monkeypatch.setattr(forest, "_upper_parts", lambda *a: (most.append(used() - before), upper(*a))[1])
    monkeypatch.setattr(forest, "LOCAL_ENTRIES", 16_000)
    got = model.train_forest(df, trees=40, max_depth=6)
    assert nodes(got) == nodes(whole)
    assert 0 < max(most) and used() - before < 1_500_000  # a row per tree and entry of 8 bytes would be 9.7 MB


def test_wide_trees_are_the_same_whatever_is_sent(spark, monkeypatch):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(600):
        places = {0: float(rng.normal()), 1: float(rng.integers(3)), **{int(p): 1.0 for p in 2 + rng.integers(0, 40, 3)}, **{int(p): 1.0 for p in 100 + rng.integers(0, 7000, 3)}}
        rows.append((float(places[0] > 0.4 or 7 in places), Vectors.sparse(8000, sorted((p, v) for p, v in places.items() if v))))
    df = spark.createDataFrame(rows, ["label", "features"])
    whole = nodes(model.train_forest(df, trees=5, max_depth=10))
    monkeypatch.setattr(forest, "LOCAL_ENTRIES", 8000)
    monkeypatch.setattr(forest, "CHUNK_ROWS", 100)
    assert nodes(model.train_forest(df.repartition(3), trees=5, max_depth=10)) == whole
    monkeypatch.setattr(forest, "SENT", 0)  # one tree at a time
    monkeypatch.setattr(forest, "CUT_VALUES", 0)  # bins by a join
    assert nodes(model.train_forest(df.repartition(3), trees=5, max_depth=10)) == whole


def test_large_forests_meet_rows_in_groups(spark, monkeypatch):
    df = made(spark, 200)
    found = model.train_forest(df, trees=12, max_depth=5)

    def chances():
        return sorted((r.id, r.prediction, *r.probability) for r in found.transform(df).collect())

    known = chances()
    monkeypatch.setattr(forest, "WALK_NODES", 0)
    assert chances() == known
