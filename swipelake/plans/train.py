"""Managed tables to a stored fraud model: enrich, prepare, split, balance, train, evaluate."""

from __future__ import annotations

import argparse
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from swipelake.operators import features, model, profile
from swipelake.operators.balance import balance_classes
from swipelake.operators.columns import trim_column_names
from swipelake.operators.forest import Forest
from swipelake.operators.joins import enrich_transactions
from swipelake.operators.sampling import stratified_split
from swipelake.operators.vectors import stored_vectors
from swipelake.session import get_session, release_shuffles, stored
from swipelake.sources.tables import read_table


@dataclass
class TrainingResult:
    features: features.FeatureModel
    model: Forest
    predictions: DataFrame
    evaluation: model.Evaluation
    classes: DataFrame  # (part, label, n) for train, test and balanced


def training_rows(tx: DataFrame, mcc: DataFrame, cards: DataFrame, users: DataFrame) -> DataFrame:
    """Enriched, labelled rows. The label of a curated transaction is its own column."""
    tx, mcc, cards, users = (trim_column_names(t) for t in (tx, mcc, cards, users))
    merged = enrich_transactions(tx.withColumnRenamed("has_fraud", profile.TARGET), None, mcc, cards, users)
    return merged.where(F.col(profile.TARGET).isNotNull())


def usable(merged: DataFrame) -> DataFrame:
    """Rows filled well enough, their missing texts filled."""
    return profile.fill_missing_text(profile.drop_sparse_rows(merged))


def prepare(rows: DataFrame, fitted_on: DataFrame, apart: tuple[str, ...] = ()) -> tuple[DataFrame, list[str], list[str]]:
    """Gaps closed, and the feature columns (numeric, categorical); means and spreads are those of ``fitted_on``."""
    numeric, categorical = profile.feature_roles(rows.drop(*apart))
    stats = profile.column_stats(fitted_on, numeric)
    filled = profile.impute_means(rows, numeric, stats)
    constant = set(profile.constant_columns(fitted_on, numeric, stats))
    return features.with_text_categories(filled, categorical), [c for c in numeric if c not in constant], categorical


def balanced_features(
    merged: DataFrame, fit_on_all: bool = False, positive: str = "Yes", key: str = "transaction_id", features_path: str | None = None
) -> tuple[features.FeatureModel, DataFrame, DataFrame]:
    """The fitted features, the encoded rows (key, label, is_test, features) and the training part with equally large classes.

    Features are fitted on the training part only, unless ``fit_on_all``. The encoded rows are read several times: they are stored
    at ``features_path``, else in the checkpoint folder.
    """
    label = F.when(F.col(profile.TARGET) == positive, 1.0).otherwise(0.0)
    release_shuffles(merged.sparkSession)  # of the joins that made the merged rows
    with stored(stratified_split(usable(merged).withColumn("label", label), "label", key)) as split:
        rows, numeric, categorical = prepare(split, split if fit_on_all else split.where(~F.col("is_test")), ("label", "is_test"))
        fitted = features.feature_pipeline(rows if fit_on_all else rows.where(~F.col("is_test")), numeric, categorical)
        encoded = stored_vectors(fitted.encode(rows).select(key, "label", "is_test", "features"), ["features"], features_path)
    del split, rows
    release_shuffles(merged.sparkSession)
    return fitted, encoded, balance_classes(encoded.where(~F.col("is_test")), "label", key, "features")


def train(
    merged: DataFrame,
    fit_on_all: bool = False,
    trees: int = model.TREES,
    max_depth: int = model.MAX_DEPTH,
    positive: str = "Yes",
    key: str = "transaction_id",
    features_path: str | None = None,
) -> TrainingResult:
    """Prepare (see ``balanced_features``), train, predict the test part, evaluate."""
    fitted, encoded, balanced = balanced_features(merged, fit_on_all, positive, key, features_path)
    forest = model.train_forest(balanced, trees=trees, max_depth=max_depth)
    predictions = model.predict(forest, encoded.where("is_test").select(key, "label", "features"))
    part = F.when(F.col("is_test"), "test").otherwise("train").alias("part")
    classes = (
        encoded.select(part, "label")
        .unionByName(balanced.select(F.lit("balanced").alias("part"), "label"))
        .groupBy("part", "label")
        .agg(F.count("*").alias("n"))
    )
    return TrainingResult(fitted, forest, predictions, model.evaluate(predictions), classes)


def main() -> None:
    args = argparse.ArgumentParser(description="train and store the fraud model")
    args.add_argument("--database", default="default")
    args.add_argument("--output", required=True)
    args.add_argument("--trees", type=int, default=model.TREES)
    args.add_argument("--max-depth", type=int, default=model.MAX_DEPTH)
    args.add_argument("--fit-on-all", action="store_true")
    args.add_argument("--drop", nargs="*", default=[], help="columns that are no features, such as street addresses")
    a = args.parse_args()
    spark: SparkSession = get_session("train", hive=True)
    tables = [read_table(spark, f"{a.database}.{t}") for t in ("transactions", "mcc", "cards", "users")]
    merged = training_rows(*tables).drop(*a.drop)
    merged.write.mode("overwrite").parquet(f"{a.output}/merged")
    stored = spark.read.parquet(f"{a.output}/merged")
    result = train(stored, a.fit_on_all, a.trees, a.max_depth, features_path=f"{a.output}/features")
    result.classes.orderBy("part", "label").show()
    result.evaluation.confusion.show()
    result.evaluation.report.show(truncate=False)
    result.evaluation.accuracy.show()
    result.features.save(f"{a.output}/feature_model")
    model.save_model(result.model, f"{a.output}/model")
    spark.stop()


if __name__ == "__main__":
    main()
