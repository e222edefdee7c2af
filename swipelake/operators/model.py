"""Random forest: train, predict, evaluate, store."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from swipelake.operators import forest
from swipelake.operators.evaluate import accuracy, classification_report, confusion_counts
from swipelake.session import ensure_checkpoint_dir

# Seed and number of trees; depth is unlimited in intent.
SEED = 42
TREES = 100
MAX_DEPTH = 30


def train_forest(
    train: DataFrame,
    features: str = "features",
    label: str = "label",
    trees: int = TREES,
    max_depth: int = MAX_DEPTH,
    seed: int = SEED,
) -> forest.Forest:
    """The square root of the number of features is tried at each split (see ``forest``).

    What is returned is the stored model, so its trees are not grown again for a reader.
    """
    path = f"{ensure_checkpoint_dir(train.sparkSession)}/forest-{uuid.uuid4().hex}"
    save_model(forest.grown(train, features, label, trees, max_depth, seed), path)
    return load_model(path)


@dataclass
class Evaluation:
    confusion: DataFrame
    report: DataFrame
    accuracy: DataFrame


def predict(model: forest.Forest, df: DataFrame) -> DataFrame:
    return model.transform(df)


def evaluate(predictions: DataFrame, label: str = "label", prediction: str = "prediction") -> Evaluation:
    confusion = confusion_counts(predictions, label, prediction)
    return Evaluation(confusion, classification_report(confusion), accuracy(predictions, label, prediction))


def save_model(model: forest.Forest, path: str) -> None:
    model.save(path)


def load_model(path: str) -> forest.Forest:
    return forest.Forest.load(SparkSession.active(), path)
