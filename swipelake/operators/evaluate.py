"""Class counts and the evaluation of predictions.

Everything is derived from the confusion counts, one small row per (actual, predicted) pair.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def class_counts(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count("*").alias("n"))


def confusion_counts(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    return df.groupBy(F.col(actual).alias("actual"), F.col(predicted).alias("predicted")).agg(F.count("*").alias("n"))


def confusion_matrix(confusion: DataFrame, classes: list) -> DataFrame:
    """One row per actual class, one column per predicted class."""
    return confusion.groupBy("actual").pivot("predicted", classes).agg(F.sum("n")).na.fill(0).orderBy("actual")


def _f1(hits, predicted, support):
    return F.when(predicted + support > 0, 2.0 * hits / (predicted + support)).otherwise(0.0)


def per_class_report(confusion: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support of every class seen as actual or predicted."""
    hit = F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0)
    sides = confusion.select(
        F.explode(
            F.array(
                F.struct(F.col("actual").alias("class"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("predicted"), hit.alias("hits")),
                F.struct(F.col("predicted").alias("class"), F.lit(0).cast("bigint").alias("support"), F.col("n").alias("predicted"), F.lit(0).cast("bigint").alias("hits")),
            )
        ).alias("s")
    ).select("s.*")
    sums = sides.groupBy("class").agg(
        F.sum("hits").alias("hits"), F.sum("predicted").alias("predicted"), F.sum("support").alias("support")
    )
    hits, predicted, support = F.col("hits"), F.col("predicted"), F.col("support")
    return sums.select(
        "class",
        F.when(predicted > 0, hits / predicted).otherwise(0.0).alias("precision"),
        F.when(support > 0, hits / support).otherwise(0.0).alias("recall"),
        _f1(hits, predicted, support).alias("f1"),
        "support",
    )


def classification_report(confusion: DataFrame, digits: int = 4) -> DataFrame:
    """The report per class, then accuracy, plain mean and support-weighted mean."""
    classes = per_class_report(confusion)
    means = classes.agg(
        F.avg("precision").alias("mp"),
        F.avg("recall").alias("mr"),
        F.avg("f1").alias("mf"),
        (F.sum(F.col("precision") * F.col("support")) / F.sum("support")).alias("wp"),
        (F.sum(F.col("recall") * F.col("support")) / F.sum("support")).alias("wr"),
        (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("wf"),
        F.sum("support").alias("support"),
    )
    nothing = F.lit(None).cast("double")

    def line(name: str, p, r, f):
        return F.struct(
            F.lit(name).alias("class"), p.alias("precision"), r.alias("recall"), f.alias("f1"), F.col("support")
        )

    # weighted recall is the share of right predictions
    summary = means.select(
        F.explode(
            F.array(
                line("accuracy", nothing, nothing, F.col("wr")),
                line("macro avg", F.col("mp"), F.col("mr"), F.col("mf")),
                line("weighted avg", F.col("wp"), F.col("wr"), F.col("wf")),
            )
        ).alias("s")
    ).select("s.*")
    report = classes.withColumn("class", F.col("class").cast("string")).unionByName(summary)
    return report.select("class", *[F.round(c, digits).alias(c) for c in ("precision", "recall", "f1")], "support")


def accuracy(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    return df.agg(F.avg((F.col(actual) == F.col(predicted)).cast("int")).alias("accuracy"))
