"""Feature preparation: scaled numbers and one-hot categories in one sparse vector.

The dictionary of categories is a stored table (column, category, position): it is ranked in key ranges and joined, so neither the
driver nor a task ever holds it, whatever the number of categories.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from swipelake.operators.joins import BROADCAST_ROWS
from swipelake.operators.positions import with_positions
from swipelake.operators.profile import column_stats
from swipelake.operators.vectors import sparse_struct, stored_vectors
from swipelake.session import cut_lineage

NULL_CATEGORY = "(null)"

# Text of one column's categories that is broadcast; a larger dictionary is joined by a shuffle.
BROADCAST_BYTES = 32 << 20


def scaled(df: DataFrame, columns: list[str], suffix: str = "", population: bool = True) -> DataFrame:
    """Subtract the mean, divide by the deviation: plain arithmetic in generated code, with the
    statistics of all columns from one pass. A column without spread is only centred."""
    stats = column_stats(df, columns)
    out = {}
    for c, s in stats.items():
        spread = s["pop" if population else "samp"]
        out[f"{c}{suffix}"] = (F.col(c).cast("double") - F.lit(s["mean"])) / F.lit(spread if spread else 1.0)
    return df.withColumns(out)


def with_text_categories(df: DataFrame, categorical: list[str]) -> DataFrame:
    """Categories as text; a missing one is a category of its own."""
    return df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit(NULL_CATEGORY)) for c in categorical})


def category_positions(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, category, position), stored: the distinct texts of the columns, numbered from 0 in the order of columns and texts.

    The columns become rows before they are made distinct in one shuffle; map tasks have taken most repeats out by then.
    """
    pairs = F.explode(F.array(*(F.struct(F.lit(i).alias("column"), F.col(c).cast("string").alias("category")) for i, c in enumerate(columns))))
    found = df.select(pairs.alias("p")).select("p.column", "p.category").where("category is not null").distinct()
    return cut_lineage(with_positions(found, ["column", "category"]))


@dataclass
class FeatureModel:
    """Numbers scaled, then a position per category of each column.

    A category not seen when fitted is all zeros; a number that is missing becomes zero.
    """

    numeric: list[str]
    means: list[float]
    spreads: list[float]
    categorical: list[str]
    sizes: list[int]  # categories per column
    bytes: list[int]  # of their texts
    dictionary: DataFrame | None
    output: str = "features"

    @property
    def width(self) -> int:
        return len(self.numeric) + sum(self.sizes)

    def numbers(self) -> Column:
        out = []
        for c, mean, spread in zip(self.numeric, self.means, self.spreads):
            number = F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
            out.append(F.coalesce((number - F.lit(mean)) / F.lit(spread), F.lit(0.0)))
        return F.array(*out).cast("array<double>")

    def with_codes(self, df: DataFrame) -> tuple[DataFrame, list[str]]:
        """Adds the position of each column's category, null if it is unknown. A large dictionary is joined by a
        shuffle, which adaptive execution splits where many rows have one category."""
        codes = []
        for i, (c, size) in enumerate(zip(self.categorical, self.sizes)):
            entry = self.dictionary.where(F.col("column") == i).select(F.col("category").alias(f"_category_{i}"), F.col("position").alias(f"_code_{i}"))
            entry = F.broadcast(entry) if size <= BROADCAST_ROWS and self.bytes[i] <= BROADCAST_BYTES else entry
            df = df.join(entry, F.col(c).cast("string") == F.col(f"_category_{i}"), "left").drop(f"_category_{i}")
            codes.append(f"_code_{i}")
        return df, codes

    def encode(self, df: DataFrame) -> DataFrame:
        """``df`` with the output as a struct (see ``vectors``), made of built-in functions."""
        coded, codes = self.with_codes(df)
        ones = F.filter(F.array(*codes).cast("array<bigint>"), lambda c: c.isNotNull())
        places = F.concat(
            F.sequence(F.lit(0), F.lit(len(self.numeric) - 1)) if self.numeric else F.array().cast("array<int>"),
            F.transform(ones, lambda c: (c + len(self.numeric)).cast("int")),
        )
        values = F.concat(self.numbers(), F.transform(ones, lambda c: F.lit(1.0)))
        return coded.withColumn(self.output, sparse_struct(F.lit(self.width), places, values)).drop(*codes)

    def transform(self, df: DataFrame, path: str | None = None) -> DataFrame:
        """``df`` with the output as an ML vector, stored at ``path`` or in the checkpoint folder."""
        return stored_vectors(self.encode(df), [self.output], path)

    def save(self, path: str) -> None:
        """Numbers as one JSON line, the dictionary as Parquet."""
        spark = SparkSession.getActiveSession()
        plain = {k: v for k, v in self.__dict__.items() if k != "dictionary"}
        spark.createDataFrame([(json.dumps(plain),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/model")
        if self.dictionary is not None:
            self.dictionary.write.mode("overwrite").parquet(f"{path}/dictionary")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> FeatureModel:
        plain = json.loads(spark.read.text(f"{path}/model").first()[0])
        return cls(**plain, dictionary=spark.read.parquet(f"{path}/dictionary") if plain["categorical"] else None)


def feature_pipeline(
    df: DataFrame, numeric: list[str], categorical: list[str], output: str = "features", population: bool = True
) -> FeatureModel:
    """Fit on ``df``: numbers scaled, categories one-hot, both in one sparse vector."""
    stats = column_stats(df, numeric)
    kind = "pop" if population else "samp"
    dictionary, sizes, lengths = None, [0] * len(categorical), [0] * len(categorical)
    if categorical:
        dictionary = category_positions(df, categorical)
        for row in dictionary.groupBy("column").agg(F.count("*").alias("n"), F.sum(F.octet_length("category")).alias("length")).collect():  # a row per column
            sizes[row["column"]], lengths[row["column"]] = row["n"], row["length"]
        if len(numeric) + sum(sizes) > 2**31 - 1:
            raise ValueError(f"{sum(sizes)} categories are more than a vector has positions")
    means = [stats[c]["mean"] or 0.0 for c in numeric]
    return FeatureModel(numeric, means, [stats[c][kind] or 1.0 for c in numeric], categorical, sizes, lengths, dictionary, output)


def one_hot(df: DataFrame, column: str, output: str) -> DataFrame:
    """One position per category of a column, in alphabetical order; nulls are all zeros."""
    return feature_pipeline(df, [], [column], output).transform(df)
