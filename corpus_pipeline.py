"""From raw documents to packed training sequences, in five stages.

Each stage works on what the one before kept, and its decisions take effect: toxic documents go,
repeated passages go, one document of each group of near duplicates stays, secrets are replaced, and
what is left is packed. All stages but the last return the columns of the documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from swipelake.llm import line_chunks, packing, secrets, simhash, toxicity
from swipelake.llm.common import positional, store, table
from swipelake.llm.queries import tokenizer


def with_length(docs: DataFrame) -> DataFrame:
    """n_chars, where the table has it, follows the text."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    renamed, names = positional(docs)  # the score's own columns may have these names
    scored = toxicity.score(renamed, model, names["doc_id"], names["text"], tuple(n for c, n in names.items() if c != "doc_id"))
    return scored.where("predicted = 0").select(*(F.col(n).alias(c) for c, n in names.items()))


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return with_length(line_chunks.dedup(docs, counts=False, runs=True))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return with_length(secrets.redact(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokenizer("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", not_toxic),
    ("line dedup", without_repeats),
    ("near dedup", without_copies),
    ("secrets", without_secrets),
    ("packing", packed),
]

ORACLE_SQL = None  # classifier, fingerprints and tokenizer have no SQL; tests hold the stages against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = store(docs)
    return docs
