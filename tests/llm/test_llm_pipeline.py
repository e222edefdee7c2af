import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
from texts import documents, prose  # noqa: E402

from swipelake.llm import secrets, simhash, toxicity  # noqa: E402
from swipelake.llm.common import drop, small, store  # noqa: E402

SMALL = "/root/testdata/sf0.001"


def test_each_stage_takes_effect(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, seen = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES:
        seen.append(store(stage(spark, seen[-1], SMALL)))
        if name != "packing":
            assert seen[-1].columns == columns and seen[-1].schema["doc_id"] == docs.schema["doc_id"]
    _, clean, deduped, single, safe, packed = seen
    model = toxicity.train(docs, spark.read.parquet(f"{SMALL}/labels.parquet"))
    rejected = toxicity.score(docs, model).where("predicted = 1")
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in docs.collect()} - {r.doc_id for r in rejected.collect()}
    assert deduped.count() == clean.count() and deduped.where("n_chars <> length(text)").count() == 0
    groups = simhash.near_duplicates(deduped).select("component_id").distinct().count()
    assert single.count() == groups
    assert secrets.find(safe).where("n_assign + n_access + n_hex > 0").count() == 0 and safe.count() == single.count()
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == {r.doc_id for r in safe.collect()}


def test_awkward_rows_pass_all_stages(spark):
    docs = documents(spark)
    for name, stage in corpus_pipeline.STAGES:
        out = store(stage(spark, docs, SMALL))
        assert name == "packing" or out.columns == docs.columns
        docs = out
    assert docs.count() > 0


@pytest.mark.parametrize("k", range(5))
def test_empty_table(spark, k):
    assert corpus_pipeline.STAGES[k][1](spark, documents(spark, []), SMALL).count() == 0


def test_run_is_the_stages_in_turn(spark):
    assert corpus_pipeline.run(spark, SMALL).count() > 0


def test_stored_tables(spark):
    df = store(spark.range(10))
    assert small(df).count() == 10 and small(df, 5).count() == 10
    folder = Path(df.inputFiles()[0].removeprefix("file://")).parent
    assert folder.exists()
    drop(df)
    assert not folder.exists()


def test_clean_documents_stay(spark):
    docs = documents(spark, [(i, prose(i, 80), "en", "a") for i in range(50)])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = store(stage(spark, docs, SMALL))
    assert docs.count() == 50 and {r.doc_id: r.text for r in docs.collect()} == {i: prose(i, 80) for i in range(50)}
