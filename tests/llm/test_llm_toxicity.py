import random
import zlib

import numpy as np
import pytest
from texts import documents, prose

from swipelake.llm import toxicity


def table(spark, n=600):
    r = random.Random(7)
    docs, labels = [], []
    for i in range(n):
        text = prose(i, 60)
        toxic = i % 4 == 0
        if toxic:
            text = text.replace(" ", f" {r.choice(['Scoundrel', 'nincompoop', 'blockheads'])} ", 2)
        if i % 8 == 0 or i % 15 == 1:
            text += " about " + ("muslims" if toxic or r.random() < 0.3 else r.choice(["christians", "jews", "hindus"]))
        docs.append((i, text, "en", "a"))
        labels.append((i, 1, int(toxic)))
    return documents(spark, docs), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def held_out(key):
    return zlib.crc32(str(key).encode()) % 3 == 1


def test_held_out_accuracy(spark):
    docs, labels = table(spark)
    got = toxicity.score(docs, toxicity.train(docs, labels)).collect()
    assert len(got) == 600
    for r in got:
        assert r.held_out == held_out(r.doc_id) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    tested = [r for r in got if r.held_out]
    assert np.mean([r.predicted == int(r.doc_id % 4 == 0) for r in tested]) > 0.97


def test_held_out_labels_are_not_learnt(spark):
    """Other labels in the held-out fold change no score."""
    docs, labels = table(spark, 200)
    flipped = spark.createDataFrame(
        [(r.doc_id, r.quality, 1 - r.toxic if held_out(r.doc_id) else r.toxic) for r in labels.collect()], labels.schema
    )
    a, b = (sorted(toxicity.score(docs, toxicity.train(docs, x)).collect()) for x in (labels, flipped))
    assert a == b


def test_swaps_of_identity_terms_cost(monkeypatch):
    """With the term, a group that is named more often in toxic texts raises the score less."""
    r = np.random.default_rng(1)
    labels = (r.random(400) < 0.5).astype(np.float32)
    # features: 0 an insult, 1 one group, 2 another group
    vectors = [sorted(({0} if y and r.random() < 0.7 else set()) | ({1} if r.random() < (0.8 if y else 0.2) else {2})) for y in labels]
    changes = [((1, -1.0), (2, 1.0)), ((1, 1.0), (2, -1.0))]
    counts = [sum(1 in v for v in vectors), sum(2 in v for v in vectors)]
    gaps = []
    for weight in (0.0, 1.0, 50.0):
        monkeypatch.setattr(toxicity, "SWAP_WEIGHT", weight)
        _, w = toxicity.fit(vectors, labels, changes, counts, 3)
        gaps.append(abs(w[1] - w[2]))
        assert w[0] > 1
    assert gaps[0] > gaps[1] > gaps[2]


def test_swaps_change_only_the_terms_features():
    index = {"muslims ": 0, "jews ": 1, "other ": 2, "musl1": 3}
    assert {0: -1.0, 1: 1.0, 3: -1.0} in toxicity.swaps({"muslims", "other"}, index)
    assert toxicity.swaps({"other"}, index) == []


@pytest.mark.parametrize("labels, score", [([], 0.0), ([(11, 1, 1), (12, 1, None)], None)])
def test_too_few_labels(spark, labels, score):
    docs = documents(spark)
    some = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = toxicity.score(docs, toxicity.train(docs, some)).collect()
    assert len(got) == docs.count()
    if score is not None:
        assert all(r.score == pytest.approx(score, abs=1e-6) for r in got)


def test_empty_table(spark):
    docs, labels = table(spark, 50)
    none = documents(spark, [])
    assert toxicity.score(none, toxicity.train(none, labels)).count() == 0


def test_the_sample_is_bounded_in_rows(spark):
    """One drawn key stands on 3,000 rows with different texts, and on copies of one text."""
    docs = documents(spark, [(1, prose(i, 12), "en", "a") for i in range(3000)] + [(7, "one text", "en", "a")] * 500 + [(8, None, "en", "a"), (2, "held out", "en", "a")])
    labels = spark.createDataFrame([(k, 1, k % 2) for k in (1, 2, 7, 8)], "doc_id long, quality int, toxic int")
    assert held_out(2) and not any(map(held_out, (1, 7, 8)))
    different = len({prose(i, 12) for i in range(3000)}) + 2
    for size in (50, 5000):
        rows = toxicity.sample(docs, labels, "doc_id", "text", "toxic", size).collect()
        assert len(rows) == min(size, different) == len({r.text for r in rows})
        assert {r.drawn_label for r in rows} <= {0, 1}
