import random

import numpy as np
import pytest
from sentencepiece import SentencePieceProcessor
from texts import documents, prose

from swipelake.llm import pieces
from swipelake.llm.queries import tokenizer

PATH = tokenizer("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=PATH)


def ids(model, text):
    return np.frombuffer(model.encode([text])[0], dtype="i4").tolist()


def test_merges_are_the_librarys(spark, library):
    docs = documents(spark)
    for r in pieces.encode(docs, PATH).collect():
        text = next(d.text for d in docs.collect() if d.doc_id == r.doc_id)
        assert r.ids == library.encode(text or "") and r.n_ids == len(r.ids) and r.round_trip


def test_decoding_is_a_round_trip(spark):
    docs = documents(spark)
    back = pieces.decode(pieces.encode(docs, PATH), PATH)
    want = sorted(((r.doc_id, (r.text or "").replace("▁", " ")) for r in docs.collect()), key=str)
    assert sorted(((r.doc_id, r.text) for r in back.collect()), key=str) == want


def test_long_words_are_streamed(library):
    model = pieces.Model(PATH)
    r = random.Random(1)
    text = "".join(r.choice("thereingands-=") for _ in range(20_000))
    assert ids(model, text) == library.encode(text)
    assert model.most_kept < 200  # of 20,000 boundaries


def best_score(model, text):
    """Best sum of scores over all cuts, by plain dynamic programming over the whole text."""
    best = [0.0] + [float("-inf")] * len(text)
    for end in range(1, len(text) + 1):
        for start in range(max(0, end - model.longest), end):
            own = model.score.get(text[start:end], model.unknown if end - start == 1 else None)
            if own is not None:
                best[end] = max(best[end], best[start] + own)
    return best[-1]


def test_unigram_paths_have_the_best_score():
    model = pieces.Model(PATH, pieces.UNIGRAM)
    for seed in range(20):
        text = model.normalize(prose(seed, 30))
        got = [p for part in model.stream(text) for p in part]
        assert "".join(got) == text
        assert sum(model.score.get(p, model.unknown) for p in got) == pytest.approx(best_score(model, text))


def test_empty_table(spark):
    assert pieces.encode(documents(spark, []), PATH).count() == 0
