import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from texts import documents, prose, rows

from swipelake.llm import term_scan

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=20):
    held = [(key, Counter(t), len(t)) for key, text, *_ in docs if (t := terms(text))]
    n_all, length = len(held), sum(n for _, _, n in held)
    out = Counter()
    for item_id, text in items:
        scored = []
        for key, tf, n in held:
            m = 100 - 25 + 25 * n * n_all // length
            s = 0
            for t in terms(text):
                df = sum(t in other for _, other, _ in held)
                s += math.floor(1000 * math.log((2 * n_all + 2) / (2 * df + 1))) * (1000000000 * tf[t] // (1000 * tf[t] + 12 * m))
            if s > 0:
                scored.append((-s, key is None, key or 0, key))
        out.update((item_id, rank, key, -s) for rank, (s, _, _, key) in enumerate(sorted(scored)[:k], 1))
    return out


def table(spark, items):
    return spark.createDataFrame([(i, t, 0, 1.0) for i, t in items], "item_id long, text string, doc_id int, score double")


ITEMS = [
    (1, "The quick-brown FOX, the fox"),
    (2, None),
    (3, " .,;\n\x00"),
    (4, "Ünïcode ☃ 𝒳 ﬁ zwj password"),
    (4, "tonight pale moon"),
    (None, "brews two words x"),
    (7, prose("passage", 70)),
    (8, "foxs lazyed nothing_of-this 1"),
]


def found(df):
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return Counter(map(tuple, df.collect()))


@pytest.mark.parametrize("block_bytes, cells", [(1 << 20, 1 << 20), (40, 64), (1, 7)])
def test_against_brute_force(spark, block_bytes, cells):
    docs = rows()
    got = term_scan.search(documents(spark, docs).repartition(5), table(spark, ITEMS), block_bytes=block_bytes, cells=cells)
    assert found(got) == brute(docs, ITEMS)


def test_many_equal_scores_and_a_null_key(spark):
    docs = [(r, "fox moon", "en", "a") for r in random.Random(2).sample(range(10_000), 200)] + [(None, "fox moon", "en", "a")] * 3
    docs += [(20_000 + i, prose(i, 50), "en", "a") for i in range(100)]
    items = [(1, "fox moon moon"), (2, "wizards mix")]
    assert found(term_scan.search(documents(spark, docs).repartition(7), table(spark, items), k=5, cells=50)) == brute(docs, items, 5)


def test_whole_numbers_beyond_doubles(spark, monkeypatch):
    docs = rows()
    monkeypatch.setattr(term_scan, "EXACT", 1)
    block = term_scan.Block(ITEMS, 0)
    block.weigh(10, 100, {})
    assert not block.exact()
    best = term_scan.Best(len(ITEMS), 3)
    scorer = term_scan.Scorer(block, best, 100)
    automaton = term_scan.automaton_of(block.terms)
    for key, text, *_ in docs:
        data = term_scan.lowered(text)
        scorer.add(key, len(data.split()), term_scan.matches(automaton, data))
    scorer.flush()
    assert best.held[1].dtype == np.int64 and len(best.held[0]) > 6


def test_terms_and_guards():
    text = "a1 b_c É-é ÀB \x7f[x]{y}`z`"
    assert term_scan.lowered(text).decode().split() == terms(text)
    automaton = term_scan.automaton_of(["a", "aa", "a"[:1] + "b"])
    assert term_scan.matches(automaton, term_scan.lowered("a A aa,ab aab b a")) == {0: 3, 1: 1, 2: 1}


@pytest.mark.parametrize("docs, items", [([], ITEMS), (None, []), (None, [(2, None)])])
def test_empty_tables(spark, docs, items):
    assert term_scan.search(documents(spark, docs), table(spark, items)).count() == 0
