import math
import re
import zlib
from collections import Counter, defaultdict

import pytest
from texts import documents, prose, rows

from swipelake.llm import ppm


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", lower(text)) + [None]


def learnt(key):
    return zlib.crc32(str("" if key is None else key).encode()) % 7 != 2


class Trie:
    """Contexts in dictionaries, one byte after another."""

    def __init__(self, texts):
        self.counts = [defaultdict(Counter) for _ in range(ppm.ORDER + 1)]
        for t in texts:
            raw = self.raw(t)
            for i in range(ppm.ORDER, len(raw)):
                for k in range(ppm.ORDER + 1):
                    self.counts[k][raw[i - k : i]][raw[i]] += 1

    @staticmethod
    def raw(text):
        return b"\xff" * ppm.ORDER + lower(text).encode() + b"\xff"

    def chances(self, before):
        """Every byte's probability behind ``before``."""
        out, left, excluded = {}, 1.0, set()
        for k in range(ppm.ORDER, -1, -1):
            seen = self.counts[k].get(before[len(before) - k :], {})
            fresh = {b: n for b, n in seen.items() if b not in excluded}
            total = sum(fresh.values())
            for b, n in fresh.items():
                out[b] = left * (n - 0.5) / total
            if fresh:
                left *= 0.5 * len(fresh) / total
            excluded |= set(seen)
        for b in set(range(256)) - excluded:
            out[b] = left / (256 - len(excluded))
        return out

    def score(self, text):
        raw = self.raw(text)
        return sum(math.log10(self.chances(raw[i - ppm.ORDER : i])[raw[i]]) for i in range(ppm.ORDER, len(raw)))


@pytest.mark.parametrize("batch_bytes", [ppm.BATCH_BYTES, 3000])
def test_same_as_one_trie(spark, batch_bytes):
    docs = [r for r in rows() if len(r[1] or "") < 20_000]
    got = sorted(ppm.score(documents(spark, docs), batch_bytes=batch_bytes).collect(), key=str)
    train = [r for r in docs if learnt(r[0])]
    trie = Trie([r[1] for r in train])
    counts = Counter(w for r in train for w in words(r[1]))
    n, v = sum(counts.values()), len(counts)
    assert len(got) == len(docs)
    for r in got:
        text = next(d[1] for d in docs if d[0] == r.doc_id)
        own = words(text)
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in own)
        assert r.held_out == (not learnt(r.doc_id)) and r.train_tokens == n
        assert (r.n_tokens, r.n_known) == (len(own), sum(counts[w] > 0 for w in own))
        assert r.base_score == pytest.approx(base)
        assert r.score == pytest.approx(trie.score(text), rel=1e-6)


def test_chances_add_up_to_one():
    trie = Trie(["abracadabra", "abc", "", "brabant"])
    for before in (b"\xff" * 5, b"\xffabra", b"zzzzz", b"abrab"):
        assert sum(trie.chances(before).values()) == pytest.approx(1) or not trie.counts[0]


def test_nothing_to_learn_from(spark):
    held = next(k for k in range(100) if not learnt(k))
    r = ppm.score(documents(spark, [(held, "two words", "en", "a")])).first()
    assert r.held_out and r.train_tokens == 0 and r.n_known == 0
    assert r.base_score == 0 and r.score == pytest.approx(-10 * math.log10(256))


def test_empty_table(spark):
    assert ppm.score(documents(spark, [])).count() == 0


def test_rows_are_dealt_whatever_they_hold(spark):
    """A third of the rows has a null key and one text: no batch has much more than others."""
    docs = [(None if i % 3 == 0 else i, "one text of a third" if i % 3 == 0 else prose(i, 4), "en", "a") for i in range(3000)]
    source = documents(spark, docs).selectExpr("doc_id AS key", "1 AS fold", "text")
    sizes = Counter()
    for r in ppm.bundles(source, 16).collect():
        sizes[r.batch] += len(r["keys"])
    assert sum(sizes.values()) == 3000 and max(sizes.values()) < 2 * sorted(sizes.values())[8]
