import zlib
from collections import defaultdict

import numpy as np
import pytest
from texts import documents
from tokenizers import Tokenizer

from swipelake.llm import packing
from swipelake.llm.queries import tokenizer

PATH = tokenizer("word_bpe_49k.json")


def check(pieces, docs, longest=4096):
    """Every id lies in exactly one piece; sequences are gapless and need no padding."""
    tokens = Tokenizer.from_file(PATH)
    want = defaultdict(int)
    for r in docs:
        ids = np.array(tokens.encode(r.text or "", add_special_tokens=False).ids + [2], dtype="<u4")
        want[r.doc_id, ids.tobytes()] += 1
    by_key = defaultdict(list)
    for p in pieces:
        by_key[p.doc_id].append(p)
    got = defaultdict(int)
    for key, own in by_key.items():
        texts = [t for k, t in want for _ in range(want[k, t]) if k == key]
        assert sum(p.length for p in own) == sum(len(t) // 4 for t in texts)
        if len(texts) == 1:
            at = 0
            for p in sorted(own, key=lambda p: p.start):
                assert p.start == at and p.doc_tokens == len(texts[0]) // 4
                part = texts[0][4 * at : 4 * (at + p.length)]
                assert zlib.crc32(part) == p.ids_crc32 and np.frombuffer(part, "<u4").tolist() == p.ids
                at += p.length
        got[key] += 1
    assert set(got) == {k for k, _ in want}
    sequences = defaultdict(list)
    for p in pieces:
        sequences[p.sequence_id].append(p)
    for own in sequences.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= longest and at & (at - 1) == 0
        assert len({p.step_group for p in own}) == 1


@pytest.mark.parametrize("tiers", [packing.TIERS, (8, 64), (16, 32, 64, 128)])
def test_pieces(spark, tiers):
    docs = documents(spark)
    out = packing.pack(docs.repartition(3), PATH, tiers=tiers, step_tokens=4 * tiers[-1]).collect()
    check(out, docs.collect(), tiers[-1])
    steps = defaultdict(int)
    for p in out:
        steps[p.step_group] += p.length
    assert max(steps.values()) <= 4 * tiers[-1]


def test_empty_table(spark):
    assert packing.pack(documents(spark, []), PATH).count() == 0


def test_bad_tiers(spark):
    with pytest.raises(ValueError):
        packing.pack(documents(spark), PATH, tiers=(100, 200))


def test_only_long_documents_close_their_gaps(spark):
    packer = packing.Packer((4, 8), 16, 0)
    for i in range(500):
        packer.add(i, 7)
    packer.finish()
    lengths = defaultdict(int)
    for _, _, n, s, *_ in packer.done:
        lengths[s] += n
    assert sum(lengths.values()) == 3500 and all(n & (n - 1) == 0 for n in lengths.values())


def test_long_windows_are_filled_from_shorter_tiers():
    packer = packing.Packer((4, 8), 16, 0)
    for i, n in enumerate([3, 2, 5]):
        packer.add(i, n)
    assert [(d, s, n) for d, s, n, *_ in packer.done] == [(2, 0, 5), (0, 0, 3)]
