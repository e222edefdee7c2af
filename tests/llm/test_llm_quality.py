import random
import re
from collections import Counter

import numpy as np
import pytest
from texts import documents, prose, rows

from swipelake.llm import quality


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(zip(words, words[1:], words[2:]))
    twice = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    seen, repeated = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            repeated += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), repeated, len(twice)


TRICKY = ["a b a b a b", "x x x x", "a b c d a b c e b c d", "#*$%&|<>\n#*\n#*\n \n \n\na\r\na\r", "a b  c", "é é é\né é é"]


def test_counts(spark):
    docs = rows() + [(900 + i, t, "en", "a") for i, t in enumerate(TRICKY)]
    got = quality.judge(documents(spark, docs)).collect()
    assert len(got) == len(docs)
    for r in got:
        n = tuple(r[c] for c in quality.COUNTS)
        assert n in [brute(d[1]) for d in docs if d[0] == r.doc_id]
        assert r.base_failed == (n[0] < 50 or 100 * n[4] > 50 * n[0])
        assert not (r.base_failed and r.kept)


def test_outliers_go_and_others_stay(spark):
    r = random.Random(5)
    docs = [(i, "\n".join(prose(f"{i}/{k}", 20) for k in range(r.randint(4, 12))), r.choice(["en", "fr"]), r.choice("abc")) for i in range(1500)]
    shout = {i for i in range(0, 1500, 7)}
    docs = [(i, t.upper().replace(" ", "!! ") if i in shout else t, *more) for i, t, *more in docs]
    docs += [(2000 + i, prose(i, 90), "de", None) for i in range(5)]  # too few rows to judge
    got = {r.doc_id: r for r in quality.judge(documents(spark, docs)).collect()}
    passed = [i for i in got if not got[i].base_failed]
    assert not any(got[i].kept for i in passed if i in shout)
    assert all(got[i].kept for i in passed if i not in shout)
    assert all(got[2000 + i].distance is None for i in range(5))


def plain_estimate(x, share, steps, floors):
    """The same steps on one cell in memory, by exact order of distances instead of the histogram."""
    p = x.shape[1]
    edge = quality.chi2_limit(1 - share, p)
    scale = share / quality.chi2_share(edge, p + 2)
    q = np.quantile(x, [0.25, 0.5, 0.75], axis=0)
    mean, inverse = q[1], np.diag(1 / np.maximum((q[2] - q[0]) / 1.349, floors) ** 2)
    for _ in range(steps):
        d = np.einsum("ij,jk,ik->i", x - mean, inverse, x - mean)
        near = x[np.argsort(d)[: int(np.ceil(share * len(x)))]]
        mean = near.mean(axis=0)
        cov = np.cov(near.T, bias=True) * scale
        cov[np.diag_indices(p)] += np.square(floors)
        inverse = np.linalg.inv(cov)
    return mean, inverse


def test_estimates(spark):
    r = np.random.default_rng(2)
    x = np.concatenate([r.normal(size=(1600, 6)) @ np.diag([1, 2, 1, 0.5, 3, 1]), r.normal(8, 1, size=(400, 6))])
    df = spark.createDataFrame([("c", *map(float, row)) for row in x], "cell string, " + ", ".join(f"{c} double" for c in quality.STATS))
    model = quality.fit(df).first()
    mean, inverse = plain_estimate(x, quality.H, quality.STEPS, quality.FLOORS)
    assert np.allclose(model.mean, mean, atol=0.1)
    assert np.allclose(np.diag(np.array(model.inverse).reshape(6, 6)), np.diag(inverse), rtol=0.15)
    assert np.abs(np.array(model.mean)).max() < 0.4  # a fifth of the rows lies elsewhere and doesn't pull


def test_small_sources_are_pooled(spark):
    stats = [("en", f"s{i % 50}") for i in range(500)] + [("en", "big")] * 300 + [(None, None)] * 250 + [("fr", "x")] * 30
    df = spark.createDataFrame(stats, "lang string, source string")
    sizes = {r.cell: r["count"] for r in quality.cells(df, 200).groupBy("cell").count().collect()}
    assert sorted(sizes.values()) == [30, 250, 300, 500] and sizes["rest"] == 30


def test_chi_square():
    assert quality.chi2_share(5.348, 6) == pytest.approx(0.5, abs=1e-3)
    assert quality.chi2_limit(0.05, 6) == pytest.approx(12.592, abs=1e-2)


def test_empty_table(spark):
    assert quality.judge(documents(spark, [])).count() == 0


@pytest.mark.parametrize("alike", [True, False])
def test_a_third_of_junk_in_one_cell_goes(spark, alike):
    """35 % of a cell are bad, as copies of one text or as texts of their own; so are rows of a small cell."""
    r = random.Random(11)

    def good(i):
        return "\n".join(prose(f"{i}/{k}", 20) for k in range(r.randint(4, 12)))

    def bad(i):
        return prose("junk" if alike else i, 120).upper().replace(" ", "!! ")

    docs = [(i, bad(i) if i % 20 < 7 else good(i), "en", "a") for i in range(1200)]
    docs += [(2000 + i, bad(i) if i < 2 else good(i), "de", "b") for i in range(5)]
    got = {x.doc_id: x for x in quality.judge(documents(spark, docs)).collect()}
    assert not any(got[i].base_failed for i in got)
    assert not any(got[i].kept for i in range(1200) if i % 20 < 7)
    assert all(got[i].kept for i in range(1200) if i % 20 >= 7)
    assert [got[2000 + i].kept for i in range(5)] == [False, False, True, True, True]


def test_edge_bin_is_split(spark):
    """Equal rows share one bin; only the share that is asked for enters."""
    r = np.random.default_rng(4)
    x = np.concatenate([r.normal(size=(650, 6)), np.full((350, 6), 9.0)])
    df = spark.createDataFrame([("c", *map(float, row)) for row in x], "cell string, " + ", ".join(f"{c} double" for c in quality.STATS))
    model = quality.fit(df, share=0.75, steps=1).first()  # a tenth of all rows are copies, not 35 %
    assert np.allclose(model.mean, 9 * 0.1 / 0.75, atol=0.15)
