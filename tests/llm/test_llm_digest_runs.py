import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest
from texts import documents, prose, rows

from swipelake.llm import digest_runs


def brute(docs):
    groups = defaultdict(list)
    for key, text, *_ in docs:
        groups[re.sub(r"[ \t-\r]+", " ", text or "")].append(key)
    out = Counter()
    for text, keys in groups.items():
        keys.sort(key=lambda k: (k is None, k))
        sha = hashlib.sha256(text.encode()).hexdigest()
        for i, key in enumerate(keys):
            out[key, keys[0], len(keys), i == 0, sha] += 1
    return out


def found(df):
    assert df.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    return Counter(map(tuple, df.collect()))


def corpus(n=400):
    """A third of the rows is one text; small groups, blanks that differ, keys that are null or repeat."""
    r = random.Random(1)
    out = []
    for i in range(n):
        words = prose(7 if i % 3 == 0 else r.randrange(90), 12).split()
        text = "".join(w + r.choice([" ", "\n", "\t ", " \r\n", "\x0b\x0c"]) for w in words)
        out.append((r.choice([None, i, i, i, 5]), text, "en", "a"))
    return [*out, *rows()]


@pytest.mark.parametrize("bits, step", [(None, 4), (1, 1), (5, 2), (7, 3), (12, 12)])
def test_against_grouping_by_text(spark, bits, step):
    docs = corpus()
    df = documents(spark, docs).repartition(9)
    assert found(digest_runs.find(df, bits=bits, step=step)) == brute(docs)


@pytest.mark.parametrize("digest_bytes", [1, 4])
def test_digests_that_collide(spark, digest_bytes):
    """With a digest of one byte nearly all groups hold several texts; texts decide."""
    docs = corpus()
    assert found(digest_runs.find(documents(spark, docs), digest_bytes=digest_bytes)) == brute(docs)


def test_same_result_without_broadcast(spark):
    docs = corpus(100)
    assert found(digest_runs.find(documents(spark, docs), broadcast_rows=0)) == brute(docs)


def test_each_round_merges_a_few_runs(spark):
    """One digest in all 64 runs: no group of any round holds more than 2^step of its entries."""
    runs = spark.range(64).selectExpr("id as node", "unhex(sha2('x', 256)) as digest", "1L as n", "id as least")
    once = digest_runs.merge_runs(runs, ["digest"], 2, 2)  # a round over the lowest two bits
    assert sorted(r.n for r in once.collect()) == [4] * 16
    whole = digest_runs.merge_runs(runs, ["digest"], 6, 2).collect()
    assert [(r.n, r.least) for r in whole] == [(64, 0)]


def test_plan_has_no_python(spark, explain):
    plan = explain(digest_runs.find(documents(spark)), final=True)
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_empty_table_and_one_of_each(spark):
    assert digest_runs.find(documents(spark, [])).count() == 0
    docs = rows()
    kept = digest_runs.one_of_each(documents(spark, docs)).collect()
    assert sum(r.group_size for r in kept) == len(docs) and len(kept) == len({re.sub(r"[ \t-\r]+", " ", t or "") for _, t, *_ in docs})
