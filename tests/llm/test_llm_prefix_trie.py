import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from swipelake.llm import prefix_trie


def token(role, text):
    import base64

    return base64.b64encode(hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:15])


def brute(rows):
    """Rebuild, then a dictionary of prefixes."""
    turns = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            role, text = role or "", text or ""
            turns[conv].append((turn is not None, turn or 0, token(role, text), role, text))
    own = {c: [(t[3], t[4]) for t in sorted(v)] for c, v in turns.items()}
    whole = {}
    for c, t in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        giver = c - (c % 5 if c >= 0 else -(-c % 5))
        whole[c] = own.get(giver, [])[:h] + t[h:]
    members, ends, children = defaultdict(list), defaultdict(list), defaultdict(set)
    for c, t in whole.items():
        for d in range(len(t) + 1):
            members[tuple(t[:d])].append(c)
            if d:
                children[tuple(t[: d - 1])].add(tuple(t[:d]))
        ends[tuple(t)].append(c)
    leaves, saved = Counter(), Counter()
    for node in members:
        value = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        for d in range(len(node) + 1):
            saved[node[:d]] += value
            leaves[node[:d]] += not children[node]
    return Counter(
        (
            min(m), len(node), min(members[node[:-1]]) if node else None, len(m), len(children[node]), leaves[node], saved[node],
            hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest(),
        )
        for node, m in list(members.items())
    )


def table(spark, rows):
    more = ("u", 1, 2, 3)
    schema = "conv_id long, turn long, role string, text string, up string, depth long, n int, place int"
    return spark.createDataFrame([(*r, *more) for r in rows], schema)


def corpus(convs=120, longest=9, seed=1):
    """Few different turns, so prefixes are shared; nulls, ties, repeated rows, gaps in the numbers."""
    r = random.Random(seed)
    rows = []
    for c in range(convs):
        if r.random() < 0.1:
            continue
        for t in range(r.randint(1, longest)):
            rows.append((c, r.choice([t, t, t, t, None, 3]), r.choice(["user", "assistant", None]), r.choice(["a", "bé", "", None, "☃" * 3])))
    rows += r.choices(rows, k=20)
    rows += [(None, 1, "user", "lost"), (-3, 0, "user", "a"), (-5, 0, "user", "a"), (-5, 1, "user", "a"), (2**62, None, None, None)]
    same = [(1000 + 5 * i, t, "user", f"same {t}") for i in range(60) for t in range(12)]  # a third: one conversation
    return rows + same


def found(df):
    assert df.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return Counter(map(tuple, df.collect()))


@pytest.mark.parametrize("segment, shard_turns", [(256, 1 << 16), (256, 256), (4, 6), (3, 3), (1, 1)])
def test_against_brute_force(spark, segment, shard_turns):
    rows = corpus()
    assert found(prefix_trie.nodes(table(spark, rows).repartition(6), segment=segment, shard_turns=shard_turns)) == brute(rows)


def test_one_conversation_with_a_third_of_the_rows(spark):
    rows = corpus(60) + [(7, t, "user", f"turn {t}") for t in range(400)] + [(5, t, "user", f"turn {t}") for t in range(300)]
    df = table(spark, rows).repartition(5)
    numbered = prefix_trie.numbered_turns(df.withColumnRenamed("conv_id", "conv"))
    assert numbered.where("conv = 7").select("part").distinct().count() > 1
    assert found(prefix_trie.nodes(df, segment=16, shard_turns=64)) == brute(rows)


def test_many_ends_are_hashed_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "ID_BLOCK", 16)
    rows = [(5 * i, t, "user", "x") for i in range(-50, 300) for t in range(2)]
    assert found(prefix_trie.nodes(table(spark, rows))) == brute(rows)


def test_turnless_conversation(spark):
    c = next(c for c in range(1, 100) if c % 5 and zlib.crc32(str(c).encode()) % 9 >= 3)
    rows = [(c, 0, "user", "gone")]
    assert found(prefix_trie.nodes(table(spark, rows))) == brute(rows) == Counter([(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())])


def test_empty_table(spark):
    assert prefix_trie.nodes(table(spark, [])).count() == 0
    assert prefix_trie.nodes(table(spark, [(None, 1, "a", "b")])).count() == 0


def test_double_array_holds_exactly_its_paths():
    r = random.Random(5)
    paths = sorted({tuple(r.randrange(40) for _ in range(r.randint(1, 5))) for _ in range(300)} | {(i,) for i in range(40)})
    length = np.array([len(p) for p in paths])
    trie = prefix_trie.DoubleArray.of(np.array([t for p in paths for t in p]), np.cumsum(length) - length, length)
    prefixes = {p[:d] for p in paths for d in range(1, len(p) + 1)}

    def reached(path):
        s = 0
        for t in path:
            n = trie.base[s] + t
            if not 0 < n < len(trie.check) or trie.check[n] != s:
                return False
            s = n
        return True

    assert all(map(reached, prefixes))
    some = {tuple(r.randrange(40) for _ in range(r.randint(1, 5))) for _ in range(3000)}
    assert all(reached(p) == (p in prefixes) for p in some if all(p[:d] in prefixes for d in range(1, len(p))))
    assert sum(c >= 0 for c in trie.check) == len(prefixes) + 1  # every state is a node
    with pytest.raises(ValueError):
        prefix_trie.nodes(None, segment=8, shard_turns=4)
