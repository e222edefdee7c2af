import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F
from texts import documents, prose, rows

from swipelake.llm import simhash
from swipelake.llm.components import components


def fingerprint(text):
    """Straight from the definition."""
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(links, nodes):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {n: find(n) for n in nodes}


def signed(bits):
    return bits - (1 << 64) if bits >> 63 else bits


def test_documents(spark):
    docs = rows()
    got = simhash.near_duplicates(documents(spark)).collect()
    prints = [fingerprint(r[1]) for r in docs]
    nodes = sorted(set(prints))
    root = roots([(a, b) for a in nodes for b in nodes if a < b and (a ^ b).bit_count() <= 2], nodes)
    least = {}
    for r, p in zip(docs, prints):
        if r[0] is not None:
            least[root[p]] = min(r[0], least.get(root[p], r[0]))
    want = [(r[0], f"{p:016x}", least.get(root[p])) for r, p in zip(docs, prints)]
    assert sorted(map(str, want)) == sorted(str((r.doc_id, r.fingerprint, r.component_id)) for r in got)


def test_masks_cover_every_pair():
    masks = [m % (1 << 64) for m in simhash.masks(2)]
    for i in range(64):
        for j in range(64):
            assert any(not m & (1 << i | 1 << j) for m in masks)


@pytest.mark.parametrize("dense", [2, 8, 10_000])
def test_links_of_crowded_buckets(spark, dense):
    """Both ways of comparing a bucket give the components of all pairs; many nodes lie close."""
    r = random.Random(dense)
    prints = set()
    for _ in range(6):
        center = r.getrandbits(64)
        crowd = [center]
        for _ in range(60):
            crowd.append(r.choice(crowd) ^ sum(1 << b for b in r.sample(range(64), r.choice([1, 2, 3]))))
        prints |= set(crowd)
    prints |= {0, (1 << 64) - 1, 1 << 63}
    nodes = spark.createDataFrame([(signed(p),) for p in prints], "bits long")
    found = {(x.a, x.b) for x in simhash.links(nodes, dense=dense).collect()}
    real = {tuple(sorted((signed(a), signed(b)))) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= 2}
    assert {tuple(sorted(p)) for p in found} <= real
    names = [signed(p) for p in prints]
    assert roots(found, names) == roots(real, names)
    got = {x.node: x.root for x in components(spark.createDataFrame(sorted(found), "a long, b long")).collect()}
    assert {n: got.get(n, n) for n in names} == roots(real, names)


def test_components_of_a_long_path(spark):
    r = random.Random(4)
    names = list(range(300))
    r.shuffle(names)
    links = list(zip(names, names[1:])) + [(5, 5), (1000, 1001), (1001, 1000)]
    got = {x.node: x.root for x in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {n: 0 for n in range(1, 300)} | {1001: 1000}


def test_one_of_each_group_stays(spark):
    docs = documents(spark)
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    classes = {}
    for r in rows():
        classes.setdefault(fingerprint(r[1]), []).append(r[0])
    merged = simhash.near_duplicates(docs)
    groups = merged.select("fingerprint", "component_id").distinct()
    assert kept.count() == groups.select("component_id").distinct().count()
    keys = [r.doc_id for r in kept.collect()]
    assert len(keys) == len(set(keys)) and {1, 3, 11} <= set(keys) and not {2, 4, 12, 13} & set(keys) and None in keys


def test_another_radius_is_refused(spark):
    with pytest.raises(ValueError):
        simhash.links(spark.createDataFrame([(1,)], "bits long"), radius=3)


def test_empty_table(spark):
    assert simhash.near_duplicates(documents(spark, [])).count() == 0
    assert simhash.one_of_each(documents(spark, [])).count() == 0


def test_copies_of_one_text(spark):
    docs = spark.range(500).select(F.col("id").alias("doc_id"), F.lit(prose(1, 50)).alias("text"))
    got = simhash.near_duplicates(docs).agg(F.min("component_id"), F.max("component_id"), F.count("*")).first()
    assert tuple(got) == (0, 0, 500)
