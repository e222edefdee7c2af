import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from swipelake.llm import mtree


def whole(v):
    return [math.floor(256 * float(np.float32(x))) for x in v]


def brute(rows, k=5, every=5):
    """Every query against every row."""
    usable = [(i, whole(v)) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    queries = {}
    for i, v in usable:
        if i % every == 0:
            queries[i] = min(v, queries.get(i, v))
    out = []
    for q, v in queries.items():
        scores = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in usable if i != q)[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores)]
    return sorted(out)


def search(spark, rows, **more):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, score double, node int")
    got = mtree.nearest(df, F.col("vec_id") % 5 == 0, **more)
    return sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got.collect())


def filled(rows):
    return [(i, v, 1, 2.0, 3) for i, v in rows]


def vectors(seed, n, width=6, spread=0.1, groups=9):
    r = random.Random(seed)
    centers = [[r.gauss(0, 1) for _ in range(width)] for _ in range(groups)]
    return [(i, [c + r.gauss(0, spread) for c in r.choice(centers)]) for i in range(n)]


@pytest.mark.parametrize("nodes, block", [(1, 7), (5, 20_000), (40, 3)])
def test_same_as_brute_force(spark, nodes, block, monkeypatch):
    monkeypatch.setattr(mtree, "PAGE", 16)
    monkeypatch.setattr(mtree, "SPREAD", 50)
    rows = vectors(nodes, 400)
    assert search(spark, filled(rows), nodes=nodes, query_block=block) == brute(rows)


def test_ties_bad_vectors_and_repeated_rows(spark):
    r = random.Random(2)
    rows = [(i, [float(r.randint(-1, 1)) for _ in range(3)]) for i in range(120)]  # many equal vectors
    rows += [(200, None), (205, [1.0, None, 2.0]), (210, [float("nan"), 1.0, 1.0]), (215, [float("inf"), 0.0, 0.0]), (None, [9.0, 9.0, 9.0])]
    rows += [(220, []), (225, [3.0]), (230, [0.0, 0.0, 0.0]), rows[0], rows[7], (10, [5.0, 5.0, 5.0])]
    assert search(spark, filled(rows)) == brute(rows)


def test_fewer_rows_than_asked_for(spark):
    rows = [(5, [1.0, 0.5]), (6, [0.25, -1.0]), (10, [0.0, 0.0])]
    assert search(spark, filled(rows)) == brute(rows) and len(brute(rows)) == 4


def test_empty_tables(spark):
    assert search(spark, []) == []
    assert search(spark, filled([(1, [1.0]), (2, [2.0])])) == []  # no query
    assert search(spark, filled([(5, None)])) == []


def tree_of(x, ids, nodes, page):
    """Both levels, as tasks make them."""
    import pyarrow as pa

    length2 = float((x**2).sum(axis=1).max())
    tree = mtree.Tree(x[:nodes], ids[:nodes], length2, x.shape[1])
    distances = tree.of_data(x)
    home = distances.argmin(axis=1)
    made = []
    for n in range(nodes):
        own = np.flatnonzero(home == n)
        tree.radii[n] = distances[own, n].max(initial=0)
        held = {"id": ids[own], "v": [list(map(int, v)) for v in x[own]], "node": [n] * len(own), "mixed": (ids[own] * 7919) % 104729, "part": [0] * len(own)}
        if len(own):
            made.append(mtree.made_pages(tree, pa.table(held), page))
    return tree, pa.concat_tables(made).combine_chunks()


def pages_of(table, width):
    columns = {c: table[c].to_numpy() for c in ("node", "page", "distance", "up", "radius", "id")}
    return mtree.Pages(*(columns[c] for c in ("node", "page", "distance", "up", "radius")), columns["id"], mtree.matrix(table["v"].to_pylist(), width))


def test_nodes_and_pages_cover_their_vectors():
    rows = vectors(5, 900, spread=0.3, groups=7) + vectors(5, 40, spread=0.3, groups=7)
    x, ids = np.array([whole(v) for _, v in rows], dtype=float), np.arange(940)
    tree, table = tree_of(x, ids, 12, 16)
    held = pages_of(table, 6)
    assert sorted(held.ids.tolist()) == ids.tolist() and len(held.first) >= 940 // 16 - 12
    for p in range(len(held.first)):
        inside = slice(held.first[p], held.end[p])
        d = tree.of_data(held.x[inside], held.centers[[p]])[:, 0]
        assert np.allclose(d, held.distance[inside], atol=0.05) and held.radius[p] >= held.distance[inside].max()
        assert held.distance[held.first[p]] == 0 and np.isclose(held.up[p], tree.of_data(held.centers[[p]])[0, held.node[p]])
        assert (tree.of_data(held.x[inside])[:, held.node[p]] <= tree.radii[held.node[p]] + 1e-6).all()


@pytest.mark.parametrize("spread, most", [(0.02, 0.15), (0.1, 0.5)])
def test_bounds_leave_most_out(spread, most):
    """On clustered vectors most products, those with nodes and centers among them, are never computed."""
    rows = vectors(3, 4000, spread=spread, groups=40)
    x, ids = np.array([whole(v) for _, v in rows], dtype=float), np.arange(4000)
    tree, table = tree_of(x, ids, 40, 32)
    best = mtree.Best(50, 5)
    done = mtree.search_pages(tree, x[:50], ids[:50], np.full(50, -np.inf), best, pages_of(table, 6))
    assert done < most * 50 * 4000
    for q in range(50):
        scores = sorted(((-x[q] @ x[i], i) for i in range(4000) if i != q))[:5]
        assert best.ids[q].tolist() == [i for _, i in scores]


def test_pages_that_go_on_in_the_next_batch(spark):
    """With three rows a batch the pages are cut, and their centers are carried on."""
    rows = vectors(8, 300)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        assert search(spark, filled(rows), nodes=4) == brute(rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
