"""Exact search for the largest inner products, in an M-tree, best pages first.

Vectors become whole numbers; the largest inner products are the nearest neighbours once every vector
gets one more coordinate that makes all lengths equal (queries get zero there), so a metric tree
finds them: d(q, x)^2 = |q|^2 + R^2 - 2 q.x for the common length R.

The tree has three levels. Routing nodes are a bounded sample of the vectors, each with its covering radius. Below them are
pages, one for about PAGE vectors, so their number grows with the rows: a page has one of its vectors as center, its covering
radius and the center's distance to its routing node. Every vector lies in a page with its distance to the center. Spark builds
both levels: a pass that sends each vector to its nearest node, and a grouping by node (large nodes in parts) that makes pages.

A query bounds a page by stored distances alone first, |d(q, node) - d(center, node)| - radius, and by its node's radius; only
pages that this leaves get the distance to their center computed, and d(q, center) - radius bounds them again. Then each query
goes through its own pages in the order of its own bounds, twice as many in each step, until the next bound is beyond its fifth
best score so far; in a page its vectors are left out by |d(q, center) - d(x, center)| before anything is computed. Scores are
whole numbers and exact; bounds allow for rounding.

Queries are taken in blocks of bounded size, each shipped to all pages; a task keeps only the best of
its pages per query, and the few of all tasks are merged by query. The first limit of a query is its
best scores among the routing nodes.

Cases: null vectors, and vectors with a null or a component that isn't finite, take no part; nor do
rows with a null id. Shorter vectors count as if filled with zeros. Rows that repeat are candidates
each; a query id that repeats is searched once, with the least of its vectors, and rows of its own id
are no candidates. Components must stay within 2 ** 20 after scaling, else the job fails. An empty table
gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from swipelake.llm.common import store

SCALE = 256
NODES = 256
PAGE = 64
QUERY_BLOCK = 20_000
SPREAD = 8192  # rows of one node that lie together; a larger node is dealt to several tasks
LARGEST = 1 << 20


def quantized(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of every component; null where the vector takes no part."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long"))
    small = F.forall(whole, lambda x: F.abs(x) <= LARGEST)
    return F.when(fine, F.when(small, whole).otherwise(F.raise_error(F.lit("a component is too large")).cast("array<bigint>")))


def matrix(column, width: int) -> np.ndarray:
    """Rows of a list column, filled up with zeros."""
    if isinstance(column, pa.Array):
        lengths = np.diff(column.offsets.to_numpy())
        if len(lengths) and (lengths == width).all():
            return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)
        column = column.to_pylist()
    out = np.zeros((len(column), width))
    for i, row in enumerate(column):
        out[i, : len(row)] = row
    return out


class Tree:
    """Routing nodes, as shipped to the tasks; their radii are known once all vectors have been sent to them."""

    def __init__(self, nodes: np.ndarray, node_ids: np.ndarray, length2: float, width: int):
        self.nodes, self.node_ids, self.length2, self.width = nodes, node_ids, length2, width
        self.radii = np.full(len(nodes), np.inf)

    def of_data(self, x: np.ndarray, centers: np.ndarray | None = None) -> np.ndarray:
        """Distances of vectors to the nodes, or to other vectors."""
        centers = self.nodes if centers is None else centers
        lift, other = (np.sqrt(np.maximum(self.length2 - (y**2).sum(axis=1), 0)) for y in (x, centers))
        return np.sqrt(np.maximum(2 * self.length2 - 2 * (x @ centers.T + np.outer(lift, other)), 0))

    def of_queries(self, q: np.ndarray, centers: np.ndarray | None = None) -> np.ndarray:
        """Distances of queries, which have no further coordinate."""
        centers = self.nodes if centers is None else centers
        return np.sqrt(np.maximum((q**2).sum(axis=1)[:, None] + self.length2 - 2 * (q @ centers.T), 0))


class Best:
    """The best scores of each query so far: scores descending, then ids ascending."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.scores = np.full((queries, k), -np.inf)
        self.ids = np.full((queries, k), np.iinfo(np.int64).max)

    def add(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """``scores`` has a row for each of ``rows`` and a column for each of ``ids``; -inf is no candidate."""
        if scores.shape[1] > 4 * self.k:
            # Only columns that reach the k-th largest of their row can enter; ties are all kept by the mask below.
            edge = -np.partition(-scores, self.k - 1, axis=1)[:, self.k - 1]
            keep = (scores >= edge[:, None]) & (scores >= self.scores[rows, -1][:, None])
            columns = keep.any(axis=0)
            if not columns.any():
                return
            scores, ids = scores[:, columns], ids[columns]
        both = np.concatenate([self.scores[rows], scores], axis=1)
        names = np.concatenate([self.ids[rows], np.broadcast_to(ids, scores.shape)], axis=1)
        order = np.lexsort((names, -both), axis=1)[:, : self.k]
        self.scores[rows] = np.take_along_axis(both, order, axis=1)
        self.ids[rows] = np.take_along_axis(names, order, axis=1)


PAGES = "id long, v array<bigint>, node int, page long, distance double, up double, radius double"


def made_pages(tree: Tree, held: pa.Table, page: int = PAGE) -> pa.Table:
    """The vectors of one node, or of one part of it, in pages: each belongs to the nearest of some of them."""
    ids, node = held["id"].to_numpy(), int(held["node"][0].as_py())
    order = np.lexsort((ids, held["mixed"].to_numpy()))  # by a hash: the first are a sample
    x = matrix(held["v"].combine_chunks(), tree.width)[order]
    centers = np.unique(x[: -(-len(x) // page)], axis=0)
    home, distance = np.empty(len(x), dtype=np.int64), np.empty(len(x))
    for first in range(0, len(x), 1024):
        d = tree.of_data(x[first : first + 1024], centers)
        home[first : first + 1024], distance[first : first + 1024] = d.argmin(axis=1), d.min(axis=1)
    own = (x == centers[home]).all(axis=1)
    distance[own] = 0.0
    radius = np.zeros(len(centers))
    np.maximum.at(radius, home, distance)
    up = tree.of_data(centers, tree.nodes[[node]])[:, 0]
    place = np.lexsort((distance, ~own, home))  # a page begins with its center
    home, distance = home[place], distance[place]
    back = order[place]
    part = int(held["part"][0].as_py())
    columns = [pa.array(ids[back]), held["v"].take(pa.array(back)), pa.array(np.full(len(x), node, dtype=np.int32)), pa.array(home + (part << 32)), pa.array(distance), pa.array(up[home]), pa.array(radius[home])]
    return pa.table(columns, ["id", "v", "node", "page", "distance", "up", "radius"])


class Pages:
    """The pages of some vectors that lie one page after the other; ``center`` is that of the first one, if it began before."""

    def __init__(self, node, page, distance, up, radius, ids, x, center: np.ndarray | None = None):
        self.distance, self.ids, self.x = distance, ids, x
        begins = np.r_[True, (page[1:] != page[:-1]) | (node[1:] != node[:-1])]
        self.first = np.flatnonzero(begins)
        self.end = np.r_[self.first[1:], len(page)]
        self.node, self.page, self.up, self.radius = node[self.first], page[self.first], up[self.first], radius[self.first]
        self.centers = x[self.first].copy()
        if center is not None:
            self.centers[0] = center


def search_pages(tree: Tree, queries: np.ndarray, query_ids: np.ndarray, limits: np.ndarray, best: Best, held: Pages) -> int:
    """Go through the pages, each query in its own order; the number of products computed."""
    q2 = (queries**2).sum(axis=1)
    slack = 1e-6 * (np.sqrt(q2) + np.sqrt(tree.length2) + 1)

    def reach() -> np.ndarray:
        """The largest distance at which a vector still matters to each query."""
        limit = np.maximum(limits, best.scores[:, -1])
        return np.sqrt(np.maximum(q2 + tree.length2 - 2 * limit, 0)) + slack

    to_nodes = tree.of_queries(queries)
    d = to_nodes[:, held.node]
    bounds = np.maximum(np.abs(d - held.up) - held.radius, d - tree.radii[held.node])
    asked = bounds <= reach()[:, None]
    done = int(asked.sum()) + to_nodes.size
    wanted = np.flatnonzero(asked.any(axis=0))
    to_centers = np.full(bounds.shape, np.inf)
    to_centers[:, wanted] = tree.of_queries(queries, held.centers[wanted])
    bounds = np.where(asked, np.maximum(bounds, to_centers - held.radius), np.inf)
    order = np.argsort(bounds, axis=1, kind="stable")
    seen, width = 0, 1
    while seen < order.shape[1]:
        some = order[:, seen : seen + width]
        limit = reach()
        row, at = np.nonzero(np.take_along_axis(bounds, some, axis=1) <= limit[:, None])
        if not len(row):
            break
        page = some[row, at]
        by_page = np.argsort(page, kind="stable")
        row, page = row[by_page], page[by_page]
        starts = np.flatnonzero(np.r_[True, page[1:] != page[:-1]])
        for a, b in zip(starts, [*starts[1:], len(page)]):
            p, rows = page[a], row[a:b]
            inside = slice(held.first[p], held.end[p])
            near = np.abs(to_centers[rows, p][:, None] - held.distance[None, inside]) <= limit[rows][:, None]
            columns = np.flatnonzero(near.any(axis=0)) + held.first[p]
            if not len(columns):
                continue
            scores = queries[rows] @ held.x[columns].T
            done += scores.size
            scores[query_ids[rows][:, None] == held.ids[columns][None, :]] = -np.inf
            best.add(rows, scores, held.ids[columns])
        seen, width = seen + width, 2 * width
    return done


def nearest(
    vectors: DataFrame,
    queries: Column,
    k: int = 5,
    key: str = "vec_id",
    vector: str = "embedding",
    nodes: int = NODES,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """query_id, rank, ``key``, score: the ``k`` largest inner products of the rows that ``queries`` picks."""
    spark = vectors.sparkSession
    data = vectors.select(F.col(key).cast("long").alias("id"), quantized(F.col(vector)).alias("v"), queries.alias("asked")).where("id is not null and v is not null")
    square = F.aggregate("v", F.lit(0).cast("long"), lambda s, x: s + x * x)
    longest, width, asked, n = data.agg(F.max(square), F.max(F.size("v")), F.sum(F.col("asked").cast("long")), F.count("*")).first()
    empty = "query_id long, rank int, vec_id long, score long"
    if not longest and not width or not asked:
        return spark.createDataFrame([], empty).withColumnRenamed("vec_id", key)
    drawn = data.orderBy(F.xxhash64("id"), "id", "v").limit(min(nodes, math.isqrt(n) + 1)).select("id", "v").collect()  # at most ``nodes`` rows
    sample = matrix([r.v for r in drawn], width)
    tree = Tree(sample, np.array([r.id for r in drawn]), float(longest), width)
    shared = spark.sparkContext.broadcast(tree)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            distances = shared.value.of_data(matrix(batch.column(1), width))
            home = distances.argmin(axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(home.astype(np.int32)), pa.array(distances[np.arange(len(home)), home])],
                ["id", "v", "node", "distance"],
            )

    routed = data.select("id", "v").mapInArrow(route, "id long, v array<bigint>, node int, distance double")
    routed = store(routed)
    found = {r.node: (r.n, r.radius) for r in routed.groupBy("node").agg(F.count("*").alias("n"), F.max("distance").alias("radius")).collect()}  # one per node
    for node, (_, radius) in found.items():
        tree.radii[node] = radius
    shared = spark.sparkContext.broadcast(tree)
    rows = {node: n for node, (n, _) in found.items()}
    parts = F.create_map(*(F.lit(x) for node, n in sorted(rows.items()) for x in (node, -(-n // SPREAD))))
    mixed = F.xxhash64("id", "v").alias("mixed")
    dealt = routed.select("id", "v", "node", mixed, F.pmod(F.xxhash64("id", "v"), parts[F.col("node")]).cast("int").alias("part"))
    tasks = max(1, min(sum(-(-n // SPREAD) for n in rows.values()), sum(rows.values()) // SPREAD + spark.sparkContext.defaultParallelism))
    page = PAGE
    pages = store(dealt.repartition(tasks, "node", "part").groupBy("node", "part").applyInArrow(lambda held: made_pages(shared.value, held, page), PAGES))

    asked_ids = data.where("asked").groupBy("id").agg(F.min("v").alias("v"))
    blocks = -(-asked // query_block)
    found = None
    for block in range(blocks):
        mine = asked_ids.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == block).collect()  # about ``query_block`` rows
        if mine:
            part = _search(pages, shared, [r.id for r in mine], matrix([r.v for r in mine], width), k)
            found = part if found is None else found.union(part)
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias(key), "score")


def _search(pages: DataFrame, shared: Broadcast, ids: list[int], queries: np.ndarray, k: int) -> DataFrame:
    """The best of every task's pages for one block of queries."""
    tree: Tree = shared.value
    query_ids = np.array(ids, dtype=np.int64)
    scores = queries @ tree.nodes.T
    scores[query_ids[:, None] == tree.node_ids[None, :]] = -np.inf
    limits = np.full(len(ids), -np.inf)
    if scores.shape[1] >= k:
        limits = -np.partition(-scores, k - 1, axis=1)[:, k - 1]
    block = pages.sparkSession.sparkContext.broadcast((query_ids, queries, limits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = shared.value
        query_ids, queries, limits = block.value
        best = Best(len(query_ids), k)
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            node, page, distance, up, radius = (batch.column(i).to_numpy() for i in range(2, 7))
            goes_on = last is not None and distance[0] > 0 and (node[0], page[0]) == (last.node[-1], last.page[-1])
            held = last = Pages(node, page, distance, up, radius, batch.column(0).to_numpy(), matrix(batch.column(1), tree.width), last.centers[-1] if goes_on else None)
            for first in range(0, len(query_ids), 1024):
                some = slice(first, first + 1024)
                part = Best(0, k)
                part.scores, part.ids = best.scores[some], best.ids[some]
                search_pages(tree, queries[some], query_ids[some], limits[some], part, held)
        row, column = np.nonzero((best.scores > -np.inf) & (best.scores >= limits[:, None]))
        if len(row):
            yield pa.RecordBatch.from_arrays(
                [pa.array(query_ids[row]), pa.array(best.ids[row, column]), pa.array(best.scores[row, column].astype(np.int64))],
                ["query_id", "id", "score"],
            )

    return pages.mapInArrow(run, "query_id long, id long, score long")
