"""Exact nearest neighbours within each group, without comparing all pairs.

Points are first collapsed to distinct vectors with a copy count, so a vector that occurs very
often costs as much as any other. Each point then belongs to the cell of its nearest pivot, and
the search takes two steps:

1. the neighbours inside the point's own cell give a distance that the true ones cannot exceed;
2. the triangle inequality names the other cells that may hold something nearer, with a least
   distance for each; they are visited in rounds by that distance, until none is left within what
   has been found. Vectors travel only with the visits that are made.

Small cells lie together in blocks: bounds are those of the cells, but a point is sent to a block once,
however many of its cells it has to look into, as each visit carries a vector.

Blocks are cut into chunks, so a task compares two chunks of bounded size whatever the size of a
block, and hands on only the k best per point.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from swipelake.functions.hashing import key_digest, unit_draw
from swipelake.session import remove_folder, stored_at

# Rows per chunk, at most: a task holds two chunks at a time.
CHUNK_ROWS = 16_000
# Rows per cell, at least.
CELL_ROWS = 500
# Blocks per group, at least, where there are as many cells.
MIN_BLOCKS = 16
# Pivots over all groups: they are held by the driver and by every task.
MAX_PIVOTS = 16_384
# Bytes that a chunk, and all pivots together, may have: of wide vectors there are fewer of either.
CHUNK_BYTES = 64 << 20
PIVOT_BYTES = 64 << 20
# Data go to their queries in a part for each so many rows, up to a number of parts, one after the other: a shuffle holds one part.
PART_ROWS, PARTS = 500_000, 4
# Distances held at once, 32 MB.
_CELLS_AT_ONCE = 4_000_000

# A place goes through a dense product where the pairs that have it are more than one in so many.
_DENSE_SHARE = 32

# Room for the rounding errors of the quick distances when cells are ruled out.
_SLACK = 1e-6


class Sparse:
    """Rows of which only the places that aren't zero are held, one row after the other."""

    def __init__(self, starts: np.ndarray, lengths: np.ndarray, places: np.ndarray, values: np.ndarray):
        self.starts, self.lengths, self.places, self.values = starts, lengths, places, values

    @classmethod
    def of(cls, packed: list[np.ndarray]) -> Sparse:
        """From arrays that hold places first, then as many values."""
        lengths = np.array([len(p) // 2 for p in packed], dtype=np.int64)
        half = [(p[: len(p) // 2], p[len(p) // 2 :]) for p in packed]
        places = np.concatenate([h[0] for h in half]) if half else np.empty(0)
        values = np.concatenate([h[1] for h in half]) if half else np.empty(0)
        return cls(np.cumsum(lengths) - lengths, lengths, places.astype(np.int64), values.astype(np.float64))

    def __len__(self) -> int:
        return len(self.starts)

    def __getitem__(self, rows) -> Sparse:
        return Sparse(self.starts[rows], self.lengths[rows], self.places, self.values)

    def entries(self, rows: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(number of the row, place, value) of all entries of these rows."""
        starts, lengths = (self.starts, self.lengths) if rows is None else (self.starts[rows], self.lengths[rows])
        at = np.arange(lengths.sum()) + np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)
        return np.repeat(np.arange(len(starts)), lengths), self.places[at], self.values[at]

    def squares(self) -> np.ndarray:
        row, _, value = self.entries()
        return np.bincount(row, value * value, len(self))

    def products(self, other: Sparse) -> np.ndarray:
        """Inner products of all rows with all rows: places that many rows of both have go through a dense product,
        the others add up pair by pair."""
        row, place, value = self.entries()
        o_row, o_place, o_value = other.entries()
        both, place = np.unique(place, return_inverse=True)
        at = np.searchsorted(both, o_place)
        known = (at < len(both)) & (both[np.minimum(at, len(both) - 1)] == o_place) if len(both) else np.zeros(len(o_place), dtype=bool)
        o_row, o_place, o_value = o_row[known], at[known], o_value[known]
        mine, theirs = np.bincount(place, minlength=len(both)), np.bincount(o_place, minlength=len(both))
        often = mine * theirs * _DENSE_SHARE > len(self) * len(other)
        number = np.cumsum(often) - 1
        a, b = np.zeros((len(self), int(often.sum()))), np.zeros((len(other), int(often.sum())))
        a[row[often[place]], number[place[often[place]]]] = value[often[place]]
        b[o_row[often[o_place]], number[o_place[often[o_place]]]] = o_value[often[o_place]]
        out = a @ b.T
        rare, o_rare = ~often[place], ~often[o_place]
        row, place, value = row[rare], place[rare], value[rare]
        order = np.argsort(o_place[o_rare], kind="stable")
        o_row, o_value = o_row[o_rare][order], o_value[o_rare][order]
        first = np.cumsum(theirs * ~often) - theirs * ~often
        times = theirs[place]
        ends, done = np.cumsum(times), 0
        while done < len(row):
            last = max(done + 1, int(np.searchsorted(ends, (ends[done - 1] if done else 0) + _CELLS_AT_ONCE, "right")))
            n = times[done:last]
            at = np.arange(n.sum()) + np.repeat(first[place[done:last]] - (np.cumsum(n) - n), n)
            np.add.at(out, (np.repeat(row[done:last], n), o_row[at]), np.repeat(value[done:last], n) * o_value[at])
            done = last
        return out

    def apart(self, rows: np.ndarray, other: Sparse, cols: np.ndarray) -> np.ndarray:
        """Squared distances of pairs of rows, from their differences."""
        pair, place, value = self.entries(rows)
        o_pair, o_place, o_value = other.entries(cols)
        pair, place, value = np.r_[pair, o_pair], np.r_[place, o_place], np.r_[value, -o_value]
        order = np.lexsort((place, pair))
        pair, place, value = pair[order], place[order], value[order]
        starts = np.flatnonzero(np.r_[True, (np.diff(pair) != 0) | (np.diff(place) != 0)]) if len(pair) else np.empty(0, dtype=np.int64)
        difference = np.add.reduceat(value, starts) if len(pair) else value
        return np.bincount(pair[starts], difference * difference, len(rows))


Points = np.ndarray | Sparse


def _squares(a: Points) -> np.ndarray:
    return a.squares() if isinstance(a, Sparse) else (a * a).sum(1)


def _products(a: Points, b: Points) -> np.ndarray:
    return a.products(b) if isinstance(a, Sparse) else a @ b.T


def _apart(a: Points, rows: np.ndarray, b: Points, cols: np.ndarray) -> np.ndarray:
    return a.apart(rows, b, cols) if isinstance(a, Sparse) else ((a[rows] - b[cols]) ** 2).sum(1)


@dataclass
class _Cells:
    """Pivots of one group, with the nearest and farthest member of each cell and the block it lies in (by default its own)."""

    pivots: Points
    near: np.ndarray | None = None
    far: np.ndarray | None = None
    blocks: np.ndarray | None = None

    def __post_init__(self):
        if self.blocks is None:
            self.blocks = np.arange(len(self.pivots), dtype=np.int32)


def _distances(a: Points, b: Points) -> np.ndarray:
    squared = _squares(a)[:, None] + _squares(b)[None, :] - 2.0 * _products(a, b)
    return np.sqrt(np.maximum(squared, 0.0))


def _rows(column, sparse: bool) -> Points:
    """Arrays as rows: all values, or places and values (see ``distinct_points``)."""
    held = [np.asarray(v, dtype=np.float64) for v in column]
    return Sparse.of(held) if sparse else np.stack(held)


def _row_blocks(rows: int, columns: int):
    """Slices of rows for which a matrix with that many columns stays small."""
    step = max(1, _CELLS_AT_ONCE // max(columns, 1))
    return [slice(i, min(i + step, rows)) for i in range(0, rows, step)]


def nearest_in_chunk(queries: Points, data: Points, ids: np.ndarray, own: np.ndarray, k: int):
    """(query row, data row, distance) of the k nearest data rows of each query, the query's own
    row left out; ties go to the smaller id."""
    parts = []
    for block in _row_blocks(len(queries), len(data)):
        rows, cols, dist = _nearest(queries[block], data, ids, own[block], k)
        parts.append((rows + block.start, cols, dist))
    return tuple(np.concatenate(column) for column in zip(*parts))


def _nearest(queries: Points, data: Points, ids: np.ndarray, own: np.ndarray, k: int):
    """The quick matrix form only short-lists, with room for its rounding error; the short list
    is measured again directly."""
    own_squares, squares = _squares(queries), _squares(data)
    quick = own_squares[:, None] + squares[None, :] - 2.0 * _products(queries, data)
    same = ids[None, :] == own[:, None]
    quick[same] = np.inf
    take = min(k, len(data))
    kth = np.partition(quick, take - 1, axis=1)[:, take - 1]
    size = own_squares + squares.max()
    rows, cols = np.nonzero((quick <= (kth + 1e-10 * size)[:, None]) & ~same)
    if not len(rows):
        return rows, cols, np.empty(0)
    dist = np.sqrt(_apart(queries, rows, data, cols))
    order = np.lexsort((ids[cols], dist, rows))
    rows, cols, dist = rows[order], cols[order], dist[order]
    starts = np.r_[0, np.flatnonzero(np.diff(rows)) + 1]
    place = np.arange(len(rows)) - np.repeat(starts, np.diff(np.r_[starts, len(rows)]))
    keep = place < k
    return rows[keep], cols[keep], dist[keep]


def distinct_points(df: DataFrame, group: str, key: str, vector: str) -> DataFrame:
    """(grp, pid, vec, copies): one row per distinct vector of a group, named by its smallest key.

    A vector is an array of its values. For sparse search it is an array of the places that aren't zero,
    ascending, followed by as many values (``packed``). Keys are whole numbers. A vector that is null, or holds a null or NaN, fails the query with its key.
    """
    fine = F.col(vector).isNotNull() & F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v))
    wrong = F.raise_error(F.concat(F.lit("no usable vector at key "), F.coalesce(F.col(key).cast("string"), F.lit("null"))))
    vec = F.when(fine, F.transform(F.col(vector), lambda v: v.cast("double"))).otherwise(wrong.cast("array<double>"))
    return (
        df.select(F.col(group).alias("grp"), F.col(key).cast("bigint").alias("pid"), vec.alias("vec"))
        .groupBy("grp", "vec")
        .agg(F.min("pid").alias("pid"), F.count("*").alias("copies"))
    )


def _choose_pivots(points: DataFrame, group_rows: dict, cell_rows: int, sparse: bool) -> dict:
    """Pivots per group: its first point in digest order, and about one more for every
    ``cell_rows`` points, drawn by key digest."""
    spark = points.sparkSession
    kind = T.StructType([points.schema["grp"], T.StructField("chance", T.DoubleType())])
    chances = [(g, -(-n // cell_rows) / n) for g, n in group_rows.items()]
    digest = key_digest("pid")
    drawn = points.join(spark.createDataFrame(chances, kind), "grp").where(unit_draw(digest) < F.col("chance"))
    first = points.groupBy("grp").agg(F.min_by(F.struct("pid", "vec"), digest).alias("p")).select("grp", "p.*")
    pivots: dict = {}
    for row in drawn.select("grp", "pid", "vec").union(first).distinct().orderBy("pid").collect():
        pivots.setdefault(row["grp"], []).append(row["vec"])
    return {g: _Cells(_rows(v, sparse)) for g, v in pivots.items()}


def _into_blocks(cells: _Cells, blocks: int) -> None:
    """Each cell goes to the block of the nearest of some of the pivots."""
    pivots = cells.pivots
    if blocks < len(pivots):
        heads = pivots[np.arange(blocks) * len(pivots) // blocks]
        cells.blocks = np.concatenate([_distances(pivots[rows], heads).argmin(1) for rows in _row_blocks(len(pivots), blocks)]).astype(np.int32)


def _assign_cells(points: DataFrame, cells: dict, sparse: bool) -> tuple[DataFrame, str]:
    """The points with their cell, its distance and its block, stored, and their folder."""
    shared = points.sparkSession.sparkContext.broadcast(cells)

    def assign(batches):
        for pdf in batches:
            for grp, part in pdf.groupby("grp", sort=False):
                vectors, pivots = _rows(part["vec"], sparse), shared.value[grp].pivots
                cell = np.empty(len(part), dtype="int32")
                radius = np.empty(len(part))
                for block in _row_blocks(len(part), len(pivots)):
                    d = _distances(vectors[block], pivots)
                    cell[block] = d.argmin(1)
                    radius[block] = d.min(1)
                yield part.assign(cell=cell, radius=radius, block=shared.value[grp].blocks[cell])

    more = (T.StructField("cell", T.IntegerType()), T.StructField("radius", T.DoubleType()), T.StructField("block", T.IntegerType()))
    placed = stored_at(points.mapInPandas(assign, T.StructType([*points.schema.fields, *more])))
    shared.destroy()
    return placed


def _compare(queries: DataFrame, data: DataFrame, sizes: DataFrame, k: int, chunk_rows: int, sparse: bool = False, few_cells: bool = True) -> DataFrame:
    """The k nearest rows of ``data`` per query row and cell; ``queries`` name the cell to look in.

    ``few_cells`` says that there are at most MAX_PIVOTS of them and one per group; else Spark chooses the joins."""

    def chunks(n):
        return F.greatest(F.ceil(n / F.lit(chunk_rows)), F.lit(1)).cast("int")

    asked = queries.groupBy("grp", "cell").agg(F.count("*").alias("asked"))
    plan = sizes.join(F.broadcast(asked) if few_cells else asked, ["grp", "cell"]).select(
        "grp", "cell", chunks(F.col("n")).alias("d_chunks"), chunks(F.col("asked")).alias("q_chunks")
    )
    plan = F.broadcast(plan) if few_cells else plan

    def chunk_no(count):
        return F.pmod(F.xxhash64("pid"), F.col(count)).cast("int")

    def others(count):
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    left = queries.join(plan, ["grp", "cell"]).select(
        "grp", "cell", chunk_no("q_chunks").alias("q_chunk"), others("d_chunks").alias("d_chunk"), "pid", "vec"
    )
    # both sides may be the same stored table: fresh names keep the columns apart
    right = data.join(plan, ["grp", "cell"]).select(
        F.col("grp").alias("d_grp"),
        F.col("cell").alias("d_cell"),
        others("q_chunks").alias("q_chunk"),
        chunk_no("d_chunks").alias("d_chunk"),
        F.col("pid").alias("near_pid"),
        F.col("vec").alias("near_vec"),
        F.col("copies").alias("near_copies"),
    )
    schema = T.StructType(
        [
            T.StructField("grp", queries.schema["grp"].dataType),
            T.StructField("pid", T.LongType()),
            T.StructField("near_pid", T.LongType()),
            T.StructField("near_copies", T.LongType()),
            T.StructField("dist", T.DoubleType()),
        ]
    )

    def search(q: pd.DataFrame, d: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(d):
            return pd.DataFrame({f.name: [] for f in schema.fields})
        own, ids = q["pid"].to_numpy(), d["near_pid"].to_numpy()
        rows, cols, dist = nearest_in_chunk(_rows(q["vec"], sparse), _rows(d["near_vec"], sparse), ids, own, k)
        return pd.DataFrame(
            {
                "grp": q["grp"].to_numpy()[rows],
                "pid": own[rows],
                "near_pid": ids[cols],
                "near_copies": d["near_copies"].to_numpy()[cols],
                "dist": dist,
            }
        )

    asking = left.groupBy("grp", "cell", "q_chunk", "d_chunk")
    answering = right.groupBy("d_grp", "d_cell", "q_chunk", "d_chunk")
    return asking.cogroup(answering).applyInPandas(search, schema)


def _compared(queries: DataFrame, data: DataFrame, sizes: DataFrame, rows: int, k: int, chunk_rows: int, sparse: bool) -> tuple[DataFrame, list[str]]:
    """The same from parts of the data, so that they never lie in a shuffle as a whole, and the folders where it is stored, if any."""
    parts = min(PARTS, -(-rows // PART_ROWS))
    if parts < 2:
        return _compare(queries, data, sizes, k, chunk_rows, sparse), []
    found, sizes = [], sizes.withColumn("n", F.ceil(F.col("n") / parts))
    for i in range(parts):
        mine = data.where(F.pmod(F.hash("pid"), F.lit(parts)) == i)
        found.append(stored_at(_best(_compare(queries, mine, sizes, k, chunk_rows, sparse), k)))
    return functools.reduce(DataFrame.unionByName, [df for df, _ in found]), [folder for _, folder in found]


def _best(found: DataFrame, k: int) -> DataFrame:
    nearest = Window.partitionBy("grp", "pid").orderBy("dist", "near_pid")
    return found.withColumn("place", F.row_number().over(nearest)).where(F.col("place") <= k).drop("place")


def open_cells(vectors: Points, own: np.ndarray, reach: np.ndarray, cells: _Cells):
    """(row, cell) of the other cells that may hold a point within reach of the row."""
    return bounded_cells(vectors, own, reach, cells)[:2]


def bounded_cells(vectors: Points, own: np.ndarray, reach: np.ndarray, cells: _Cells):
    """(row, cell, least distance) of the other cells that may hold a point within reach of the row.

    A cell is ruled out when all its points are farther than reach: by the distances of its
    nearest and farthest member from its pivot, or because its points lie beyond the plane
    half-way between the two pivots.
    """
    d = _distances(vectors, cells.pivots)
    mine = d[np.arange(len(d)), own][:, None]
    apart = _distances(cells.pivots[own], cells.pivots)
    scale = 1.0 + np.sqrt(_squares(vectors))[:, None] + d
    # pivots almost on top of each other give no reliable plane
    plane = np.divide(d * d - mine * mine, 2.0 * apart, out=np.zeros_like(d), where=apart > 1e-4 * scale)
    least = np.maximum.reduce([d - cells.far[None, :], cells.near[None, :] - d, plane])
    limit = reach[:, None]
    least = least - _SLACK * scale
    possible = least <= limit
    possible[np.arange(len(d)), own] = False
    rows, targets = np.nonzero(possible & np.isfinite(cells.far)[None, :])
    return rows, targets, least[rows, targets]


def _route(points: DataFrame, reach: DataFrame, cells: dict, sparse: bool) -> tuple[DataFrame, str]:
    """(grp, block, pid, least, turn), stored, and their folder: each other block with a cell that may hold a point within reach, and how far
    the nearest one there is at least. No vectors: most of these pairs never come to a comparison."""
    shared = points.sparkSession.sparkContext.broadcast(cells)
    asked = points.join(reach, ["grp", "pid"], "left").withColumn(
        "reach", F.coalesce("reach", F.lit(float("inf")))
    )

    def route(batches):
        for pdf in batches:
            for grp, part in pdf.groupby("grp", sort=False):
                known = shared.value[grp]
                vectors, own, limit = _rows(part["vec"], sparse), part["cell"].to_numpy(), part["reach"].to_numpy()
                for some in _row_blocks(len(part), len(known.pivots)):
                    rows, targets, least = bounded_cells(vectors[some], own[some], limit[some], known)
                    nearest = np.full((len(own[some]), known.blocks.max() + 1), np.inf)
                    np.minimum.at(nearest, (rows, known.blocks[targets]), least)
                    nearest[np.arange(len(nearest)), known.blocks[own[some]]] = np.inf
                    rows, blocks = np.nonzero(nearest < np.inf)
                    yield pd.DataFrame(
                        {
                            "grp": part["grp"].to_numpy()[some][rows],
                            "block": blocks.astype("int32"),
                            "pid": part["pid"].to_numpy()[some][rows],
                            "least": nearest[rows, blocks],
                        }
                    )

    kinds = {f.name: f for f in points.schema.fields}
    schema = T.StructType([*(kinds[c] for c in ("grp", "block", "pid")), T.StructField("least", T.DoubleType())])
    by_bound = Window.partitionBy("grp", "pid").orderBy("least", "block")
    routed = stored_at(asked.mapInPandas(route, schema).withColumn("turn", F.row_number().over(by_bound)))
    shared.destroy()
    return routed


def _reach(best: DataFrame, k: int) -> DataFrame:
    """How far a point's neighbours can be at most, by those found."""
    return best.groupBy("grp", "pid").agg(
        F.when(F.count("*") >= k, F.max("dist")).otherwise(F.lit(float("inf"))).alias("reach")
    )


def _in_rounds(
    placed: DataFrame, wanted: str, best: DataFrame, earlier: str, routed: DataFrame, sizes: DataFrame, rows: int, k: int, chunk_rows: int, sparse: bool
) -> DataFrame:
    """Look into the other blocks (``cell`` of ``placed`` and ``sizes``), nearest bounds first, twice as many in each round. After each
    the reach of a point is tighter, and blocks beyond it are passed over. ``earlier`` is the folder of ``best``,
    ``rows`` the number of points."""
    vectors = placed.where(wanted).select("grp", "pid", "vec")
    done, width = 0, 1
    while True:
        left = routed.where(F.col("turn") > done).join(_reach(best, k), ["grp", "pid"], "left")
        left = left.where(F.col("reach").isNull() | (F.col("least") <= F.col("reach")))
        if not left.head(1):
            return best
        now, folder = stored_at(left.where(F.col("turn") <= done + width).select("grp", "pid", F.col("block").alias("cell")))
        asked = now.join(vectors, ["grp", "pid"]).select("grp", "cell", "pid", "vec")
        found, folders = _compared(asked, placed, sizes, rows, k, chunk_rows, sparse)
        best, latest = stored_at(_best(best.unionByName(found), k))
        for old in (folder, *folders, earlier):
            remove_folder(placed.sparkSession, old)
        earlier = latest
        done, width = done + width, 2 * width


def _fitting(rows: int, width: int, limit: int) -> int:
    """At most ``rows`` vectors of that width within a number of bytes, and one at least."""
    return max(1, min(rows, limit // (8 * max(width, 1))))


def _cell_rows(points: DataFrame, total: int, pivots: int) -> int:
    """Small cells for a good spread over the cores; large ones once there are many rows, as a
    point is sent to each cell it has to be compared with."""
    spread = total // (4 * points.sparkSession.sparkContext.defaultParallelism)
    return max(min(max(spread, CELL_ROWS), CHUNK_ROWS), -(-total // pivots))


def nearest_neighbours(
    points: DataFrame,
    k: int,
    wanted: str = "true",
    cell_rows: int | None = None,
    chunk_rows: int = CHUNK_ROWS,
    sparse: bool = False,
) -> DataFrame:
    """(grp, pid, near_pid, near_copies, dist): the k nearest other vectors of the same group,
    for the points that meet the condition ``wanted``.

    ``points`` come from ``distinct_points`` and are stored, as they are read several times. With ``sparse``
    their vectors are packed and are never unfolded.
    """
    groups = points.groupBy("grp").agg(F.count("*").alias("n"))
    widths = points.groupBy("grp").agg(F.count("*").alias("n"), F.min(F.size("vec")).alias("low"), F.max(F.size("vec")).alias("high"))
    found = widths.collect()  # one row per class
    if uneven := [r["grp"] for r in found if r["low"] != r["high"] and not sparse]:
        raise ValueError(f"vectors of different lengths in group {uneven[0]!r}")
    group_rows = {r["grp"]: r["n"] for r in found}
    width = max((r["high"] for r in found), default=1)
    chunk_rows = _fitting(chunk_rows, width, CHUNK_BYTES)
    pivots = _fitting(MAX_PIVOTS, width, PIVOT_BYTES)
    block_rows = _cell_rows(points, sum(group_rows.values()), pivots)
    cell_rows = max(cell_rows, -(-sum(group_rows.values()) // pivots)) if cell_rows else block_rows
    if max(group_rows.values(), default=0) <= cell_rows:  # one cell per group
        placed = points.withColumn("cell", F.lit(0))
        sizes = groups.withColumn("cell", F.lit(0))
        found, _ = _compared(placed.where(wanted), placed, sizes, sum(group_rows.values()), k, chunk_rows, sparse)
        return _best(found, k)
    cells = _choose_pivots(points, group_rows, cell_rows, sparse)
    for grp, c in cells.items():
        _into_blocks(c, len(c.pivots) if cell_rows >= block_rows else max(MIN_BLOCKS, -(-group_rows[grp] // block_rows)))
    placed, points_folder = _assign_cells(points, cells, sparse)
    edges = placed.groupBy("grp", "cell").agg(F.min("radius").alias("near"), F.max("radius").alias("far"))
    in_blocks = placed.drop("cell", "radius").withColumnRenamed("block", "cell")
    sizes = in_blocks.groupBy("grp", "cell").agg(F.count("*").alias("n"))
    rows = sum(group_rows.values())
    found, folders = _compared(in_blocks.where(wanted), in_blocks, sizes, rows, k, chunk_rows, sparse)
    best, best_folder = stored_at(_best(found, k))
    for folder in folders:
        remove_folder(points.sparkSession, folder)
    for c in cells.values():  # a cell that got no points keeps an infinite edge and is not visited
        c.near, c.far = np.full(len(c.pivots), -np.inf), np.full(len(c.pivots), np.inf)
    for row in edges.collect():  # one small row per cell
        c = cells[row["grp"]]
        c.near[row["cell"]], c.far[row["cell"]] = row["near"], row["far"]
    routed, routes_folder = _route(placed.where(wanted), _reach(best, k), cells, sparse)
    best = _in_rounds(in_blocks, wanted, best, best_folder, routed, sizes, rows, k, chunk_rows, sparse)
    for folder in (points_folder, routes_folder):
        remove_folder(points.sparkSession, folder)
    return best
