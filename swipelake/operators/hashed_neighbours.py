"""Near neighbours by random projections: a documented choice beside the exact search of ``neighbours``.

Every table draws some directions; a point's cell in it is the step of its projection on each of them. Points are compared with those
that share a cell in some table, in the chunks of the exact search, so a cell of any size is spread over tasks. What is returned are
true distances; what may be missing are neighbours that share no cell.

It pays where neighbours are much nearer than other points are: there a narrow ``spread`` and more directions compare a few
points with each. Vectors without structure need wide steps for a good recall, and then it does more work than the exact search.
``recall`` measures it.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from swipelake.operators.neighbours import CHUNK_BYTES, CHUNK_ROWS, _best, _compare, _fitting, _rows
from swipelake.session import cut_lineage

TABLES = 8
DIRECTIONS = 2
SPREAD = 2.0  # width of a step, in deviations of the projections
SEED = 42


def _directions(width: int, tables: int, directions: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Directions of all tables, and where each one's steps begin."""
    drawn = np.random.default_rng(seed)
    return drawn.normal(size=(width, tables * directions)), drawn.random(tables * directions)


def _step(points: DataFrame, width: int, spread: float) -> float:
    """The deviation of a projection on a direction whose parts are drawn with deviation 1, times ``spread``: from the variances of
    the places, which one pass sums up."""
    at = F.posexplode("vec").alias("place", "value")
    variance = points.select(at).groupBy("place").agg(F.var_pop("value").alias("v")).agg(F.sum("v")).first()[0]
    return spread * float(np.sqrt(variance or 0.0)) or 1.0


def hashed_neighbours(
    points: DataFrame, k: int, wanted: str = "true", tables: int = TABLES, directions: int = DIRECTIONS, spread: float = SPREAD, seed: int = SEED, chunk_rows: int = CHUNK_ROWS
) -> DataFrame:
    """(grp, pid, near_pid, near_copies, dist): up to ``k`` near vectors of the same group, for the points that meet ``wanted``.

    ``points`` come from ``distinct_points`` with all their values, and are stored.
    """
    edge = points.agg(F.min(F.size("vec")).alias("low"), F.max(F.size("vec")).alias("high")).first()
    if edge["low"] != edge["high"]:
        raise ValueError(f"vectors of {edge['low']} and of {edge['high']} places")
    width = edge["high"] or 1
    step = _step(points, width, spread)

    def place(batches):
        axes, begin = _directions(width, tables, directions, seed)
        weights = np.random.default_rng(seed + 1).integers(1, 2**62, size=directions) | 1
        for pdf in batches:
            if not len(pdf):
                continue
            steps = np.floor(_rows(pdf["vec"], False) @ axes / step + begin).astype(np.int64).reshape(len(pdf), tables, directions)
            with np.errstate(over="ignore"):
                cells = (steps * weights).sum(2) * tables + np.arange(tables)  # a cell that two places share only has more to compare
            for t in range(tables):
                yield pdf[["grp", "pid", "vec", "copies"]].assign(cell=cells[:, t])

    kinds = {f.name: f for f in points.schema.fields}
    schema = T.StructType([*(kinds[c] for c in ("grp", "pid", "vec", "copies")), T.StructField("cell", T.LongType())])
    placed = cut_lineage(points.mapInPandas(place, schema))
    asking = points.where(wanted).select("grp", F.col("pid").alias("asked"))
    asked = placed.join(asking, [placed["grp"].eqNullSafe(asking["grp"]), placed["pid"] == asking["asked"]], "left_semi")
    sizes = placed.groupBy("grp", "cell").agg(F.count("*").alias("n"))
    found = _compare(asked, placed, sizes, k, _fitting(chunk_rows, width, CHUNK_BYTES), few_cells=False)
    return _best(found.dropDuplicates(["grp", "pid", "near_pid"]), k)


def recall(exact: DataFrame, hashed: DataFrame) -> DataFrame:
    """One row: exact neighbours, and the share of them that was found. Equal distances count as found."""
    worst = hashed.groupBy("grp", "pid").agg(F.sort_array(F.collect_list("dist")).alias("dists"))  # at most k
    near = exact.groupBy("grp", "pid").agg(F.sort_array(F.collect_list("dist")).alias("wanted"))
    both = near.join(worst, ["grp", "pid"], "left")
    limit = F.element_at("wanted", -1)
    hits = F.coalesce(F.size(F.filter("dists", lambda d: d <= limit + 1e-9)), F.lit(0))
    return both.agg(F.sum(F.size("wanted")).alias("neighbours"), (F.sum(hits) / F.sum(F.size("wanted"))).alias("recall"))
