"""Quality rules: counts of each text, fixed limits, and robust multivariate outliers.

Rows that pass the fixed limits get a vector of transformed statistics. For each language and source
the minimum-covariance-determinant estimate is found by concentration steps: from a start by the shortest
halves, the H share of rows with the smallest Mahalanobis distances gives the next mean and covariance,
until the determinant falls no more. Each step is two aggregations over narrow rows, for all cells at
once: a histogram of distances on a fixed logarithmic grid, whose bin holding the H share is the edge, and
sums of products within that edge, where the rows of the edge bin share the weight that is left. No cell
is ever gathered, so one source may hold any share of the rows. Rows with equal statistics count once in
the estimate, so copies have no more say than one row. A row is rejected when its distance under the last
estimate is beyond the chi-square limit.

A language and source with under MIN_ROWS rows share a cell with the other small sources of the
language, and small languages one cell. A cell that stays smaller than that, or has fewer different rows,
has no distance of its own; its rows are rejected by the estimate over all rows. Tables with fewer
different rows reject nothing.

Cases: null texts have no words and fail the fixed limits. Null languages and sources are values of
their own. Rows that repeat are judged each. An empty table gives no rows. A statistic that is nearly
constant in a cell gets the variance floor, so the covariance can always be inverted.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from swipelake.llm.common import small, store

SPACES = b" \t\n\r\x0b\x0c"
SYMBOLS = b"#*$%&|<>"
CAPITALS = bytes(range(65, 91))
EMPHASIS = b"!?"
DIMENSIONS = 6
H = 0.52  # just above half: nearly half of a cell may be bad
STEPS = 20  # at most; they end when no determinant falls
MIN_ROWS = 200
START = 20  # steps of the percentiles that the start is taken from
BINS = 32  # of the distance histogram, per doubling
TAIL = 1e-8  # share of well-behaved rows beyond the limit
MIN_WORDS = 50
MAX_REPEATED = 0.5
# Least standard deviations: word length (log), symbols, repeated words, repeated lines, capitals, emphasis.
FLOORS = (0.08, 0.05, 0.08, 0.1, 0.06, 0.05)

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
ALL = "all"  # the cell of all rows; other names are JSON or "rest"
STATS = tuple(f"x{i}" for i in range(DIMENSIONS))


def measure(text: str) -> tuple:
    """The five counts of a text and its vector of transformed statistics."""
    raw = text.encode("utf-8", "replace")
    words = raw.split()
    n = len(words)
    blanks = len(raw) - len(raw.translate(None, SPACES))
    chars = len(text) - blanks
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    lines = repeated_lines = 0
    seen: set[str] = set()
    for line in raw.split(b"\n"):
        if line.strip():
            lines += 1
            if line in seen:
                repeated_lines += 1
            seen.add(line)
    repeated = 0
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) < len(windows):
        counts = Counter(windows)
        until = 0
        for i, window in enumerate(windows):
            if counts[window] > 1:
                repeated += i + 3 - max(until, i)
                until = i + 3
    capitals = len(raw) - len(raw.translate(None, CAPITALS))
    emphasis = len(raw) - len(raw.translate(None, EMPHASIS))
    k = max(n, 1)
    stats = (
        math.log(max(chars, 1) / k),
        math.log1p(symbols / k),
        repeated / k,
        repeated_lines / max(lines, 1),
        math.sqrt(max(0.0, capitals / max(chars, 1))),
        math.log1p(emphasis / k),
    )
    return (n, chars, symbols, repeated_lines, repeated, *stats)


def counts(docs: DataFrame, key: str, text: str, lang: str, source: str) -> DataFrame:
    """key, lang, source, the counts and the statistics of every row."""
    frame = docs.select(F.col(key), F.col(lang).alias("lang"), F.col(source).alias("source"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    kept = frame.drop("text").schema
    names = [*kept.names, *COUNTS, *STATS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [measure(t.as_py()) for t in batch.column(len(kept.names))]
            columns = list(zip(*rows)) or [()] * (len(COUNTS) + DIMENSIONS)
            types = [pa.int64()] * len(COUNTS) + [pa.float64()] * DIMENSIONS
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(len(kept.names))] + [pa.array(c, t) for c, t in zip(columns, types)], names
            )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return frame.mapInArrow(run, schema + "".join(f", {c} long" for c in COUNTS) + "".join(f", {c} double" for c in STATS))


def chi2_share(x: float, freedom: int) -> float:
    """Share of a chi-square distribution below ``x``, for an even number of degrees of freedom."""
    term, total = 1.0, 1.0
    for i in range(1, freedom // 2):
        term *= x / 2 / i
        total += term
    return 1 - math.exp(-x / 2) * total


def chi2_limit(tail: float, freedom: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if 1 - chi2_share(mid, freedom) > tail else (low, mid)
    return high


def cells(stats: DataFrame, min_rows: int) -> DataFrame:
    """Add ``cell``: language and source, or what small ones are pooled in."""
    one = F.to_json(F.struct(F.lit(1).alias("k"), "lang", "source"))
    two = F.to_json(F.struct(F.lit(2).alias("k"), "lang"))
    sizes = stats.groupBy("lang", "source").agg(F.count("*").alias("rows"))
    pooled = sizes.withColumn("rows2", F.sum(F.when(F.col("rows") < min_rows, F.col("rows"))).over(Window.partitionBy("lang")))
    named = pooled.select(
        F.col("lang").alias("cell_lang"),
        F.col("source").alias("cell_source"),
        F.when(F.col("rows") >= min_rows, one).when(F.col("rows2") >= min_rows, two).otherwise(F.lit("rest")).alias("cell"),
    )
    same = F.col("lang").eqNullSafe(F.col("cell_lang")) & F.col("source").eqNullSafe(F.col("cell_source"))
    return stats.join(small(store(named)), same).drop("cell_lang", "cell_source")


def distance(mean: str = "mean", inverse: str = "inverse") -> Column:
    """Squared Mahalanobis distance of the statistics from ``mean`` under ``inverse``."""
    off = [F.col(c) - F.col(mean)[i] for i, c in enumerate(STATS)]
    total = F.lit(0.0)
    for i in range(DIMENSIONS):
        for j in range(i, DIMENSIONS):
            total = total + off[i] * off[j] * F.col(inverse)[i * DIMENSIONS + j] * (1.0 if i == j else 2.0)
    return F.when(total < 0, 0.0).otherwise(total)  # null without an estimate


def grid(d: Column) -> Column:
    return F.floor(F.log2(d + F.lit(1e-12)) * BINS).cast("int")


def estimates(sums: DataFrame, scale: float) -> DataFrame:
    """cell, mean, inverse, spread (log of the covariance's determinant) from counts, sums and sums of products."""
    p, floors = DIMENSIONS, np.square(FLOORS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            means, inverses, spreads = [], [], []
            for n, first, second in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3))):
                mean = np.array(first) / n
                cov = np.zeros((p, p))
                cov[np.triu_indices(p)] = np.array(second) / n
                cov = cov + np.triu(cov, 1).T - np.outer(mean, mean)
                cov = cov * scale
                cov[np.diag_indices(p)] = np.maximum(cov.diagonal(), 0) + floors
                means.append(mean.tolist())
                inverses.append(np.linalg.inv(cov).ravel().tolist())
                spreads.append(float(np.linalg.slogdet(cov)[1]))
            kind = pa.list_(pa.float64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(means, kind), pa.array(inverses, kind), pa.array(spreads, pa.float64())],
                ["cell", "mean", "inverse", "spread"],
            )

    return sums.mapInArrow(run, "cell string, mean array<double>, inverse array<double>, spread double")


def fit(stats: DataFrame, share: float = H, steps: int = STEPS, min_rows: int = MIN_ROWS) -> DataFrame:
    """cell, mean, inverse for each cell with at least ``min_rows`` rows."""
    edge = chi2_limit(1 - share, DIMENSIONS)
    scale = share / chi2_share(edge, DIMENSIONS + 2)
    grades = [k / START for k in range(START + 1)]
    ranks = stats.groupBy("cell").agg(F.count("*").alias("rows"), *(F.percentile_approx(c, grades, 2000).alias(c) for c in STATS))

    def shortest(c: str) -> Column:
        """Length, start and end of the shortest stretch that holds half of the rows."""
        halves = [F.struct((F.col(c)[k + START // 2] - F.col(c)[k]).alias("length"), F.col(c)[k].alias("low"), F.col(c)[k + START // 2].alias("high")) for k in range(START // 2 + 1)]
        return F.array_min(F.array(*halves))

    half = [shortest(c) for c in STATS]
    spread = [F.greatest(half[i]["length"] / 1.349, F.lit(FLOORS[i])) for i in range(DIMENSIONS)]
    diagonal = [1 / (spread[i] * spread[i]) if i == j else F.lit(0.0) for i in range(DIMENSIONS) for j in range(DIMENSIONS)]
    model = store(
        ranks.where(F.col("rows") >= min_rows).select(
            "cell", "rows", F.array(*((h["low"] + h["high"]) / 2 for h in half)).alias("mean"), F.array(*diagonal).alias("inverse")
        )
    )
    weight = F.when(F.col("bin") < F.col("edge"), 1.0).otherwise(F.col("part"))
    products = [F.sum(F.col("weight") * F.col(STATS[i]) * F.col(STATS[j])) for i in range(DIMENSIONS) for j in range(i, DIMENSIONS)]
    up_to = Window.partitionBy("cell").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    sizes = model.select("cell", "rows")
    fell = None
    for _ in range(steps):
        edges = (
            stats.join(small(model.select("cell", "mean", "inverse")), "cell")
            .groupBy("cell", grid(distance()).alias("bin"))
            .agg(F.count("*").alias("n"))
            .withColumn("before", F.coalesce(F.sum("n").over(up_to), F.lit(0)))
            .join(sizes, "cell")
            .where(F.col("before") < F.col("rows") * share)
            .withColumn("part", F.least(F.lit(1.0), (F.col("rows") * share - F.col("before")) / F.col("n")))
            .groupBy("cell")
            .agg(F.max(F.struct("bin", "part")).alias("last"))
            .select("cell", F.col("last.bin").alias("edge"), F.col("last.part").alias("part"))
        )
        bounded = store(model.select("cell", "mean", "inverse").join(edges, "cell"))
        sums = (
            stats.join(small(bounded), "cell")
            .withColumn("bin", grid(distance()))
            .where("bin <= edge")
            .withColumn("weight", weight)
            .groupBy("cell")
            .agg(F.sum("weight").alias("n"), F.array(*(F.sum(F.col("weight") * F.col(c)) for c in STATS)).alias("first"), F.array(*products).alias("second"))
        )
        new = store(estimates(sums, scale))
        falls = fell is None or new.join(fell, "cell").where(F.col("spread") < F.col("spread_before") - 1e-3).limit(1).count()
        model, fell = new, new.select("cell", F.col("spread").alias("spread_before"))
        if not falls:
            break
    return model.select("cell", "mean", "inverse")


def judge(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    tail: float = TAIL,
    min_rows: int = MIN_ROWS,
) -> DataFrame:
    """key, the five counts, base_failed, kept, distance (null where not judged); one row per row."""
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    rows = store(counts(docs, key, text, lang, source).withColumn("base_failed", failed))
    passed = cells(rows.where(~F.col("base_failed")), min_rows)
    different = passed.select("cell", *STATS).distinct()
    every = passed.select(F.lit(ALL).alias("cell"), *STATS).distinct()
    models = store(fit(store(different.union(every)), min_rows=min_rows))
    model = models.where(F.col("cell") != ALL)
    whole = models.where(F.col("cell") == ALL).select(F.col("mean").alias("all_mean"), F.col("inverse").alias("all_inverse"))
    judged = (
        passed.join(small(model), "cell", "left")
        .join(F.broadcast(whole), F.lit(True), "left")  # one row at most
        .withColumn("distance", F.sqrt(distance()))
        .withColumn("judged_by", F.coalesce("distance", F.sqrt(distance("all_mean", "all_inverse"))))
    )
    limit = math.sqrt(chi2_limit(tail, DIMENSIONS))
    columns = [key, *COUNTS, "base_failed"]
    kept = F.coalesce(F.col("judged_by") <= limit, F.lit(True)).alias("kept")
    failed_rows = rows.where("base_failed").withColumn("distance", F.lit(None).cast("double"))
    return judged.select(*columns, kept, "distance").unionByName(failed_rows.select(*columns, F.lit(False).alias("kept"), "distance"))
