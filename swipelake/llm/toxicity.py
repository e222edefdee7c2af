"""Counterfactual-regularised toxicity classifier.

Features are the distinct words of a text, lower case, and the beginnings that one, two or three of
them share. From a bounded sample of labelled rows the features that tell the classes apart best are chosen, and a
logistic regression is fitted on them. Its loss has a further term: in sampled texts each identity
term is swapped for the others of its set, and the squared change of the score (before the logistic
function) is penalised, so that a neutral mention of a group doesn't raise the score.

Labels are learnt only from rows outside the held-out fold; labels, languages, sources and keys never
enter a score. The sample (at most SAMPLE labelled keys, then at most SAMPLE different pairs of key and text, both by a hash) and
the model (at most FEATURES weights) have fixed bounds; what is shipped to tasks or the driver is only these.

Cases: null and empty texts get the score of a text without features. Null labels and labels without
a document are not learnt from; of rows with one key, each different text is learnt from once, under the key's
largest label, as far as the sample's bound goes. Without labels of both classes every score is the share of label 1 (0 without any).
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from swipelake.llm.common import fold_of, store

SAMPLE = 20_000
FEATURES = 512
MIN_TEXTS = 4  # with a feature, in the sample
PREFIXES = range(3, 8)
MOST = 3  # words with one beginning that are told apart
FOLDS, HELD_OUT = 3, 1
THRESHOLD = 0.7
RIDGE = 5e-5
SWAP_WEIGHT = 1.0
ROUNDS = 400

# Sets of terms that may stand for each other.
IDENTITY_SETS = (
    ("women", "men", "girls", "boys"),
    ("woman", "man", "girl", "boy"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino", "african", "european"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("immigrants", "refugees", "foreigners", "natives"),
    ("young", "old", "disabled", "blind", "deaf"),
)
_OTHERS = {term: [t for t in group if t != term] for group in IDENTITY_SETS for term in group}
_WORDS = re.compile(r"[^\W\d_]+")


def words(text: str) -> set[str]:
    return set(_WORDS.findall(text.lower()))


def features(found: set[str]) -> set[str]:
    """Words, marked by a closing blank, and beginnings, marked by how many words share them (1 to MOST)."""
    shared: Counter = Counter()
    for w in found:
        for k in PREFIXES:
            if k > len(w):
                break
            shared[w[:k]] += 1
    out = {w + " " for w in found}
    for prefix, n in shared.items():
        for level in range(1, min(n, MOST) + 1):
            out.add(f"{prefix}{level}")
    return out


def _batches(frame: DataFrame, schema: str, rows_of) -> DataFrame:
    """Rows that ``rows_of`` makes of each batch, given as lists by column."""
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(rows_of(batch), names)

    return frame.mapInArrow(run, schema)


def sample(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, size: int) -> DataFrame:
    """drawn_label, text: at most ``size`` rows. Labelled keys outside the held-out fold are drawn by a hash of the key, then of
    what stands behind them different pairs of key and text by a hash of both: a key may have a third of all rows."""
    drawn = (
        labels.where(F.col(label).isin(0, 1) & (fold_of(key, FOLDS) != HELD_OUT))
        .groupBy(F.col(key).alias("drawn_key"))
        .agg(F.max(label).cast("int").alias("drawn_label"))
        .orderBy(F.xxhash64("drawn_key"), "drawn_key")
        .limit(size)
    )
    texts = docs.select(F.col(key).alias("text_key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    found = texts.join(F.broadcast(store(drawn)), F.col("text_key") == F.col("drawn_key"))
    found = found.select(F.xxhash64("text_key", "text").alias("pair"), "drawn_label", "text")
    pairs = store(found.select("pair").distinct().orderBy("pair").limit(size))
    one = found.join(F.broadcast(pairs), "pair").groupBy("pair").agg(F.min(F.struct("drawn_label", "text")).alias("row"))
    return one.select("row.drawn_label", "row.text")


def chosen(rows: DataFrame, number: int, texts: tuple[int, int]) -> list[str]:
    """The features with the largest likelihood ratios between the classes."""

    def count(batch: pa.RecordBatch) -> list[pa.Array]:
        found: tuple[Counter, Counter] = (Counter(), Counter())
        for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            found[label].update(features(words(text)))
        every = list(found[0] | found[1])
        return [pa.array(every, pa.string()), *(pa.array([found[k][f] for f in every], pa.int64()) for k in (0, 1))]

    sums = _batches(rows, "feature string, n0 long, n1 long", count).groupBy("feature").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    share = texts[1] / (texts[0] + texts[1])
    n = F.col("n0") + F.col("n1")

    def part(count, expected):
        return F.when(count > 0, count * F.log(count / expected)).otherwise(0.0)

    ratio = part(F.col("n0"), n * (1 - share)) + part(F.col("n1"), n * share)
    best = sums.where(n >= MIN_TEXTS).orderBy(F.round(ratio, 6).desc(), F.length("feature"), "feature").limit(number)
    return [r[0] for r in best.select("feature").collect()]


def swaps(found: set[str], index: dict[str, int]) -> list[dict[int, float]]:
    """Changes of the feature vector when an identity term of the text becomes another of its set."""
    changes = []
    own = features(found)
    for term in sorted(found & _OTHERS.keys()):
        for other in _OTHERS[term]:
            swapped = features((found - {term}) | {other})
            change = {index[f]: 1.0 for f in swapped - own if f in index}
            change |= {index[f]: -1.0 for f in own - swapped if f in index}
            if change:
                changes.append(change)
    return changes


def fit(vectors: list[list[int]], labels: np.ndarray, changes: list[tuple[tuple[int, float], ...]], weights: list[int], width: int) -> tuple[float, np.ndarray]:
    """Intercept and weights by accelerated gradient descent; ``changes`` occur ``weights`` times."""
    x = np.zeros((len(vectors), width + 1), dtype=np.float32)
    for i, v in enumerate(vectors):
        x[i, v] = 1
    x[:, width] = 1
    pairs = np.zeros((len(changes), width + 1), dtype=np.float32)
    for i, change in enumerate(changes):
        for j, value in change:
            pairs[i, j] = value
    of_pairs = np.asarray(weights, dtype=np.float32) * (SWAP_WEIGHT / max(len(vectors), 1))
    ridge = np.full(width + 1, RIDGE, dtype=np.float32)
    ridge[width] = 0
    # The largest curvature bounds the step: power iteration on the loss's quadratic bound.
    v = np.ones(width + 1, dtype=np.float32)
    for _ in range(20):
        u = x.T @ (x @ v) / (4 * len(vectors)) + 2 * (pairs.T @ (of_pairs * (pairs @ v))) + ridge * v
        size = float(np.linalg.norm(u))
        v = u / size
    step = 1 / (1.1 * size)
    w = ahead = np.zeros(width + 1, dtype=np.float32)
    w[width] = ahead[width] = math.log((labels.sum() + 1) / (len(labels) - labels.sum() + 1))
    for k in range(ROUNDS):
        p = 1 / (1 + np.exp(-np.clip(x @ ahead, -30, 30)))
        gradient = x.T @ (p - labels) / len(vectors) + 2 * (pairs.T @ (of_pairs * (pairs @ ahead))) + ridge * ahead
        new = ahead - step * gradient
        ahead = new + (k / (k + 3)) * (new - w)
        w = new
    return float(w[width]), w[:width].astype(float)


def train(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", size: int = SAMPLE, number: int = FEATURES
) -> tuple[float, dict[str, float]]:
    """Intercept, and weight by feature."""
    rows = store(sample(docs, labels, key, text, label, size))
    tally = {r[0]: r[1] for r in rows.groupBy("drawn_label").count().collect()}
    texts = (tally.get(0, 0), tally.get(1, 0))
    if not all(texts):
        share = texts[1] / max(sum(texts), 1)
        return math.log(max(share, 1e-9) / max(1 - share, 1e-9)), {}
    identity = sorted(term + " " for term in _OTHERS)
    names = sorted({*chosen(rows, number, texts), *identity})
    index = {f: i for i, f in enumerate(names)}

    def vectors(batch: pa.RecordBatch) -> list[pa.Array]:
        ids, changes = [], []
        for t in batch.column(1).to_pylist():
            found = words(t)
            ids.append(sorted({index[f] for f in features(found) if f in index}))
            changes.append([sorted(c.items()) for c in swaps(found, index)])
        flat = [[[float(x) for pair in c for x in pair] for c in row] for row in changes]
        return [batch.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array(flat, pa.list_(pa.list_(pa.float64())))]

    got = _batches(rows, "label int, ids array<int>, changes array<array<double>>", vectors).collect()
    changes = Counter(tuple(zip(map(int, c[::2]), c[1::2])) for r in got for c in r.changes)
    order = sorted(changes)
    intercept, weights = fit(
        [r.ids for r in got], np.array([r.label for r in got], dtype=np.float32), order, [changes[c] for c in order], len(names)
    )
    return intercept, {f: float(w) for f, w in zip(names, weights) if abs(w) > 1e-4}


def score(docs: DataFrame, model: tuple[float, dict[str, float]], key: str = "doc_id", text: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """key (and other columns to carry), held_out, score, predicted; one row per row."""
    intercept, weights = model
    heads = {f[: PREFIXES[0]] for f in weights if len(f) > PREFIXES[0]}
    short = {f[:-1] for f in weights if len(f) <= PREFIXES[0]}
    head = PREFIXES[0]

    def of_text(text: str) -> float:
        found = {w for w in words(text) if w[:head] in heads or w in short}
        total = math.fsum([intercept, *(weights[f] for f in features(found) & weights.keys())])  # in whatever order
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, total))))

    kept = docs.select(F.col(key), *carry)
    frame = docs.select(F.col(key), *carry, fold_of(key, FOLDS).alias("fold"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("scored_text"))
    width = len(kept.columns)
    names = [*kept.columns, "held_out", "score", "predicted"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [of_text(t.as_py()) for t in batch.column(width + 1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(width)]
                + [
                    pa.array([f == HELD_OUT for f in batch.column(width).to_pylist()], pa.bool_()),
                    pa.array(scores, pa.float64()),
                    pa.array([int(s >= THRESHOLD) for s in scores], pa.int32()),
                ],
                names,
            )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    return frame.mapInArrow(run, schema + ", held_out boolean, score double, predicted int")
