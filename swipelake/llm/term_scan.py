"""Ranked lexical search by one automaton over all terms of the items; there is no index of the documents.

Terms are runs of letters, digits and characters beyond ASCII; only A-Z are lowered. A text becomes bytes in which every other
character is a space, and the automaton's words are terms between two spaces, so it never reports part of a longer term. Every
match counts once for its term's tf, and a term's outputs map it to the items that hold it, with how often they do.

Documents are scanned twice. The first scan counts documents, terms and, per term, the documents that hold it: one partial sum per
task and term comes together. The second scan scores a document against all items that share a term with it and keeps the best of
each task; these are ranked by Spark, first within parts of the tasks, then over all. Scores are whole numbers: sums of doubles
where an item's greatest possible score is below 2^53, else of 64-bit integers.

Items are taken in blocks of BLOCK_BYTES of text, so that what is broadcast (terms, their weights and items) is bounded; each block
costs its two scans. All documents are ranked for all items.

Cases: null and empty texts have no terms; such documents don't count and such items get no rows. Items that repeat, or have a null
id, are items of their own. Documents with one key are ranked apart; a null key comes after all others among equal scores. Keys
of documents are whole numbers. An empty table on either side gives no rows. Further columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import repeat
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

BEST = 20
BLOCK_BYTES = 1 << 20  # of item texts that are searched for together
CELLS = 1 << 20  # scores held at once
PARTS = 32  # of the tasks, each ranked by itself before all are
EXACT = 1 << 53

# Parameters of the weighting.
SCALE, GAIN, DAMP, BASE, SHARE = 1_000_000_000, 1000, 12, 75, 25

_LETTERS = bytes(range(0x30, 0x3A)) + bytes(range(0x41, 0x5B)) + bytes(range(0x61, 0x7B))
BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or b in _LETTERS else 0x20 for b in range(256))


def lowered(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "replace").translate(BYTES)


def automaton_of(terms: list[str]) -> ahocorasick.Automaton:
    """Words are terms between spaces; a word's output is the term's number."""
    automaton = ahocorasick.Automaton()
    for i, term in enumerate(terms):
        automaton.add_word(f" {term} ", i)
    automaton.make_automaton()
    return automaton


class Block:
    """Some items: their distinct terms, and for each term the items that hold it with their counts."""

    def __init__(self, items: list[tuple], first: int):
        self.first, self.ids = first, [i for i, _ in items]
        held: dict[str, list[tuple[int, int]]] = {}
        for at, (_, text) in enumerate(items):
            for term, n in Counter(lowered(text).decode("latin-1").split(" ")).items():
                if term:
                    held.setdefault(term, []).append((at, n))
        self.terms = list(held)
        outputs = [o for term in self.terms for o in held[term]]
        self.sizes = np.array([len(held[t]) for t in self.terms], dtype=np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.item = np.array([i for i, _ in outputs], dtype=np.int64)
        self.times = np.array([n for _, n in outputs], dtype=np.int64)
        self.weights = np.zeros(len(self.terms), dtype=np.int64)
        self.documents = self.length = 0

    def weigh(self, documents: int, length: int, holding: dict[int, int]) -> None:
        self.documents, self.length = documents, length
        for i in range(len(self.terms)):
            self.weights[i] = math.floor(GAIN * math.log((2 * documents + 2) / (2 * holding.get(i, 0) + 1)))

    def exact(self) -> bool:
        """Whether no score can leave the whole numbers that doubles hold."""
        most = np.bincount(self.item, (self.times * np.repeat(self.weights, self.sizes)).astype(float), len(self.ids))
        return bool(most.max(initial=0.0) * (SCALE // GAIN) < EXACT)


def matches(automaton: ahocorasick.Automaton, text: bytes) -> Counter:
    """Term number -> tf."""
    return Counter(map(itemgetter(1), automaton.iter(f" {text.decode('latin-1')} ")))


def blocks(items: DataFrame, key: str, text: str, limit: int) -> Iterator[Block]:
    """The items in turn; only one block's texts are held."""
    held, size, first = [], 0, 0
    for row in items.select(F.col(key), F.col(text).cast("string")).toLocalIterator():
        length = len((row[1] or "").encode("utf-8", "replace"))
        if held and size + length > limit:
            yield Block(held, first)
            held, size, first = [], 0, first + len(held)
        held.append((row[0], row[1]))
        size += length
    if held:
        yield Block(held, first)


def count(docs: DataFrame, block: Block) -> tuple[int, int, dict[int, int]]:
    """Documents with a term, their terms, and by number of a term the documents that hold it."""
    terms = docs.sparkSession.sparkContext.broadcast(block.terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, holding = automaton_of(terms.value), np.zeros(len(terms.value) + 2, dtype=np.int64)
        for batch in batches:
            for t in batch.column(1):
                text = lowered(t.as_py())
                if n := len(text.split()):
                    holding[-2] += 1
                    holding[-1] += n
                    holding[list(matches(automaton, text))] += 1
        at = np.flatnonzero(holding)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(holding[at])], ["term", "n"])

    found = {r["term"]: r["n"] for r in docs.mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()}
    last = len(block.terms)
    return found.pop(last, 0), found.pop(last + 1, 0), found


class Best:
    """The best documents of each item seen so far."""

    def __init__(self, items: int, k: int):
        self.k, self.least = k, np.ones(items)
        self.held = tuple(np.empty(0, dtype=np.int64) for _ in range(4))  # item, score, key is null, key

    def add(self, scores: np.ndarray, null: np.ndarray, keys: np.ndarray) -> None:
        """``scores`` has a row per document and a column per item."""
        least = self.least
        if len(scores) > self.k:
            least = np.maximum(least, np.partition(scores, len(scores) - self.k, axis=0)[len(scores) - self.k])
        doc, item = np.nonzero(scores >= least)
        new = (item, scores[doc, item].astype(np.int64), null[doc], keys[doc])
        item, score, null, keys = (np.concatenate(x) for x in zip(self.held, new))
        order = np.lexsort((keys, null, -score, item))
        item, score, null, keys = (x[order] for x in (item, score, null, keys))
        starts = np.flatnonzero(np.diff(item, prepend=-1))
        place = np.arange(len(item)) - np.repeat(starts, np.diff(np.r_[starts, len(item)]))
        self.held = tuple(x[place < self.k] for x in (item, score, null, keys))
        last = place == self.k - 1
        self.least[item[last]] = score[last]


class Scorer:
    """Collects the matches of some documents and scores them together."""

    def __init__(self, block: Block, best: Best, cells: int):
        self.block, self.best, self.cells, self.exact = block, best, cells, block.exact()
        self.clear()

    def clear(self) -> None:
        self.keys, self.damp, self.docs, self.terms, self.tfs, self.outputs = [], [], [], [], [], 0

    def add(self, key: int | None, n: int, found: Counter) -> None:
        if not found:
            return
        self.docs.extend(repeat(len(self.keys), len(found)))
        self.keys.append(key)
        self.damp.append(DAMP * (BASE + SHARE * n * self.block.documents // self.block.length))
        self.terms.extend(found)
        self.tfs.extend(found.values())
        if len(self.terms) >= self.cells >> 2 or len(self.keys) * len(self.block.ids) >= self.cells:
            self.flush()

    def flush(self) -> None:
        if not self.keys:
            return
        b, items = self.block, len(self.block.ids)
        doc, term, tf = (np.array(x, dtype=np.int64) for x in (self.docs, self.terms, self.tfs))
        value = b.weights[term] * (SCALE * tf // (GAIN * tf + np.array(self.damp, dtype=np.int64)[doc]))
        scores = np.zeros(len(self.keys) * items, dtype=np.float64 if self.exact else np.int64)
        sizes = b.sizes[term]
        ends = np.cumsum(sizes)
        first = 0
        while first < len(term):  # a slice of the matches, and one at least, whose outputs fit
            last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + self.cells, "right")))
            n = sizes[first:last]
            at = np.arange(n.sum()) + np.repeat(b.starts[term[first:last]] - (np.cumsum(n) - n), n)
            place = np.repeat(doc[first:last] * items, n) + b.item[at]
            values = np.repeat(value[first:last], n) * b.times[at]
            if self.exact:
                scores += np.bincount(place, values, len(scores))
            else:
                np.add.at(scores, place, values)
            first = last
        null = np.array([k is None for k in self.keys], dtype=np.int64)
        self.best.add(scores.reshape(-1, items), null, np.array([k or 0 for k in self.keys], dtype=np.int64))
        self.clear()


def score(docs: DataFrame, block: Block, kind: pa.DataType, schema: str, k: int, cells: int) -> DataFrame:
    """The best ``k`` documents of each task for each item of the block."""
    shared = docs.sparkSession.sparkContext.broadcast(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        automaton, best = automaton_of(known.terms), Best(len(known.ids), k)
        scorer = Scorer(known, best, cells)
        for batch in batches:
            for key, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = lowered(t.as_py())
                if n := len(text.split()):
                    scorer.add(key, n, matches(automaton, text))
        scorer.flush()
        item, points, null, keys = best.held
        columns = [pa.array(item + known.first), pa.array([known.ids[i] for i in item], kind), pa.array(keys, mask=null.astype(bool)), pa.array(points)]
        yield pa.RecordBatch.from_arrays(columns, ["item", "item_id", "doc", "score"])

    return docs.mapInArrow(run, schema)


def search(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    k: int = BEST,
    block_bytes: int = BLOCK_BYTES,
    cells: int = CELLS,
) -> DataFrame:
    """item, rank (from 1), document, score: the ``k`` best documents with a score above 0 per item, equal scores by ascending key."""
    source = docs.select(F.col(key).cast("bigint").alias("doc"), F.col(text).cast("string").alias("text"))
    item_type = items.schema[item_key].dataType
    schema = f"item long, item_id {item_type.simpleString()}, doc long, score long"
    found = docs.sparkSession.createDataFrame([], schema)
    for block in blocks(items, item_key, item_text, block_bytes):
        if block.terms:
            block.weigh(*count(source, block))
            found = found.unionByName(score(source, block, to_arrow_type(item_type), schema, k, cells))
    parted = found.where("score > 0").withColumn("part", F.spark_partition_id() % PARTS)
    order = [F.desc("score"), F.asc_nulls_last("doc")]
    for by in (["item", "part"], ["item"]):
        parted = parted.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= k)
    return parted.select(F.col("item_id").alias(item_key), "rank", F.col("doc").alias(key), "score")
