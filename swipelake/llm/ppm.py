"""Scores of texts under a byte-context model: prediction by partial matching.

The trie of byte contexts up to ORDER bytes is learnt from all training texts. A byte that its longest
seen context has not had escapes to the next shorter one (method D: half an occurrence of each byte seen goes to the
escape), and the bytes of the longer context are excluded there; below the empty context all bytes not
yet seen are alike. Texts open with, and contexts before them hold, the mark 0xFF, which UTF-8 never
uses; its last occurrence is coded as the end of the text. A plain word count model goes along.

Neither trie nor words have a bound, so nothing of them is broadcast but the part of up to LOW bytes
of context (at most 256 ** (LOW + 1) counts, by construction). Rows are dealt by their place into batches of about
BATCH_BYTES, whatever their keys and texts, and stored so once, compressed; both passes read that. Each batch sends what it needs, its distinct words and byte strings with their training
counts, in shards by hash; a shard adds the counts up, works out the probabilities and answers each
batch, with log probabilities of 32 bits; a second pass over the batches adds up the texts in doubles. All three steps read and
write linear data, but the number of requests grows as the product of batches and shards.

Cases: null and empty texts consist of their end only. Null keys count as empty text in the fold.
Rows that repeat are learnt and scored each. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from zstandard import ZstdCompressor, ZstdDecompressor

from swipelake.llm.common import drop, fold_of, store

ORDER = 5
LOW = 2
FOLDS, HELD_OUT = 7, 2
BATCH_BYTES = 6 << 20
PIECE_BYTES = 1 << 20  # of a batch worked on at once
MARK = 0xFF
END = b"\xff"  # the end of a text as a word


def contexts(texts: list[bytes]) -> np.ndarray:
    """One number for each byte and end mark: the last ORDER bytes, latest first, then the byte itself."""
    opening = bytes([MARK]) * ORDER
    raw = np.frombuffer(opening + b"".join([t + opening for t in texts]), dtype=np.uint8)
    size = len(raw) - ORDER
    keys = np.zeros(size, dtype=np.uint64)
    for back in range(1, ORDER + 1):
        keys = (keys << np.uint64(8)) | raw[ORDER - back : ORDER - back + size]
    keys = (keys << np.uint64(8)) | raw[ORDER:]
    # Each text has its own bytes and one mark; the other marks only part it from the next.
    lengths = np.array([len(t) for t in texts])
    starts = np.concatenate([[0], np.cumsum(lengths + ORDER)[:-1]])
    extra = (starts + lengths)[:, None] + np.arange(1, ORDER)
    coded = np.ones(size, dtype=bool)
    coded[extra.ravel()] = False
    return keys[coded]


def pieces(texts: list[bytes], size: int = PIECE_BYTES) -> list[list[int]]:
    """Numbers of the texts, in runs of about ``size`` bytes."""
    runs, held = [[]], 0
    for i, t in enumerate(texts):
        if held >= size:
            runs.append([])
            held = 0
        runs[-1].append(i)
        held += len(t) + 1
    return runs


def totals(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys with the sums of their counts."""
    if not keys:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
    return distinct, np.bincount(at, weights=np.concatenate(counts), minlength=len(distinct)).astype(np.int64)


def shard_of_keys(keys: np.ndarray, shards: int) -> np.ndarray:
    """By the last three bytes of context, so that all longer contexts on them meet."""
    head = keys >> np.uint64(8 * (ORDER + 1 - 3))
    return ((head * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)) % np.uint64(shards)


def request(texts: list[bytes], learnt: list[bool], shards: int) -> tuple[dict[int, tuple[bytes, bytes, bytes, bytes]], np.ndarray, np.ndarray]:
    """Per shard: keys, their counts, words, their counts; and the counts of short contexts."""
    keys, counts = [], []
    for run in pieces(texts):
        for wanted in (True, False):
            part = [texts[i] for i in run if learnt[i] is wanted]
            if part:
                k, n = np.unique(contexts(part), return_counts=True)
                keys.append(k)
                counts.append(n if wanted else np.zeros(len(k), dtype=np.int64))
        if len(keys) > 16:
            k, n = totals(keys, counts)
            keys, counts = [k], [n]
    k, n = totals(keys, counts)
    shift = np.uint64(8 * (ORDER - LOW))
    low, low_counts = totals([((k >> (shift + np.uint64(8))) << np.uint64(8)) | (k & np.uint64(255))], [n])
    low, low_counts = low[low_counts > 0], low_counts[low_counts > 0]

    words: Counter = Counter()
    others: set[bytes] = set()
    for text, learn in zip(texts, learnt):
        (words if learn else others).update(text.split())
        if learn:
            words[END] += 1
    for w in [*others, END]:
        words[w] += 0
    by_shard: dict[int, list[bytes]] = {}
    for w in sorted(words):
        by_shard.setdefault(crc32(w) % shards, []).append(w)

    where = shard_of_keys(k, shards)
    order = np.argsort(where, kind="stable")
    edges = np.searchsorted(where[order], np.arange(shards + 1))
    out = {}
    for s in sorted({*np.unique(where).tolist(), *by_shard}):
        mine = order[edges[s] : edges[s + 1]]
        own = by_shard.get(s, [])
        tallies = np.array([words[w] for w in own], dtype=np.int64)
        out[s] = (squeeze_sorted(k[mine]), squeeze(n[mine].astype(np.int64)), join_words(own), squeeze(tallies))
    return out, low, low_counts


class Low:
    """Counts of contexts of up to LOW bytes. Keys are (latest byte, the one before, coded byte)."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        self.keys, self.counts = keys, counts.astype(np.float64)
        context, byte = (keys >> np.uint64(8)).astype(np.int64), (keys & np.uint64(255)).astype(np.int64)
        latest = context >> 8
        self.c1 = np.bincount(latest * 256 + byte, weights=self.counts, minlength=1 << 16)
        self.c0 = self.c1.reshape(256, 256).sum(axis=0)
        self.n2 = np.bincount(context, weights=self.counts, minlength=1 << 16)
        self.d2 = np.bincount(context, minlength=1 << 16).astype(float)
        self.above2 = np.bincount(context, weights=self.c1[latest * 256 + byte], minlength=1 << 16)
        table = self.c1.reshape(256, 256)
        self.n1, self.d1 = table.sum(axis=1), (table > 0).sum(axis=1).astype(float)
        self.above1 = ((table > 0) * self.c0).sum(axis=1)
        self.n0, self.d0 = self.c0.sum(), float((self.c0 > 0).sum())

    def count2(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(keys))
        at = np.searchsorted(self.keys, keys).clip(max=len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.counts[at], 0.0)


def step(log: np.ndarray, open_: np.ndarray, c: np.ndarray, n: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code the byte in a context with ``n`` bytes of ``d`` kinds left after exclusion, or escape from it."""
    all_ = np.maximum(n, 1)
    hit = open_ & (c > 0)
    log = np.where(hit, log + np.log10(np.maximum(c - 0.5, 0.5) / all_), log)
    escape = open_ & (c == 0) & (d > 0)
    log = np.where(escape, log + np.log10(np.maximum(0.5 * d, 0.5) / all_), log)
    return log, open_ & (c == 0)


def log_probabilities(keys: np.ndarray, counts: np.ndarray, low: Low) -> np.ndarray:
    """log10 of each byte's probability in its context, for sorted distinct keys that hold all
    training keys on their last three context bytes."""
    byte = keys & np.uint64(255)
    log, open_ = np.zeros(len(keys)), np.ones(len(keys), dtype=bool)
    tables = {}
    for k in range(ORDER, LOW, -1):
        node = keys >> np.uint64(8 * (ORDER + 1 - k))
        grams, at = np.unique((node << np.uint64(8)) | byte, return_inverse=True)
        c = np.bincount(at, weights=counts, minlength=len(grams))
        nodes, own = np.unique(grams >> np.uint64(8), return_inverse=True)
        n = np.bincount(own, weights=c, minlength=len(nodes))
        d = np.bincount(own, weights=c > 0, minlength=len(nodes))
        tables[k] = (grams, at, c, own, n, d)
    above_n, above_d = np.zeros(len(keys)), np.zeros(len(keys))  # what the longer context has seen, as counted here
    for k in range(ORDER, LOW, -1):
        grams, at, c, own, n, d = tables[k]
        log, open_ = step(log, open_, c[at], n[own[at]] - above_n, d[own[at]] - above_d)
        # Parent counts of the bytes this context has seen.
        if k - 1 > LOW:
            first = np.zeros(len(grams), dtype=np.int64)
            first[at] = np.arange(len(keys))
            parent = tables[k - 1][2][tables[k - 1][1][first]]
        else:
            node = grams >> np.uint64(8)
            parent = low.count2(((node >> np.uint64(8 * (k - LOW))) << np.uint64(8)) | (grams & np.uint64(255)))
        above = np.bincount(own, weights=np.where(c > 0, parent, 0.0), minlength=len(n))
        above_n, above_d = above[own[at]], d[own[at]]
    pair = (keys >> np.uint64(8 * (ORDER + 1 - 2))).astype(np.int64)
    b, latest = byte.astype(np.int64), pair >> 8
    log, open_ = step(log, open_, low.count2((pair.astype(np.uint64) << np.uint64(8)) | byte), low.n2[pair] - above_n, low.d2[pair] - above_d)
    log, open_ = step(log, open_, low.c1[latest * 256 + b], low.n1[latest] - low.above2[pair], low.d1[latest] - low.d2[pair])
    log, open_ = step(log, open_, low.c0[b], low.n0 - low.above1[latest], low.d0 - low.d1[latest])
    return np.where(open_, log - math.log10(max(256 - low.d0, 1)), log)


def squeeze(values: np.ndarray) -> bytes:
    """Compressed bytes of an array, its bytes of one rank together."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T)
    return ZstdCompressor(level=1).compress(planes.tobytes())


def spread(packed: bytes, kind) -> np.ndarray:
    raw = np.frombuffer(ZstdDecompressor().decompress(packed), dtype=np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(size, -1).T).reshape(-1).view(kind)


def squeeze_sorted(keys: np.ndarray) -> bytes:
    return squeeze(np.diff(keys, prepend=np.uint64(0)))


def spread_sorted(packed: bytes) -> np.ndarray:
    return np.cumsum(spread(packed, np.uint64), dtype=np.uint64)


def join_words(words: list[bytes]) -> bytes:
    return ZstdCompressor(level=3).compress(b"\n".join(words))


def split_words(packed: bytes) -> list[bytes]:
    raw = ZstdDecompressor().decompress(packed)
    return raw.split(b"\n") if raw else []


def bundles(source: DataFrame, batches: int) -> DataFrame:
    """Rows of a batch that a task holds at once, as one row: keys, folds, sizes, compressed lower-case texts."""
    kind = source.schema["key"].dataType.simpleString()
    dealt = source.withColumn("batch", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(batches)).cast("int"))

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in found:
            where: dict[int, list[int]] = {}
            for i, b in enumerate(whole.column(3).to_pylist()):
                where.setdefault(b, []).append(i)
            rows = []
            for b, mine in where.items():
                part = whole.take(pa.array(mine))
                texts = [t.as_py().encode("utf-8", "replace").lower() for t in part.column(2)]
                blob = ZstdCompressor(level=3).compress(b"".join(texts))
                rows.append((b, part.column(0), part.column(1).to_pylist(), [len(t) for t in texts], blob))
            if rows:
                column = list(zip(*rows))
                ends = np.cumsum([0, *(len(k) for k in column[1])]).astype(np.int32)
                keys = pa.ListArray.from_arrays(pa.array(ends), pa.concat_arrays(column[1]))
                numbers = [pa.array(c, pa.list_(pa.int32())) for c in column[2:4]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(column[0], pa.int32()), keys, *numbers, pa.array(column[4], pa.binary())], ["batch", "keys", "folds", "sizes", "texts"]
                )

    return dealt.mapInArrow(run, f"batch int, keys array<{kind}>, folds array<int>, sizes array<int>, texts binary")


def unbundled(held: pa.Table) -> tuple[pa.Array, list[bytes], list[bool]]:
    """Keys, texts and whether each may be learnt from; bundles may come in any order."""
    texts: list[bytes] = []
    for sizes, blob in zip(held["sizes"].to_pylist(), held["texts"].to_pylist()):
        raw, at = ZstdDecompressor().decompress(blob) if sum(sizes) else b"", 0
        for size in sizes:
            texts.append(raw[at : at + size])
            at += size
    keys = pa.concat_arrays([c.flatten() for c in held["keys"].chunks])
    return keys, texts, [f != HELD_OUT for folds in held["folds"].to_pylist() for f in folds]


def score(docs: DataFrame, key: str = "doc_id", text: str = "text", batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """key, held_out, n_tokens, n_known, train_tokens, base_score, score; one row per row."""
    source = docs.select(
        F.col(key).alias("key"), fold_of(key, FOLDS).cast("int").alias("fold"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")
    )
    size = source.agg(F.sum(F.octet_length("text") + 1)).first()[0] or 0
    batches = max(1, round(size / batch_bytes))
    dealt = store(bundles(source, batches))

    def ask(held: pa.Table) -> pa.Table:
        _, texts, learnt = unbundled(held)
        shards, low, counts = request(texts, learnt, batches)
        rows = [(held["batch"][0].as_py(), s, *parts, None, None) for s, parts in shards.items()]
        rows.append((held["batch"][0].as_py(), -1, None, None, None, None, low.astype(np.int64), counts))
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows), asked_type)], schema=asked_type)

    asked_type = pa.schema(
        [("batch", pa.int32()), ("shard", pa.int32()), ("keys", pa.binary()), ("key_counts", pa.binary()), ("words", pa.binary()), ("word_counts", pa.binary())]
        + [("low", pa.list_(pa.int64())), ("low_counts", pa.list_(pa.int64()))]
    )
    asked = store(
        dealt.groupBy("batch").applyInArrow(
            ask, "batch int, shard int, keys binary, key_counts binary, words binary, word_counts binary, low array<long>, low_counts array<long>"
        )
    )
    short = (
        asked.where("shard = -1")
        .select(F.explode(F.arrays_zip("low", "low_counts")).alias("x"))
        .groupBy("x.low")
        .agg(F.sum("x.low_counts").alias("n"))
        .toPandas()  # at most 256 ** (LOW + 1) rows
        .sort_values("low")
    )
    low_keys, low_counts = short["low"].to_numpy(dtype=np.uint64), short["n"].to_numpy(dtype=np.int64)
    shared = docs.sparkSession.sparkContext.broadcast((low_keys, low_counts))

    def answer(held: pa.Table) -> pa.Table:
        low = Low(*shared.value)
        packed = held["keys"].to_pylist()
        keys = [spread_sorted(k) for k in packed]
        distinct, sums = totals(keys, [spread(c, np.int64) for c in held["key_counts"].to_pylist()])
        logs = log_probabilities(distinct, sums, low).astype(np.float32)
        words: dict[bytes, int] = {}
        lists = held["words"].to_pylist()
        for raw, numbers in zip(lists, held["word_counts"].to_pylist()):
            for w, n in zip(split_words(raw), spread(numbers, np.int64).tolist()):
                words[w] = words.get(w, 0) + n
        rows = []
        for batch, k, one, raw in zip(held["batch"].to_pylist(), packed, keys, lists):
            own = split_words(raw)
            known = np.fromiter((words[w] for w in own), dtype=np.int64, count=len(own))
            rows.append((batch, k, squeeze(logs[np.searchsorted(distinct, one)]), raw, squeeze(known), None, None))
        seen = [n for n in words.values() if n]
        rows.append((-1, None, None, None, None, len(seen), sum(seen)))
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows), answered_type)], schema=answered_type)

    answered_type = pa.schema(
        [("batch", pa.int32()), ("keys", pa.binary()), ("logs", pa.binary()), ("words", pa.binary()), ("known", pa.binary()), ("distinct", pa.int64()), ("total", pa.int64())]
    )
    answered = store(
        asked.where("shard >= 0")
        .select("batch", "shard", "keys", "key_counts", "words", "word_counts")
        .groupBy("shard")
        .applyInArrow(answer, "batch int, keys binary, logs binary, words binary, known binary, distinct long, total long")
    )
    drop(asked)
    vocabulary, trained = (x or 0 for x in answered.where("batch = -1").agg(F.sum("distinct"), F.sum("total")).first())
    offset = math.log10(trained + vocabulary + 1)

    def add_up(held: pa.Table, answers: pa.Table) -> pa.Table:
        names, texts, learnt = unbundled(held)
        keys = np.concatenate([spread_sorted(k) for k in answers["keys"].to_pylist()])
        logs = np.concatenate([spread(x, np.float32) for x in answers["logs"].to_pylist()]).astype(np.float64)
        known: dict[bytes, int] = {}
        for raw, numbers in zip(answers["words"].to_pylist(), answers["known"].to_pylist()):
            known.update(zip(split_words(raw), spread(numbers, np.int64).tolist()))
        weights = {w: math.log10(n + 1) for w, n in known.items()}
        index = pd.Index(keys)
        scores = np.zeros(len(texts))
        for run in pieces(texts):
            found = logs[index.get_indexer(contexts([texts[i] for i in run]))]
            ends = np.cumsum([len(texts[i]) + 1 for i in run])
            scores[run] = np.add.reduceat(found, np.concatenate([[0], ends[:-1]]))
        rows = []
        for t, learn, s in zip(texts, learnt, scores):
            words = t.split()
            words.append(END)
            base = math.fsum(map(weights.__getitem__, words)) - len(words) * offset
            rows.append((not learn, len(words), sum(map(bool, map(known.__getitem__, words))), trained, base, s))
        kinds = [pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
        columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
        return pa.table([names, *columns], ["key", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    kind = source.schema["key"].dataType.simpleString()
    scored = (
        dealt.groupBy("batch")
        .cogroup(answered.where("batch >= 0").select("batch", "keys", "logs", "words", "known").groupBy("batch"))
        .applyInArrow(
            add_up, f"key {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
        )
    )
    return scored.withColumnRenamed("key", key)
