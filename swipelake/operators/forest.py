"""Random forest over sparse rows: what a task holds grows with the places that aren't zero, not with the width.

Values become bins, up to 32 per feature, and equal rows one row with a count. Rows lie in chunks, ordered by place, that no tree
copies: while a node has more entries than a task should hold, chunks go through the splits so far, count the drawn places of the
nodes they have reached, and only those counts are shuffled. Rows travel when their node is small; then one task grows the whole
subtree. Every draw is a hash of seed, tree and node or row, so nothing depends on partitions.
"""

from __future__ import annotations

import json
from contextlib import ExitStack
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from swipelake.operators.vectors import entries
from swipelake.session import cut_lineage, release_shuffles, stored, stored_at

# Fixed value: bins per feature. A code holds place, bin of zero and bin.
BINS = 32
# Entries of the rows that one task grows trees of.
LOCAL_ENTRIES = 16_000_000
# Where a node draws fewer than one place in so many, nodes are split from counts for longer: rows are sent for fewer entries.
WIDE, WIDE_LESS = 64, 16
# Rows, entries and weights of a chunk.
CHUNK_ROWS, CHUNK_ENTRIES, CHUNK_WEIGHTS = 1 << 16, 4_000_000, 16_000_000
# Rows of small nodes that are sent at once, as multiples of all rows.
SENT = 8
# Values in the broadcast cuts of features that are more than zero or not.
CUT_VALUES = 4_000_000
# Rows and trees that a task walks at once, and nodes of a forest that is broadcast.
WALK_ROWS, WALK_TREES, WALK_NODES = 20_000, 10, 1_000_000

_NODE = "tree int, node bigint, place int, bin int, counts array<double>"


def _hash(*parts) -> np.ndarray:
    """Well mixed 64 bits of whole numbers."""
    with np.errstate(over="ignore"):
        h = np.uint64(0x9E3779B97F4A7C15)
        for p in parts:
            h = (h ^ np.asarray(p).astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
            h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            h = h ^ (h >> np.uint64(31))
        return h


def _times(seed: int, tree: int, row: np.ndarray, copies: np.ndarray) -> np.ndarray:
    """How often a tree's draw with replacement has each row: Poisson with the number of its copies as mean."""
    share = (_hash(seed, tree, row) >> np.uint64(11)).astype(np.float64) / 2.0**53
    out = np.empty(len(row))
    for n in np.unique(copies):
        at = np.arange(int(n + 12 * np.sqrt(n)) + 20)
        logs = np.concatenate([[0.0], np.cumsum(np.log(at[1:]))])
        own = copies == n
        out[own] = np.searchsorted(np.cumsum(np.exp(at * np.log(n) - n - logs)), share[own])
    return out


def _prime(n: int) -> int:
    """The smallest prime from n on."""
    while n < 2 or any(n % d == 0 for d in range(2, int(n**0.5) + 1)):
        n += 1
    return n


class _Tried:
    """The square root of the number of features, drawn for each node: the first ones in an order i * step + begin modulo a prime."""

    def __init__(self, width: int, seed: int):
        self.width, self.seed, self.prime, self.many = width, seed, _prime(width), max(1, int(np.ceil(np.sqrt(width))))

    def of(self, tree: int, nodes: np.ndarray):
        p = self.prime
        step = (_hash(self.seed, 1, tree, nodes) % np.uint64(max(p - 1, 1))).astype(np.int64) + 1
        begin = (_hash(self.seed, 2, tree, nodes) % np.uint64(p)).astype(np.int64)
        missing = np.sort((np.arange(self.width, p)[None, :] + begin[:, None]) * step[:, None] % p, axis=1)
        return step, begin, self.many + (missing < self.many + np.arange(p - self.width)[None, :]).sum(1)

    def places(self, step: int, begin: int, end: int) -> np.ndarray:
        """The same, as a list in order."""
        found = (np.arange(int(end)) * pow(int(step), -1, self.prime) - int(begin)) % self.prime
        return np.sort(found[found < self.width])

    def among(self, drawn, node: np.ndarray, place: np.ndarray) -> np.ndarray:
        step, begin, end = drawn
        out = np.empty(len(node), dtype=bool)
        for i in range(0, len(node), 1 << 20):  # little memory for what lies between
            at, n = slice(i, i + (1 << 20)), node[i : i + (1 << 20)]
            out[at] = (place[at] + begin[n]) * step[n] % self.prime < end[n]
        return out


def _counted(key: np.ndarray, label: np.ndarray, weight: np.ndarray, classes: int):
    """Different keys, and weights per key and class."""
    keys, at = np.unique(key, return_inverse=True)
    return keys, np.bincount(at * classes + label, weight, len(keys) * classes).reshape(-1, classes)


def _best_splits(keys: np.ndarray, held: np.ndarray, zero: np.ndarray, totals: np.ndarray, width: int):
    """(nodes, place, bin, bin of zero) of the best split by Gini impurity of each node that has one.

    ``keys`` are (node * width + place) * BINS + bin, ascending; ``held`` their weights per class, ``zero`` the bin of zero; rows of
    a node without an entry at a place are in that bin."""
    if not len(keys):
        return (np.empty(0, dtype=np.int64),) * 4
    first = np.flatnonzero(np.r_[True, np.diff(keys // BINS) != 0])
    pair, pair_zero = keys[first] // BINS, zero[first].astype(np.int64)
    rest = totals[pair // width] - np.add.reduceat(held, first, axis=0)
    every = np.unique(np.r_[keys, pair * BINS + pair_zero])
    full = np.zeros((len(every), held.shape[1]))
    full[np.searchsorted(every, keys)] = held
    full[np.searchsorted(every, pair * BINS + pair_zero)] += rest
    starts = np.flatnonzero(np.r_[True, np.diff(every // BINS) != 0])
    sizes = np.diff(np.r_[starts, len(every)])
    left = np.cumsum(full, axis=0)
    left -= np.repeat(left[starts] - full[starts], sizes, axis=0)
    node = every // BINS // width
    right = totals[node] - left
    n_left, n_right = left.sum(1), right.sum(1)
    some = (n_left > 0.5) & (n_right > 0.5)
    score = np.full(len(every), -np.inf)
    score[some] = (left[some] ** 2).sum(1) / n_left[some] + (right[some] ** 2).sum(1) / n_right[some]
    whole = totals[node]
    score[score <= (whole**2).sum(1) / whole.sum(1) * (1 + 1e-12)] = -np.inf
    begins = np.flatnonzero(np.r_[True, np.diff(node) != 0])
    best = np.maximum.reduceat(score, begins)
    hit = np.flatnonzero((score == np.repeat(best, np.diff(np.r_[begins, len(node)]))) & (score > -np.inf))
    hit = hit[np.r_[True, np.diff(node[hit]) != 0]] if len(hit) else hit
    return node[hit], every[hit] // BINS % width, every[hit] % BINS, np.repeat(pair_zero, sizes)[hit]


class _Rows:
    """Entries of rows, one row after the other."""

    def __init__(self, codes):
        lengths = np.fromiter((len(c) for c in codes), dtype=np.int64, count=len(codes))
        code = np.concatenate([*codes, np.empty(0, dtype=np.int64)]).astype(np.int64)
        self.row = np.repeat(np.arange(len(codes), dtype=np.int32), lengths)
        self.place, self.zero, self.bin = (code >> 10).astype(np.int32), (code >> 5 & 31).astype(np.uint8), (code & 31).astype(np.uint8)


def _grow(rows: _Rows, label: np.ndarray, weight: np.ndarray, tree: int, root: int, depth: int, classes: int, tried: _Tried):
    """(node, place, bin, counts) of a whole subtree; leaves have the place -1."""
    kept = np.flatnonzero(weight > 0)
    if not len(kept):
        return
    number = np.full(len(weight), -1, dtype=np.int32)
    number[kept] = np.arange(len(kept), dtype=np.int32)
    at = number[rows.row]
    in_bag = at >= 0
    row, place, zero, bin_ = at[in_bag], rows.place[in_bag], rows.zero[in_bag], rows.bin[in_bag]
    label, weight = label[kept], weight[kept]
    nodes, node = np.array([root], dtype=np.int64), np.zeros(len(kept), dtype=np.int32)
    while len(nodes):
        totals = np.bincount(node * classes + label, weight, len(nodes) * classes).reshape(-1, classes)
        split_place, split_bin, split_zero = np.full(len(nodes), -1), np.zeros(len(nodes), dtype=np.int64), np.zeros(len(nodes), dtype=np.int64)
        if depth:
            own = node[row]
            use = np.flatnonzero(((totals > 0).sum(1) > 1)[own] & tried.among(tried.of(tree, nodes), own, place))
            key = (own[use].astype(np.int64) * tried.width + place[use]) * BINS + bin_[use]
            keys, held = _counted(key, label[row[use]], weight[row[use]], classes)
            of_key = np.zeros(len(keys), dtype=np.uint8)
            of_key[np.searchsorted(keys, key)] = zero[use]
            found, *split = _best_splits(keys, held, of_key, totals, tried.width)
            split_place[found], split_bin[found], split_zero[found] = split
        yield nodes, split_place, split_bin, totals
        goes_right = (split_zero > split_bin)[node]
        hit = np.flatnonzero(place == split_place[node[row]])
        goes_right[row[hit]] = bin_[hit] > split_bin[node[row[hit]]]
        stays = split_place[node] >= 0
        children = np.cumsum(split_place >= 0) - 1
        node = (2 * children[node] + goes_right)[stays].astype(np.int32)
        nodes = (2 * nodes[split_place >= 0][:, None] + np.arange(2)[None, :]).ravel()
        number = (np.cumsum(stays) - 1).astype(np.int32)
        of_kept = stays[row]
        row, place, zero, bin_ = number[row[of_kept]], place[of_kept], zero[of_kept], bin_[of_kept]
        label, weight = label[stays], weight[stays]
        depth -= 1


def _cuts(train: DataFrame, rows: int) -> DataFrame:
    """(place, cuts): up to 31 upper ends of bins, quantiles of the different values of a feature, zero among them if a row has it."""
    shares = [i / BINS for i in range(1, BINS - 1)]
    values = train.select(F.explode(F.arrays_zip("e.indices", "e.values")).alias("x")).select(F.col("x.indices").alias("place"), F.col("x.values").alias("value"))
    values = values.groupBy("place", "value").agg(F.count("*").alias("n")).groupBy("place").agg(
        F.percentile_approx("value", shares, 1000).alias("cuts"), F.max("value").alias("high"), F.sum("n").alias("n")
    )
    zeros = F.col("n") < rows
    cuts = F.array_sort(F.array_distinct(F.when(zeros, F.concat("cuts", F.array(F.lit(0.0)))).otherwise(F.col("cuts"))))
    high = F.when(zeros, F.greatest("high", F.lit(0.0))).otherwise(F.col("high"))
    return values.select("place", F.filter(cuts, lambda c: c < high).alias("cuts"))


def _coded(rows: DataFrame, own: pa.Table) -> DataFrame:
    """(class, codes), a row each, where it lies. ``own`` has the cuts of places that are cut elsewhere than at zero alone."""
    order = np.argsort(own["place"].to_numpy(), kind="stable")
    sizes = pc.list_value_length(own["cuts"]).to_numpy()
    cuts = np.full((len(order), BINS), np.inf)
    flat = pc.list_flatten(own["cuts"]).to_numpy()
    cuts[np.repeat(np.arange(len(order)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    cuts, sizes = cuts[order], sizes[order]
    shared = rows.sparkSession.sparkContext.broadcast((own["place"].to_numpy()[order].astype(np.int64), cuts, sizes, (cuts < 0).sum(1)))

    def code(batches):
        places, cuts, sizes, zeros = shared.value
        for batch in batches:
            label, indices, values = batch.columns
            row = np.repeat(np.arange(len(label)), pc.list_value_length(indices).to_numpy(zero_copy_only=False))
            place, value = indices.flatten().to_numpy().astype(np.int64), values.flatten().to_numpy()
            zero, bin_, kept = np.zeros(len(place), dtype=np.int64), ((value > 0) | np.isnan(value)).astype(np.int64), np.ones(len(place), dtype=bool)
            at = np.searchsorted(places, place)
            known = np.flatnonzero(np.r_[places, -1][at] == place)
            for i in range(0, len(known), 1 << 16):  # little memory for what lies between
                some = known[i : i + (1 << 16)]
                cut = at[some]
                bin_[some] = np.where(np.isnan(value[some]), sizes[cut], (cuts[cut] < value[some][:, None]).sum(1))
                zero[some], kept[some] = zeros[cut], sizes[cut] > 0
            row, codes = row[kept], (place * 1024 + zero * 32 + bin_)[kept]
            if ((np.diff(codes) < 0) & (np.diff(row) == 0)).any():
                in_order = np.lexsort((codes, row))
                codes = codes[in_order]
            ends = np.r_[0, np.cumsum(np.bincount(row, minlength=len(label)))]
            yield pa.RecordBatch.from_arrays([label, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(codes, pa.int64()))], ["class", "codes"])

    return rows.select("class", "e.indices", "e.values").mapInArrow(code, "class int, codes array<bigint>")


def _coded_by_join(rows: DataFrame, cuts: DataFrame) -> DataFrame:
    """The same from any number of cuts. ``rows`` have numbers (``_row``)."""
    one = rows.select("_row", "class", F.explode_outer(F.arrays_zip("e.indices", "e.values")).alias("x"))
    one = one.select("_row", "class", F.col("x.indices").alias("place"), F.col("x.values").alias("value")).join(cuts, "place", "left")

    def below(value):
        return F.size(F.filter("cuts", lambda c: c < value)).cast("bigint")

    code = F.when(F.size("cuts") > 0, F.col("place").cast("bigint") * 1024 + below(F.lit(0.0)) * 32 + below(F.col("value")))
    coded = one.select("_row", "class", code.alias("code")).groupBy("_row", "class").agg(F.sort_array(F.collect_list("code")).alias("codes"))
    return coded.select("class", "codes")


def _binned(rows: DataFrame, cuts: DataFrame) -> DataFrame:
    """(class, codes, copies, row): equal rows once, named by a hash of what they hold."""
    own = cuts.where(F.size("cuts") != 1).unionByName(cuts.where((F.size("cuts") == 1) & (F.col("cuts")[0] != 0)))
    values = own.count() * BINS
    coded = _coded(rows, own.toArrow()) if values <= CUT_VALUES else _coded_by_join(rows, cuts)
    same = coded.groupBy("class", "codes").agg(F.count("*").alias("copies"))
    return same.withColumn("row", F.xxhash64("class", "codes"))


_CHUNK = {"label": np.int32, "place": np.int32, "entries": np.int32, "zero": np.uint8, "row": np.uint16, "bin": np.uint8, "totals": np.float64}


def _in_chunks(binned: DataFrame, trees: int, classes: int, seed: int) -> DataFrame:
    """Rows as chunks: their entries by place, and their weights in all trees."""
    most = max(1, min(CHUNK_ROWS, CHUNK_WEIGHTS // trees))

    def chunk(parts):
        label, row, copies = (np.concatenate([p[c].to_numpy() for p in parts]) for c in ("class", "row", "copies"))
        lengths = np.concatenate([pc.list_value_length(p["codes"]).to_numpy(zero_copy_only=False) for p in parts])
        code = np.concatenate([p["codes"].flatten().to_numpy() for p in parts])
        order = np.argsort(code >> 10, kind="stable")
        code, of_row = code[order], np.repeat(np.arange(len(label)), lengths)[order]
        first = np.flatnonzero(np.diff(code >> 10, prepend=-1))
        weights = [_times(seed, t, row, copies) for t in range(trees)]
        kind = np.uint8 if max(w.max() for w in weights) < 256 else np.float64
        held = {
            "label": label, "place": code[first] >> 10, "entries": np.diff(np.r_[first, len(code)]), "zero": code[first] >> 5 & 31, "row": of_row, "bin": code & 31,
            "totals": np.stack([np.bincount(label, w, classes) for w in weights]),
        }
        columns = [pa.array([np.ascontiguousarray(held[c], dtype=k).tobytes()], pa.binary()) for c, k in _CHUNK.items()]
        return pa.RecordBatch.from_arrays([*columns, pa.array([b"".join(w.astype(kind).tobytes() for w in weights)], pa.binary())], [*_CHUNK, "weights"])

    def pack(batches):
        parts, rows, entries = [], 0, 0
        for batch in batches:
            held = len(batch.column("codes").flatten())
            step = max(1, min(most, len(batch) * CHUNK_ENTRIES // max(held, 1), 10_000))
            for i in range(0, len(batch), step):
                part = batch.slice(i, step)
                here = len(part.column("codes").flatten())
                if parts and (rows + len(part) > most or entries + here > CHUNK_ENTRIES):
                    yield chunk(parts)
                    parts, rows, entries = [], 0, 0
                parts, rows, entries = [*parts, part], rows + len(part), entries + here
        if parts:
            yield chunk(parts)

    return binned.select("class", "codes", "copies", "row").mapInArrow(pack, ", ".join(f"{c} binary" for c in [*_CHUNK, "weights"]))


@dataclass
class _Above:
    """The upper part of a tree. Rows that a split leaves with those that have no entry at its place keep their mark, the others
    get a new one: (mark, place, bin, whether rows without an entry go right, new mark), from the root on."""

    splits: list = field(default_factory=list)
    open: dict = field(default_factory=dict)  # nodes to be split, by mark: (node, weights of the classes)
    small: dict = field(default_factory=dict)  # nodes whose rows are sent, by mark
    marks: int = 1


class _Chunk:
    def __init__(self, batch, i: int, trees: int):
        for c, kind in _CHUNK.items():
            setattr(self, c, np.frombuffer(batch.column(c)[i].as_buffer(), dtype=kind))
        weights, cells = batch.column("weights")[i].as_buffer(), trees * len(self.label)
        self.weights = np.frombuffer(weights, dtype=np.uint8 if weights.size == cells else np.float64).reshape(trees, -1)
        self.starts = np.r_[0, np.cumsum(self.entries, dtype=np.int64)]

    def marks(self, above: _Above) -> np.ndarray:
        """The mark of each row after the splits of a tree."""
        out = np.zeros(len(self.label), dtype=np.int32)
        if above.splits and len(self.place):
            wanted = np.array([s[1] for s in above.splits])
            at = np.minimum(np.searchsorted(self.place, wanted), len(self.place) - 1)
            for i in np.flatnonzero(self.place[at] == wanted):
                mark, _, cut, right, new = above.splits[i]
                one = slice(self.starts[at[i]], self.starts[at[i] + 1])
                other = self.row[one][(self.bin[one] <= cut) if right else (self.bin[one] > cut)]
                out[other[out[other] == mark]] = new
        return out

    def of_places(self, places: np.ndarray):
        """(entry, its place's number here) of some places, in order."""
        if not len(self.place):
            return (np.empty(0, dtype=np.int64),) * 2
        at = np.minimum(np.searchsorted(self.place, places), len(self.place) - 1)
        at = at[self.place[at] == places]
        n = self.starts[at + 1] - self.starts[at]
        return np.arange(n.sum()) + np.repeat(self.starts[at] - (np.cumsum(n) - n), n), np.repeat(at, n)

    def counted(self, tree: int, above: _Above, tried: _Tried, classes: int, drawn: dict):
        """(mark, keys, weights per key and class) of the open nodes; a key is (place * 32 + bin of zero) * BINS + bin."""
        marks, weight = self.marks(above), self.weights[tree]
        nodes = np.array([n for n, _ in above.open.values()], dtype=np.int64)
        if len(nodes) * tried.many * (len(self.row) + 20 * tried.width) < 2 * tried.width * len(self.row):
            for mark, node in zip(above.open, nodes):
                if (tree, mark) not in drawn:
                    drawn[tree, mark] = tried.places(*(int(x[0]) for x in tried.of(tree, np.array([node]))))
                entry, at = self.of_places(drawn[tree, mark])
                row = self.row[entry]
                use = np.flatnonzero((marks[row] == mark) & (weight[row] > 0))
                if len(use):
                    entry, at, row = entry[use], at[use], row[use]
                    key = (self.place[at].astype(np.int64) * 32 + self.zero[at]) * BINS + self.bin[entry]
                    yield mark, *_counted(key, self.label[row], weight[row], classes)
            return
        number = np.full(above.marks, -1, dtype=np.int64)
        number[list(above.open)] = np.arange(len(nodes))
        own = np.where(weight > 0, number[marks], -1)[self.row]
        at = np.repeat(np.arange(len(self.place)), self.entries)
        use = np.flatnonzero(own >= 0)
        use = use[tried.among(tried.of(tree, nodes), own[use], self.place[at[use]].astype(np.int64))]
        own, at, row = own[use], at[use], self.row[use]
        keys, held = _counted((own * len(self.place) + at) * BINS + self.bin[use], self.label[row], weight[row], classes)
        at, of = keys // BINS % max(len(self.place), 1), keys // BINS // max(len(self.place), 1)
        whole = (self.place[at].astype(np.int64) * 32 + self.zero[at]) * BINS + keys % BINS
        for i in np.unique(of):
            one = slice(*np.searchsorted(of, [i, i + 1]))
            yield list(above.open)[i], whole[one], held[one]


def _upper_parts(chunks: DataFrame, trees: int, classes: int, max_depth: int, rows: float, tried: _Tried):
    """(upper part of each tree, its nodes): nodes of more weight than ``rows`` are split from counts, level by level."""
    spark = chunks.sparkSession
    totals = np.zeros((trees, classes))
    for r in chunks.select("totals").toLocalIterator():
        totals += np.frombuffer(r[0]).reshape(trees, classes)
    done, upper = [], [_Above() for _ in range(trees)]

    def reached(tree, mark, node, counts, depth):
        if (counts > 0).sum() > 1 and depth < max_depth:
            if counts.sum() > rows:
                upper[tree].open[mark] = (node, counts)
            else:
                upper[tree].small[mark] = (node, counts)
        elif counts.sum():
            done.append((tree, node, -1, 0, counts.tolist()))

    for t in range(trees):
        reached(t, 0, 1, totals[t], 0)
    for depth in range(max_depth):
        if not any(a.open for a in upper):
            break
        shared = spark.sparkContext.broadcast(upper)

        def count(batches):
            drawn: dict = {}
            for batch in batches:
                for i in range(len(batch)):
                    chunk, out = _Chunk(batch, i, trees), []
                    for t, above in enumerate(shared.value):
                        if above.open:
                            out += [(t, mark, keys.tobytes(), held.tobytes()) for mark, keys, held in chunk.counted(t, above, tried, classes, drawn)]
                    if out:
                        kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary())
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], ["tree", "mark", "keys", "held"])

        def choose(pdf):
            tree, mark = int(pdf["tree"].iloc[0]), int(pdf["mark"].iloc[0])
            whole = shared.value[tree].open[mark][1][None, :]
            keys, at = np.unique(np.frombuffer(b"".join(pdf["keys"]), dtype=np.int64), return_inverse=True)
            parts, held = np.frombuffer(b"".join(pdf["held"])).reshape(-1, classes), np.empty((len(keys), classes))
            for c in range(classes):
                held[:, c] = np.bincount(at, parts[:, c], len(keys))
            places, bins, zeros = keys // BINS // 32, keys % BINS, keys // BINS % 32
            found, *split = _best_splits(places * BINS + bins, held, zeros, whole, tried.width)
            if not len(found):
                return pd.DataFrame({c: pd.Series(dtype=object) for c in ("tree", "mark", "place", "bin", "zero", "left")})
            place, bin_, zero = (int(s[0]) for s in split)
            here = places == place
            left = held[here & (bins <= bin_)].sum(0) + (zero <= bin_) * (whole[0] - held[here].sum(0))
            return pd.DataFrame({"tree": [tree], "mark": [mark], "place": [place], "bin": [bin_], "zero": [zero], "left": [left]})

        counted = chunks.mapInArrow(count, "tree int, mark int, keys binary, held binary").groupBy("tree", "mark")
        splits = {(r["tree"], r["mark"]): r for r in counted.applyInPandas(choose, "tree int, mark int, place int, bin int, zero int, left array<double>").collect()}
        shared.destroy()
        del counted
        release_shuffles(spark)
        for t, above in enumerate(upper):
            was, above.open = above.open, {}
            for mark, (node, counts) in was.items():
                if (r := splits.get((t, mark))) is None:
                    done.append((t, node, -1, 0, counts.tolist()))
                    continue
                done.append((t, node, r["place"], r["bin"], None))
                left, right = np.array(r["left"]), r["zero"] > r["bin"]
                above.splits.append((mark, r["place"], r["bin"], right, above.marks))
                reached(t, above.marks if right else mark, 2 * node, left, depth + 1)
                reached(t, mark if right else above.marks, 2 * node + 1, counts - left, depth + 1)
                above.marks += 1
    return upper, done


def _sent(chunks: DataFrame, upper: list[_Above], some: list[int]) -> DataFrame:
    """(trees, node, class, codes, weight) of the rows in small nodes of some trees."""
    shared = chunks.sparkSession.sparkContext.broadcast(({t: upper[t] for t in some}, len(upper)))

    def send(batches):
        parts, trees = shared.value
        for batch in batches:
            for i in range(len(batch)):
                chunk = _Chunk(batch, i, trees)
                order = np.argsort(chunk.row, kind="stable")
                at = np.repeat(np.arange(len(chunk.place)), chunk.entries)[order]
                codes = chunk.place[at].astype(np.int64) * 1024 + chunk.zero[at].astype(np.int64) * 32 + chunk.bin[order]
                n = np.bincount(chunk.row, minlength=len(chunk.label))
                starts = np.cumsum(n) - n
                for t, above in parts.items():
                    node = np.zeros(above.marks, dtype=np.int64)
                    node[list(above.small)] = [x for x, _ in above.small.values()]
                    node = np.where(chunk.weights[t] > 0, node[chunk.marks(above)], 0)
                    rows = np.flatnonzero(node)
                    if len(rows):
                        many = n[rows]
                        ends = np.r_[0, np.cumsum(many)]
                        held = codes[np.arange(ends[-1]) + np.repeat(starts[rows] - ends[:-1], many)]
                        columns = [
                            pa.array(np.full(len(rows), t), pa.int32()), pa.array(node[rows]), pa.array(chunk.label[rows], pa.int32()),
                            pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(held, pa.int64())), pa.array(chunk.weights[t][rows].astype(np.float64)),
                        ]
                        yield pa.RecordBatch.from_arrays(columns, ["tree", "node", "class", "codes", "weight"])

    sent = chunks.mapInArrow(send, "tree int, node bigint, class int, codes array<bigint>, weight double")
    return sent.withColumn("trees", F.array("tree"))


def grown(train: DataFrame, features: str, label: str, trees: int, max_depth: int, seed: int) -> Forest:
    """Train on ``train`` (label: whole numbers from 0, features: ML vectors)."""
    with ExitStack() as held:
        return _grown(train, features, label, trees, max_depth, seed, held)


def _grown(train: DataFrame, features: str, label: str, trees: int, max_depth: int, seed: int, kept: ExitStack) -> Forest:
    spark = train.sparkSession
    with ExitStack() as until_binned:
        rows = train.select(F.col(label).cast("int").alias("class"), entries(F.col(features)).alias("e")).withColumn("_row", F.monotonically_increasing_id())
        rows = until_binned.enter_context(stored(rows))
        seen = rows.agg(F.max("class"), F.max("e.size"), F.sum(F.size("e.indices")), F.min("class"), F.count("*"), F.count("class"), F.count("e")).first()
        if not seen[4] or seen[4] != seen[5] or seen[4] != seen[6] or seen[3] < 0:
            raise ValueError("training rows need features and labels from 0 on")
        classes, width = seen[0] + 1, seen[1]
        cuts = kept.enter_context(stored(_cuts(rows, seen[4])))
        until_packed = kept.enter_context(ExitStack())
        binned, tried = until_packed.enter_context(stored(_binned(rows, cuts))), _Tried(max(width, 1), seed)
    n, held = binned.agg(F.count("*"), F.coalesce(F.sum(F.size("codes")), F.lit(0))).first()
    wide = tried.width >= WIDE * tried.many
    node_rows = max(1, int(LOCAL_ENTRIES // (WIDE_LESS if wide else 1) * n // max(held, 1)))
    shared = n <= node_rows

    def grow(pdf):
        rows, y, root = _Rows(pdf["codes"].to_numpy()), pdf["class"].to_numpy().astype(np.int64), int(pdf["node"].iloc[0])
        out = []
        for t in pdf["trees"].iloc[0]:
            weight = _times(seed, int(t), pdf["row"].to_numpy(), pdf["copies"].to_numpy()) if shared else pdf["weight"].to_numpy()
            for nodes, place, bin_, totals in _grow(rows, y, weight, int(t), root, max_depth + 1 - root.bit_length(), classes, tried):
                leaf = place < 0
                counts = np.empty(len(nodes), dtype=object)
                for i in np.flatnonzero(leaf):
                    counts[i] = totals[i]
                out.append(pd.DataFrame({"tree": np.int32(t), "node": nodes, "place": place.astype(np.int32), "bin": bin_.astype(np.int32), "counts": counts}))
        return pd.concat(out) if out else pd.DataFrame({c: [] for c in ("tree", "node", "place", "bin", "counts")})

    if shared:
        each = max(1, min(WALK_TREES, trees // (2 * spark.sparkContext.defaultParallelism)))
        groups = F.array(*(F.array(*(F.lit(t) for t in range(i, min(i + each, trees)))) for i in range(0, trees, each)))
        units = binned.select("*", F.explode(groups).alias("trees"), F.lit(1).cast("bigint").alias("node"))
        found = units.groupBy("trees", "node").applyInPandas(grow, _NODE)
    else:
        # few chunks in a row group: a task reads one at a time
        few = {"parquet.block.size": str(32 << 20), "parquet.block.size.row.check.min": "1", "parquet.page.size.row.check.min": "1"}
        chunks = kept.enter_context(stored(_in_chunks(binned, trees, classes, seed), **few))
        until_packed.close()
        small = min(node_rows, tried.many * chunks.count() * n // max(held, 1)) if wide else node_rows
        upper, done = _upper_parts(chunks, trees, classes, max_depth, small, tried)
        found, some, weight = spark.createDataFrame(done, _NODE), [], 0.0
        for t, above in enumerate(upper):
            some, weight = [*some, t], weight + sum(c.sum() for _, c in above.small.values())
            if weight and (t == trees - 1 or weight > SENT * n):
                grew = _sent(chunks, upper, some).groupBy("trees", "node").applyInPandas(grow, _NODE)
                found = found.unionByName(kept.enter_context(stored(grew)))
                some, weight = [], 0.0
                del grew
    named = found.join(cuts, "place", "left").select("tree", "node", "place", F.get("cuts", F.col("bin")).alias("cut"), F.when(F.col("place") < 0, F.col("counts")).alias("counts"))
    return Forest(cut_lineage(named), trees, classes, features)


def _trees(nodes: pd.DataFrame, classes: int) -> dict:
    """(nodes, places, cuts, shares of the classes) by tree; only leaves have shares."""
    out = {}
    for t, one in nodes.groupby("tree"):
        one = one.sort_values("node")
        places, shares = one["place"].to_numpy(), np.zeros((len(one), classes))
        counts = np.stack(one["counts"].to_numpy()[places < 0]).astype(np.float64)
        shares[places < 0] = counts / counts.sum(1, keepdims=True)
        out[int(t)] = (one["node"].to_numpy(), places, one["cut"].to_numpy(), shares)
    return out


def _walked(indices: pd.Series, values: pd.Series, trees: list, classes: int) -> np.ndarray:
    """The trees' votes for rows."""
    lengths = np.fromiter((len(x) for x in indices), dtype=np.int64, count=len(indices))
    place = np.concatenate([*indices, np.empty(0)]).astype(np.int64)
    value = np.concatenate([*values, [np.nan]])
    wide = max([int(place.max(initial=0)), *(int(places.max()) for _, places, _, _ in trees)]) + 1
    key = np.r_[np.repeat(np.arange(len(indices)), lengths) * wide + place, np.iinfo(np.int64).max]
    votes = np.zeros((len(indices), classes))
    for ids, places, cuts, shares in trees:
        at = np.zeros(len(indices), dtype=np.int64)
        going = np.flatnonzero(places[at] >= 0)
        while len(going):
            wanted = going * wide + places[at[going]]
            found = np.searchsorted(key, wanted)
            x = np.where(key[found] == wanted, value[found], 0.0)
            at[going] = np.searchsorted(ids, 2 * ids[at[going]] + (~(x <= cuts[at[going]])).astype(np.int64))
            going = going[places[at[going]] >= 0]
        votes += shares[at]
    return votes


@dataclass
class Forest:
    """A table of nodes: (tree, node, place, cut, counts); the children of node i are 2 i (values up to the cut) and 2 i + 1.
    A leaf has the place -1 and the weights of its classes."""

    nodes: DataFrame
    trees: int
    classes: int
    features: str

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with rawPrediction, probability and prediction, the mean of the trees' shares of classes. Rows stay where they are and a
        forest of bounded size goes to them; of a larger one, trees and rows meet in groups of bounded size."""
        if self.nodes.count() <= WALK_NODES:
            e = entries(F.col(self.features))
            rows = df.withColumn("votes", self._votes()(e["indices"], e["values"]))
        else:
            numbered = cut_lineage(df.withColumn("_row", F.monotonically_increasing_id()))
            rows = numbered.join(self._votes_in_groups(numbered), "_row", "left").drop("_row")
        total = F.aggregate("votes", F.lit(0.0), lambda x, y: x + y)
        chance = F.transform("votes", lambda v: v / total)
        rows = rows.withColumns(
            {"rawPrediction": array_to_vector("votes"), "probability": array_to_vector(chance), "prediction": (F.array_position("votes", F.array_max("votes")) - 1).cast("double")}
        )
        return stored_at(rows.drop("votes"))[0]

    def _votes(self):
        """Votes by places and values, from the whole forest."""
        classes = self.classes
        trees = _trees(self.nodes.toArrow().to_pandas(), classes)
        shared = self.nodes.sparkSession.sparkContext.broadcast(trees)

        @F.pandas_udf("array<double>")
        def votes(indices: pd.Series, values: pd.Series) -> pd.Series:
            out = np.zeros((len(indices), classes))
            groups: dict = {}
            for t, tree in shared.value.items():
                groups.setdefault(t // WALK_TREES, []).append(tree)
            for g in sorted(groups):
                out += _walked(indices, values, groups[g], classes)
            return pd.Series(list(out))

        return votes

    def _votes_in_groups(self, rows: DataFrame) -> DataFrame:
        """(_row, votes) of numbered rows."""
        chunks = -(-rows.count() // WALK_ROWS) or 1
        groups = -(-self.trees // WALK_TREES)
        held = rows.select("_row", entries(F.col(self.features)).alias("e"), F.pmod(F.xxhash64("_row"), F.lit(chunks)).alias("chunk"))
        asked = held.select("chunk", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"), "_row", "e.indices", "e.values")
        group = F.floor(F.col("tree") / WALK_TREES).cast("int")
        walked = self.nodes.select(F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(chunks - 1).cast("bigint"))).alias("chunk"), group.alias("group"), "tree", "node", "place", "cut", "counts")
        classes = self.classes

        def walk(q: pd.DataFrame, forest: pd.DataFrame) -> pd.DataFrame:
            if not len(q) or not len(forest):
                return pd.DataFrame({"_row": [], "group": [], "votes": []})
            votes = _walked(q["indices"], q["values"], [*_trees(forest, classes).values()], classes)
            return pd.DataFrame({"_row": q["_row"], "group": q["group"], "votes": list(votes)})

        found = asked.groupBy("chunk", "group").cogroup(walked.groupBy("chunk", "group")).applyInPandas(walk, "_row bigint, group int, votes array<double>")
        nothing = F.array_repeat(F.lit(0.0), classes)
        return found.groupBy("_row").agg(F.sort_array(F.collect_list(F.struct("group", "votes"))).alias("g")).select(
            "_row", F.aggregate("g", nothing, lambda x, g: F.zip_with(x, g["votes"], lambda a, b: a + b)).alias("votes")
        )

    def save(self, path: str) -> None:
        """Numbers as one JSON line, nodes as Parquet."""
        plain = {k: v for k, v in self.__dict__.items() if k != "nodes"}
        self.nodes.write.mode("overwrite").parquet(f"{path}/nodes")
        self.nodes.sparkSession.createDataFrame([(json.dumps(plain),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/model")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Forest:
        plain = json.loads(spark.read.text(f"{path}/model").first()[0])
        return cls(nodes=spark.read.parquet(f"{path}/nodes"), **plain)
