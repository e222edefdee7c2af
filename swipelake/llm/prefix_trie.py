"""Prefix trie of conversations in double arrays, one per shard of prefixes.

A conversation is rebuilt as the first turns of another one and the rest of its own; a node of the trie is a sequence of turns
that at least one rebuilt conversation begins with.

1. Turns become tokens (120 bits of the SHA-256 of role and text), are put in order by ranges of (conversation, turn) and numbered
   there, so a conversation that holds a third of all turns is spread over many tasks.
2. Rebuilt conversations are cut in segments of SEGMENT turns, named by the digest of all turns before them. Equal segments of
   one name are one path with a count and a least member, so copies cost nothing.
3. A path belongs to the shard of its shortest prefix (of 1, 2, 4, ... turns) under which at most SHARD_TURNS turns lie. All paths
   through a node below that prefix are in the shard; nodes above it are shared by several shards.
4. Shards are dealt to buckets. A bucket numbers its tokens densely, packs BASE and CHECK arrays (a child of state s by token
   c is state t = BASE[s] + c with CHECK[t] = s), walks its paths through them, and has the nodes below the shards' prefixes
   complete, subtrees included. Of shared nodes it gives its part.
5. The parts of shared nodes are merged globally, and what lies below them is summed up along their paths. What lies in
   later segments is summed up by pointer doubling over segments, so a very long conversation takes few rounds.

Members that end at a node are joined in blocks of ids and the blocks are hashed one after the other: the one step that can't
be spread, as SHA-256 reads its input in order, gets ready-made text and holds one block.

Cases: conversations are ordered by turn, null first, then by token (so ties and repeated rows have one order; repeated rows are
turns of their own). Null role or text is empty. Rows without conv_id belong to no conversation. A rebuilt conversation without
turns is a member of the root alone. An empty table has no members, so no rows. conv_id and turn are whole numbers. Further
columns are not read.
"""

from __future__ import annotations

import hashlib
from base64 import b64encode
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from swipelake.llm.common import small, store

ROOT = ""
NAME = 20  # characters of a token's and a node's name: base 64 of 15 bytes
SEGMENT = 256  # turns of a path at most
SHARD_TURNS = 1 << 16  # of the paths of a shard, and of a bucket on average
TRIES = 32  # places tried for the children of a node before they go to the end of the arrays
ID_BLOCK = 4096  # conversations whose ids are joined to one text

# How conversations are rebuilt. The first turns come from the conversation whose number is the next lower multiple of FAMILY.
FAMILY, HEADS = 5, 9


def name(text: Column) -> Column:
    return F.base64(F.substring(F.unhex(F.sha2(text, 256)), 1, 15))


def head_turns(conv: Column) -> Column:
    """How many first turns a conversation takes over."""
    return (F.crc32(conv.cast("string").cast("binary")) % HEADS).cast("int")


def numbered_turns(turns: DataFrame) -> DataFrame:
    """conv, part, place (in the part), token, size; sorted and numbered within ranges, stored."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = turns.where("conv is not null").select(
        "conv", "turn", name(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)).alias("token"), F.octet_length(text).cast("bigint").alias("size"), F.monotonically_increasing_id().alias("row")
    )
    order = ["conv", "turn", "token", "row"]
    ranges = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, seen = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            conv = batch.column(0).to_numpy()
            if not len(conv):
                continue
            starts = np.flatnonzero(np.r_[conv[0] != last, conv[1:] != conv[:-1]])
            begun = np.zeros(len(conv), dtype=np.int64)
            begun[starts] = starts
            place = np.arange(len(conv)) - np.maximum.accumulate(begun)
            if conv[0] == last:
                place[: starts[0] if len(starts) else len(conv)] += seen
            last, seen = conv[-1], place[-1] + 1
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.full(len(conv), part)), pa.array(place), batch.column(2), batch.column(3)], ["conv", "part", "place", "token", "size"])

    sorted_rows = rows.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    return store(sorted_rows.mapInArrow(number, "conv long, part long, place long, token string, size long"))


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (conv, place, token, size) of all rebuilt conversations, and (conv, turns) of all of them, stored."""
    rows = numbered_turns(turns)
    parts = rows.groupBy("conv", "part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    # A range goes on with at most one conversation of the ranges before it: at most a row per range.
    later = F.broadcast(parts.withColumn("before", before).where("before is not null").drop("n"))
    rows = rows.join(later, ["conv", "part"], "left").select("conv", (F.col("place") + F.coalesce("before", F.lit(0))).alias("place"), "token", "size")
    own = parts.groupBy("conv").agg(F.sum("n").alias("n"))
    family = F.col("conv") - F.col("conv") % FAMILY
    giving = own.select(F.col("conv").alias("giver"), F.col("n").alias("given"))
    h = head_turns(F.col("conv"))
    convs = store(
        own.join(giving, family == F.col("giver"), "left")
        .select("conv", F.least(h, F.coalesce("given", F.lit(0))).cast("bigint").alias("head"), F.greatest(F.col("n") - h, F.lit(0)).alias("rest"))
        .select("conv", "head", (F.col("head") + F.col("rest")).alias("turns"))
    )
    shifted = convs.where(F.col("head") < h).select("conv", (F.col("head") - h).alias("shift"))
    rest = rows.where(F.col("place") >= h).join(shifted, "conv", "left").select("conv", (F.col("place") + F.coalesce("shift", F.lit(0))).alias("place"), "token", "size")
    others = F.explode(F.array(*(F.lit(i) for i in range(1 - FAMILY, FAMILY))))
    heads = rows.where((F.col("place") < HEADS - 1) & (F.col("conv") % FAMILY == 0)).select(F.col("conv").alias("giver"), others.alias("other"), "place", "token", "size")
    heads = heads.select(F.try_add("giver", "other").alias("conv"), "giver", "place", "token", "size").where((family == F.col("giver")) & (F.col("place") < h))
    heads = heads.drop("giver").join(convs.select("conv"), "conv", "left_semi")
    return rest.unionByName(heads), convs


def segments(rows: DataFrame, convs: DataFrame, segment: int) -> DataFrame:
    """conv, seg, tokens (joined), sizes, last, up (the name of all turns before), stored; a row without tokens where there are no turns."""
    cut = rows.groupBy("conv", F.floor(F.col("place") / segment).alias("seg")).agg(F.array_sort(F.collect_list(F.struct("place", "token", "size"))).alias("held"))
    cut = cut.select("conv", "seg", F.array_join(F.col("held.token"), "").alias("tokens"), F.col("held.size").alias("sizes"))
    cut = convs.select("conv", "turns").join(cut, "conv", "left").select(
        "conv", F.coalesce("seg", F.lit(0)).alias("seg"), F.coalesce("tokens", F.lit("")).alias("tokens"),
        F.coalesce("sizes", F.array().cast("array<bigint>")).alias("sizes"), (F.coalesce("seg", F.lit(0)) >= F.floor((F.col("turns") - 1) / segment)).alias("last"),
    )
    cut = store(cut)
    several = cut.where("not (seg = 0 and last)")
    digests = several.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("seg", name(F.col("tokens")).alias("name")))).alias("all"))

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for conv, names in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ups = [ROOT]
                for x in names[:-1]:
                    ups.append(named(ups[-1], x))
                yield pa.RecordBatch.from_arrays([pa.array([conv] * len(ups)), pa.array(range(len(ups)), pa.int64()), pa.array(ups)], ["conv", "seg", "up"])

    ups = digests.select("conv", F.col("all.name").alias("names")).mapInArrow(chain, "conv long, seg long, up string")
    later = several.join(ups, ["conv", "seg"])
    return cut.where("seg = 0 and last").withColumn("up", F.lit(ROOT)).unionByName(later)


def named(up: str, tokens_name: str) -> str:
    """The name of the node that tokens of that name lead to from the node ``up``."""
    return b64encode(hashlib.sha256(f"{up}/{tokens_name}".encode()).digest()[:15]).decode()


def node_name(up: Column, tokens: Column) -> Column:
    return F.when(tokens == "", up).otherwise(name(F.concat(up, F.lit("/"), name(tokens))))


def with_shards(paths: DataFrame, segment: int, shard_turns: int) -> DataFrame:
    """Adds cut (turns of the shard's prefix; 0 if none is small enough) and bucket."""
    turns = F.greatest(F.length("tokens") / NAME, F.lit(1))
    total = int(paths.agg(F.sum(turns)).first()[0] or 0)
    tasks = int(paths.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shard_turns = max(segment, min(shard_turns, total // (4 * tasks)))  # few turns are spread as evenly
    buckets = max(tasks, -(-total // shard_turns))
    paths = paths.withColumn("cut", F.lit(0)).withColumn("shard", F.xxhash64("up", "tokens"))
    k = 1
    while True:
        prefix = F.xxhash64("up", F.lit(k), F.substring("tokens", 1, NAME * k))
        open_here = (F.col("cut") == 0) & (F.length("tokens") >= NAME * k)
        large = store(paths.where(open_here).groupBy(prefix.alias("large")).agg(F.sum(turns).alias("n")).where(F.col("n") > shard_turns).select("large"))
        paths = paths.withColumn("prefix", F.when(open_here, prefix)).join(small(large), F.col("prefix") == F.col("large"), "left")
        fits = F.col("prefix").isNotNull() & F.col("large").isNull()
        paths = paths.withColumn("cut", F.when(fits, k).otherwise(F.col("cut"))).withColumn("shard", F.when(fits, F.col("prefix")).otherwise(F.col("shard"))).drop("prefix", "large")
        if k >= segment or not large.head(1):
            return paths.withColumn("bucket", F.pmod("shard", F.lit(buckets))).drop("shard")
        k = min(2 * k, segment)


class DoubleArray:
    """BASE and CHECK of a trie whose tokens are dense whole numbers from 0; state 0 is its start."""

    def __init__(self) -> None:
        self.base, self.check, self.free = [0], [0], 1

    def place(self, state: int, tokens: list[int]) -> None:
        """Room for the children of a state by these ascending tokens."""
        check, at = self.check, self.free
        while at < len(check) and check[at] >= 0:
            at += 1
        self.free = at
        for _ in range(TRIES):
            if at >= len(check) or all(at + t - tokens[0] >= len(check) or check[at + t - tokens[0]] < 0 for t in tokens):
                break
            at += 1
            while at < len(check) and check[at] >= 0:
                at += 1
        else:
            at = len(check)
        base = self.base[state] = at - tokens[0]
        more = base + tokens[-1] + 1 - len(check)
        if more > 0:
            check.extend([-1] * more)
            self.base.extend([0] * more)
        for t in tokens:
            check[base + t] = state

    @classmethod
    def of(cls, flat: np.ndarray, first: np.ndarray, length: np.ndarray) -> DoubleArray:
        """Of paths that lie one after the other in ``flat``, packed level by level."""
        out, state = cls(), np.zeros(len(first), dtype=np.int64)
        for r in range(int(length.max(initial=0))):
            on = np.flatnonzero(length > r)
            edges = np.unique(np.stack([state[on], flat[first[on] + r]]), axis=1)
            starts = np.flatnonzero(np.diff(edges[0], prepend=-1))
            for a, b in zip(starts, [*starts[1:], edges.shape[1]]):
                out.place(int(edges[0, a]), edges[1, a:b].tolist())
            state[on] = np.array(out.base)[state[on]] + flat[first[on] + r]
        return out


NODE = "kind int, id string, parent string, up string, seg long, depth long, n long, least long, parent_least long, size long, kids long, leaves long, saved long, path array<string>"
LOWER, SHARED, OPEN, ABOVE = range(4)  # complete; a part of a shared node; complete, but goes on in the next segment; a node above one of these (its id in parent)


def walk(paths: pa.Table, segment: int) -> pa.Table:
    """The nodes of one bucket."""
    ups, tokens, sizes, cut, seg = (paths.column(c).to_pylist() for c in ("up", "tokens", "sizes", "cut", "seg"))
    weight, least, on = (paths.column(c).to_numpy() for c in ("n", "least", "going_on"))
    cut, seg = np.array(cut), np.array(seg)
    length = np.array([len(s) + 1 for s in sizes])
    first = np.cumsum(length) - length
    words = [w for up, t in zip(ups, tokens) for w in (f"^{up}", *(t[i : i + NAME] for i in range(0, len(t), NAME)))]
    flat = np.unique(np.array(words), return_inverse=True)[1].astype(np.int64)
    trie = DoubleArray.of(flat, first, length)
    base, check = np.array(trie.base), np.array(trie.check)
    states = len(check)
    n, goes, size, depth, segs = (np.zeros(states, dtype=np.int64) for _ in range(5))
    low = np.full(states, np.iinfo(np.int64).max)
    shared = np.zeros(states, dtype=bool)
    ids, up_of = [ROOT] * states, [ROOT] * states
    state = np.zeros(len(first), dtype=np.int64)
    flat_sizes = np.array([x for s in sizes for x in (0, *s)], dtype=np.int64)
    for r in range(int(length.max(initial=0))):
        live = np.flatnonzero(length > r)
        at = base[state[live]] + flat[first[live] + r]
        if not (check[at] == state[live]).all():
            raise AssertionError("a path left the trie")
        state[live] = at
        np.add.at(n, at, weight[live])
        np.minimum.at(low, at, least[live])
        size[at], depth[at], segs[at] = flat_sizes[first[live] + r], r, seg[live]
        shared[at] = (cut[live] == 0) | (r < cut[live])
    np.add.at(goes, state, on)
    seen: set[int] = set()
    for i, (up, t) in enumerate(zip(ups, tokens)):  # names, once per node
        s, so_far = int(base[0] + flat[first[i]]), hashlib.sha256()
        ids[s] = up_of[s] = up
        for r in range(1, length[i]):
            s = int(base[s] + flat[first[i] + r])
            so_far.update(t[(r - 1) * NAME : r * NAME].encode())
            if s not in seen:
                seen.add(s)
                ids[s], up_of[s] = named(up, b64encode(so_far.digest()[:15]).decode()), up
    live = np.flatnonzero(check >= 0)[1:]  # without the start
    inner = live[depth[live] > 0]
    parent = check
    kids = np.bincount(parent[inner][~shared[inner]], minlength=states)
    childless = np.bincount(parent[inner], minlength=states) == 0
    leaves = (~shared & childless & (goes == 0)).astype(np.int64)
    saved = np.where(shared, 0, (n - 1) * size)
    for d in range(int(depth.max(initial=0)), 0, -1):  # a shared node gets what its complete children have
        here = inner[(depth[inner] == d) & ~shared[inner]]
        np.add.at(leaves, parent[here], leaves[here])
        np.add.at(saved, parent[here], saved[here])
    out: dict[str, list] = {f.split()[0]: [] for f in NODE.split(", ")}

    def give(*values) -> None:
        for column, v in zip(out.values(), values):
            column.append(v)

    for s in live.tolist():
        p = int(parent[s]) if depth[s] else -1
        kind = SHARED if shared[s] else OPEN if goes[s] else LOWER
        line = []
        if kind != LOWER:
            q = s
            while q:
                line.append(q)
                q = int(parent[q]) if depth[q] else 0
        above = int(low[p]) if p >= 0 and not shared[p] else None
        path = [ids[q] for q in line] if kind == SHARED else None
        give(kind, ids[s], ids[p] if p >= 0 else None, up_of[s], int(segs[s]), int(segs[s]) * segment + int(depth[s]), int(n[s]), int(low[s]), above, int(size[s]), int(kids[s]), int(leaves[s]), int(saved[s]), path)
        if kind == OPEN:
            for q in line[1:]:
                if depth[q] or not segs[q]:
                    give(ABOVE, ids[q], ids[s], None, 0, 0, 0, 0, None, 0, 0, 0, 0, None)
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "array<string>": pa.list_(pa.string())}
    return pa.table({c: pa.array(out[c], kinds[t]) for c, t in (f.split() for f in NODE.split(", "))})


def shared_nodes(found: DataFrame) -> DataFrame:
    """The merged shared nodes: id, parent, up, seg, depth, n, least, size, n_children, leaves, saved; subtrees without later segments."""
    merged = store(
        found.where(F.col("kind") == SHARED)
        .groupBy("id")
        .agg(*(F.min(c).alias(c) for c in ("parent", "up", "seg", "depth", "least", "size")), *(F.sum(c).alias(c) for c in ("n", "kids", "leaves", "saved")), F.first("path").alias("path"))
    )
    children = merged.where("parent is not null").groupBy(F.col("parent").alias("id")).agg(F.count("*").alias("more"))
    merged = merged.join(children, "id", "left").withColumn("n_children", F.col("kids") + F.coalesce("more", F.lit(0)))
    own = merged.select(F.explode("path").alias("id"), (F.col("leaves") + (F.col("n_children") == 0).cast("int")).alias("leaves"), (F.col("saved") + (F.col("n") - 1) * F.col("size")).alias("saved"))
    below = own.groupBy("id").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    return store(merged.drop("leaves", "saved", "kids", "more", "path").join(below, "id"))


def later_segments(starts: DataFrame, opens: DataFrame) -> DataFrame:
    """id, n_children, leaves, saved of the nodes at which segments begin, all later segments included.

    In round r every start has the sums of the starts less than 2^r segments below it and the name of that one 2^r above it.
    """
    above = opens.select("id", F.when(F.col("seg") > 0, F.col("up")).alias("above"))
    now = store(starts.select("id", "n_children", "leaves", "saved").join(above, "id", "left"))
    while now.where("above is not null").head(1):
        more = now.where("above is not null").groupBy(F.col("above").alias("id")).agg(F.sum("leaves").alias("l"), F.sum("saved").alias("s"))
        higher = now.select(F.col("id").alias("above"), F.col("above").alias("higher"))
        now = store(
            now.join(more, "id", "left").join(higher, "above", "left")
            .select("id", "n_children", (F.col("leaves") + F.coalesce("l", F.lit(0))).alias("leaves"), (F.col("saved") + F.coalesce("s", F.lit(0))).alias("saved"), F.col("higher").alias("above"))
        )
    return now


def end_digests(segs: DataFrame) -> DataFrame:
    """id, ends_sha256 of the nodes at which some conversation ends."""
    blocks = (
        segs.where("last")
        .select(node_name(F.col("up"), F.col("tokens")).alias("id"), F.floor(F.col("conv") / ID_BLOCK).alias("block"), "conv")
        .groupBy("id", "block")
        .agg(F.array_join(F.transform(F.sort_array(F.collect_list("conv")), lambda c: c.cast("string")), ",").alias("ids"))
    )

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            done: list[tuple[str, str]] = []
            for at, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if at != node:
                    if state:
                        done.append((node, state.hexdigest()))
                    node, state = at, hashlib.sha256(ids.encode())
                else:
                    state.update(f",{ids}".encode())
            yield pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], pa.string()) for i in (0, 1)], ["id", "ends_sha256"])
        if state:
            yield pa.RecordBatch.from_arrays([pa.array([node]), pa.array([state.hexdigest()])], ["id", "ends_sha256"])

    return blocks.repartition("id").sortWithinPartitions("id", "block").mapInArrow(digest, "id string, ends_sha256 string")


def nodes(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", segment: int = SEGMENT, shard_turns: int = SHARD_TURNS
) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256; one row per node."""
    if shard_turns < segment:
        raise ValueError("a shard has room for one segment at least")
    turns = turns.select(F.col(conv).cast("bigint").alias("conv"), F.col(turn).cast("bigint").alias("turn"), F.col(role).alias("role"), F.col(text).alias("text"))
    segs = store(segments(*rebuilt(turns), segment))
    paths = store(
        segs.groupBy("up", "seg", "tokens").agg(F.first("sizes").alias("sizes"), F.count("*").alias("n"), F.min("conv").alias("least"), F.sum((~F.col("last")).cast("bigint")).alias("going_on"))
    )
    found = store(with_shards(paths, segment, shard_turns).groupBy("bucket").applyInArrow(lambda group: walk(group, segment), NODE))
    shared = shared_nodes(found)
    columns = ["id", "parent", "depth", "n", "least", "parent_least", "n_children", "leaves", "saved"]
    complete = found.where(F.col("kind") == LOWER).withColumnRenamed("kids", "n_children").select(*columns)
    tops = shared.where("seg = 0 or parent is not null").withColumn("parent_least", F.lit(None).cast("bigint")).select(*columns)
    opens = found.where(F.col("kind") == OPEN)
    every = complete.unionByName(tops)
    known = tops.select("id", "least")
    if opens.head(1):
        later = later_segments(shared.where("seg > 0 and parent is null"), opens)
        begun = opens.select(*(c for c in columns if c not in ("n_children", "leaves")), "size").join(later.select("id", "n_children", "leaves", F.col("saved").alias("below")), "id")
        begun = begun.withColumn("saved", F.col("saved") + F.col("below")).select(*columns)
        added = found.where(F.col("kind") == ABOVE).select("id", F.col("parent").alias("start")).join(later.select(F.col("id").alias("start"), "leaves", "saved"), "start")
        added = added.groupBy("id").agg(F.sum("leaves").alias("l"), F.sum("saved").alias("s"))
        every = every.join(added, "id", "left").withColumn("leaves", F.col("leaves") + F.coalesce("l", F.lit(0))).withColumn("saved", F.col("saved") + F.coalesce("s", F.lit(0))).select(*columns)
        every = every.unionByName(begun)
        known = known.unionByName(begun.select("id", "least"))
    above = small(store(known.select(F.col("id").alias("parent"), F.col("least").alias("shared_least"))))
    every = every.join(above, "parent", "left").join(end_digests(segs), "id", "left")
    return every.select(
        F.col("least").alias("conv_id"),
        "depth",
        F.coalesce("parent_least", "shared_least").alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        "n_children",
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )
