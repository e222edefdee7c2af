"""Near duplicates by SimHash and covering locality-sensitive hashing.

A fingerprint has one bit per bit of the shingles' hashes, set where over half of them have it. Two
fingerprints link when they differ in at most RADIUS bits. Each bit position gets a nonzero vector of
RADIUS + 1 bits; for every nonzero vector v of that length one table keeps the positions whose vector
has an odd product with v. Any RADIUS differing positions leave at least one v with even products
to all of them, so in that table the two fingerprints are equal under the mask: no link is missed.

Equal fingerprints are one node, so copies cost nothing. In buckets of up to DENSE nodes all pairs
are compared. The nodes of larger buckets are written to themselves and to every fingerprint one bit
away: two nodes meet there exactly when they differ in at most two bits, at most 65 meet in one place,
and all that meet are links, so one star is enough. (This holds for a radius of two; another radius
has no such way, so it is refused.) Components then come from star contractions.

Cases: null and empty texts have fingerprint zero and link like any other. Null keys get a component
like others; they are its least key only where there is no other. Rows that repeat are rows of one
component. Further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_digest

from swipelake.llm.common import drop, positional, small, store
from swipelake.llm.components import components

SHINGLE = 3
SEED = 42
RADIUS = 2
DENSE = 32
CHUNK = 1 << 15  # shingles counted at once
GONE_ROWS = 1_000_000  # of eight bytes, broadcast


def fingerprint(text: str, size: int = SHINGLE) -> bytes:
    """Eight bytes, the highest bit first."""
    words = text.encode("utf-8", "replace").lower().split()  # ASCII letters and blanks only
    joined = b" ".join(words)
    if len(words) <= size:
        shingles = [joined] if words else []
    else:
        ends = list(accumulate([len(w) + 1 for w in words]))
        shingles = [joined[a : b - 1] for a, b in zip([0, *ends], ends[size - 1 :])]
    ones = np.zeros(64, dtype=np.int64)
    for first in range(0, len(shingles), CHUNK):
        raw = b"".join([xxh64_digest(s, SEED) for s in shingles[first : first + CHUNK]])
        ones += np.unpackbits(np.frombuffer(raw, dtype=np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return np.packbits(2 * ones > len(shingles)).tobytes()


def fingerprints(docs: DataFrame, text: str = "text", size: int = SHINGLE) -> DataFrame:
    """All columns of ``docs`` and ``simhash_bits``, the fingerprint as a signed whole number."""
    schema = docs.schema
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = b"".join([fingerprint(str(t.as_py() or ""), size) for t in batch.column(at)])
            column = pa.array(np.frombuffer(bits, dtype=">i8").astype(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns, column], [*schema.names, "simhash_bits"])

    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    return docs.mapInArrow(run, columns + ", simhash_bits long")


def masks(radius: int) -> list[int]:
    """One mask of 64 bits, as a signed number, for every table."""
    vectors = (1 << (radius + 1)) - 1
    out = []
    for v in range(1, vectors + 1):
        mask = sum(1 << i for i in range(64) if bin((1 + i % vectors) & v).count("1") % 2)
        out.append(mask - (1 << 64) if mask >> 63 else mask)
    return out


def links(nodes: DataFrame, radius: int = RADIUS, dense: int = DENSE) -> DataFrame:
    """Links between distinct fingerprints (column ``bits``) that hold all components together."""
    if radius != 2:
        raise ValueError("only a radius of two bits is supported")
    keys = [F.struct(F.lit(t).alias("table"), F.col("bits").bitwiseAND(F.lit(m)).alias("key")) for t, m in enumerate(masks(radius))]
    keyed = nodes.select("bits", F.explode(F.array(*keys)).alias("k")).select("bits", "k.table", "k.key")
    sizes = keyed.groupBy("table", "key").agg(F.count("*").alias("n")).where("n > 1")
    shared = store(keyed.join(sizes, ["table", "key"]))

    def near(a, b):
        return (a < b) & (F.bit_count(a.bitwiseXOR(b)) <= radius)

    bucket = shared.where(F.col("n") <= dense).groupBy("table", "key").agg(F.collect_list("bits").alias("all"))
    pairs = bucket.select(
        F.explode(
            F.flatten(
                F.transform(
                    "all", lambda a: F.transform(F.filter("all", lambda b: near(a, b)), lambda b: F.struct(a.alias("a"), b.alias("b")))
                )
            )
        ).alias("p")
    ).select("p.a", "p.b")
    bits = [1 << i for i in range(63)] + [-(1 << 63)]
    places = F.array(F.col("bits"), *(F.col("bits").bitwiseXOR(F.lit(b)) for b in bits))
    met = (
        shared.where(F.col("n") > dense)
        .select("bits")
        .distinct()
        .select("bits", F.explode(places).alias("place"))
        .groupBy("place")
        .agg(F.collect_list("bits").alias("all"))
        .where(F.size("all") > 1)
    )
    stars = met.select(F.array_min("all").alias("a"), F.explode("all").alias("b")).where("a < b")
    return pairs.union(stars).distinct()


def classes(rows: DataFrame) -> DataFrame:
    """bits, component of stored rows (key, bits): the least key of all that can be reached."""
    nodes = store(rows.groupBy("bits").agg(F.min("key").alias("least")))
    linked = components(links(nodes.select("bits")))
    # Only nodes with links meet at their root; each task takes its least key there before anything is sent.
    members = linked.join(nodes, linked["node"] == nodes["bits"]).select("root", "least")
    roots = linked.select("root").distinct()
    own = roots.join(nodes, roots["root"] == nodes["bits"]).select("root", "least")
    found = store(members.union(own).groupBy("root").agg(F.min("least").alias("component")))
    rooted = nodes.join(linked.withColumnRenamed("node", "bits"), "bits", "left").withColumn("root", F.coalesce("root", "bits"))
    return rooted.join(found, "root", "left").withColumn("component", F.when(F.col("component").isNull(), F.col("least")).otherwise(F.col("component"))).select("bits", "component")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE) -> DataFrame:
    """key, fingerprint (16 hex digits), component_id; one row per row."""
    source = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    rows = store(fingerprints(source, "text", size).select("key", F.col("simhash_bits").alias("bits")))
    return rows.join(classes(rows), "bits").select(
        F.col("key").alias(key), F.lpad(F.lower(F.hex("bits")), 16, "0").alias("fingerprint"), F.col("component").alias("component_id")
    )


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE) -> DataFrame:
    """One row of every component stays: that of the least key (null last), then of the least fingerprint, then the first read.

    Texts are stored once with their rows' numbers; which rows go is found on narrow rows, and where these are counted to be few
    the texts aren't sent anywhere.
    """
    docs, names = positional(docs)
    key = names[key]
    rows = store(fingerprints(docs.withColumn("row", F.monotonically_increasing_id()), names[text], size))
    pairs = rows.select(F.col(key).alias("key"), F.col("simhash_bits").alias("bits"), "row")
    linked = store(components(links(pairs.select("bits").distinct())).withColumnRenamed("node", "bits"))
    ranked = pairs.groupBy("bits").agg(F.min(F.struct(F.col("key").isNull().alias("none"), "key", "bits", "row")).alias("least"))
    rooted = store(ranked.join(linked, "bits", "left").withColumn("root", F.coalesce("root", "bits")))
    stay = store(rooted.groupBy("root").agg(F.min("least").alias("least")).select(F.col("least.row").alias("row")))
    gone = store(pairs.select("row").join(stay, "row", "left_anti"))
    drop(linked), drop(rooted), drop(stay)
    return rows.join(small(gone, GONE_ROWS), "row", "left_anti").select(*(F.col(n).alias(c) for c, n in names.items()))
