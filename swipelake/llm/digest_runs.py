"""Exact duplicates by merging runs of digests in a tree.

Every partition of the input is a node of a tree and holds a run: its rows in the order of their digests. In each round nodes
exchange runs: STEP bits of the node's number are replaced by bits of the digest, so the runs of up to 2^STEP nodes meet and
are merged, each node keeping the digests that are its own from then on. After all bits have been replaced every digest is at one
node. A merge keeps per digest the number of rows and the least identifier, so a digest that has a third of all rows is one entry
of every run, and no merge ever sees more than 2^STEP entries of it. (Grouping by node and digest does this: the part of the
aggregation before the exchange makes the runs, the part after it merges them.)

Two trees are merged. The first has digests alone and tells which of them occur twice. Through the second go the texts behind
those, as part of the merged key: what is equal there is equal byte by byte at every level, and the least identifiers of the
second tree are those of verified copies. A digest behind which two texts are found is taken apart by its texts.

The one broadcast is of digests that occur twice, as whole numbers, after they are counted (BROADCAST_ROWS); beyond that Spark
joins by shuffle, with the same result. Only narrow rows (identifier, digest) are stored.

Cases: a null text is the empty text; texts that differ in blanks alone are equal. Every row gives a row. The least identifier
stays; a null one counts as greater than all others, and among rows that share the least one the first row read stays, so exactly
one row of a group is kept. An empty table gives no rows. Further columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swipelake.llm.common import small, store

STEP = 4  # bits of the node's number that are exchanged in a round
BROADCAST_ROWS = 1_000_000  # of eight bytes
DIGEST_BYTES = 32


def normal(text: Column) -> Column:
    """Every run of ASCII blanks is one space."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), r"[\x20\x09-\x0D]+", " ")


def node_bits(docs: DataFrame) -> int:
    """Bits of a node's number: as many nodes as the session has shuffle partitions, or somewhat more."""
    return max(1, (int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length())


def merge_runs(runs: DataFrame, by: list[str], bits: int, step: int = STEP) -> DataFrame:
    """*by, n, least of runs with the columns node, digest, n, least; ``by`` names the merged key and holds the digest."""
    home = F.conv(F.hex(F.substring("digest", 1, 4)), 16, 10).cast("bigint")
    for first in range(0, bits, step):
        mask = ((1 << min(step, bits - first)) - 1) << first
        node = F.col("node").bitwiseAND(F.lit(~mask)).bitwiseOR(home.bitwiseAND(F.lit(mask)))
        runs = runs.withColumn("node", node).groupBy("node", *by).agg(F.sum("n").alias("n"), F.min("least").alias("least"))
    return runs.drop("node")


def _rows(docs: DataFrame, key: str, text: str, with_text: bool = False) -> DataFrame:
    """key, full digest, row and, if asked for, the text as it is compared."""
    named = docs.select(F.col(key).alias("key"), normal(F.col(text)).alias("text"), F.monotonically_increasing_id().alias("row"))
    return named.select("key", F.unhex(F.sha2("text", 256)).alias("full"), "row", *["text"] * with_text)


def _as_runs(rows: DataFrame, bits: int, *more: str) -> DataFrame:
    """A row as an entry of its partition's run; the row's number holds that partition's above its 33rd bit."""
    node = F.shiftright("row", 33).bitwiseAND(F.lit((1 << bits) - 1))
    least = F.struct(F.col("key").isNull().alias("none"), "key", "row")
    return rows.select(node.alias("node"), "digest", *more, F.lit(1).cast("bigint").alias("n"), least.alias("least"))


def find(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    bits: int | None = None,
    step: int = STEP,
    digest_bytes: int = DIGEST_BYTES,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """key, keep_id, group_size, kept, text_sha256; one row per row."""
    bits = node_bits(docs) if bits is None else bits
    digest = F.substring("full", 1, digest_bytes).alias("digest")
    short = F.xxhash64("digest").alias("short")
    rows = store(_rows(docs, key, text))
    repeated = store(merge_runs(_as_runs(rows.select("*", digest), bits), ["digest"], bits, step).where("n > 1"))
    candidates = small(store(repeated.select(short).distinct()), broadcast_rows)
    texts = _rows(docs, key, text, with_text=True).select("*", digest).select("*", short).join(candidates, "short", "left_semi")
    verified = store(
        merge_runs(_as_runs(texts, bits, "text"), ["digest", "text"], bits, step)
        .groupBy("digest")
        .agg(F.count("*").alias("variants"), F.sum("n").alias("n"), F.min("least").alias("least"))
        .where("n > 1")
    )
    joined = rows.select("*", digest).join(small(verified, broadcast_rows), "digest", "left")
    out = _decided(joined.where("variants is null or variants = 1"), key)
    mixed = verified.where("variants > 1").select("digest")
    return out.unionByName(_by_text(docs, key, text, digest, mixed)) if mixed.head(1) else out


def _decided(joined: DataFrame, key: str) -> DataFrame:
    alone = F.col("least").isNull()
    return joined.select(
        F.col("key").alias(key),
        F.when(alone, F.col("key")).otherwise(F.col("least.key")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("bigint").alias("group_size"),
        (alone | (F.col("least.row") == F.col("row"))).alias("kept"),
        F.lower(F.hex("full")).alias("text_sha256"),
    )


def _by_text(docs: DataFrame, key: str, text: str, digest: Column, mixed: DataFrame) -> DataFrame:
    """The rows behind digests that stand for several texts, grouped by text."""
    rows = store(_rows(docs, key, text, with_text=True).select("*", digest).join(mixed, "digest", "left_semi"))
    least = F.min(F.struct(F.col("key").isNull().alias("none"), "key", "row")).alias("least")
    groups = rows.groupBy("digest", "text").agg(F.count("*").alias("n"), least)
    return _decided(rows.join(groups, ["digest", "text"]), key)


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The identifiers that stay, with the sizes of their groups."""
    return find(docs, key, text).where("kept").select(key, "group_size")
