"""Removal of repeated passages by content-defined chunks of lines. Built-in functions only.

A rolling hash over the hashes of the last WINDOW lines ends a chunk where it falls into one of
DIVISOR classes, so chunk edges depend on the lines around them only and move along when lines are put
in or taken out before them. A line of LONG_WORDS words or more is a passage by itself: it ends the
chunk before it and is one of its own. Chunks of several lines with at least LEAST_WORDS words, and
such long lines, are compared over all documents. The occurrence with the least (key, row, place) stays, all
others go. Words are runs of other characters than ASCII blanks; blanks never count.

Chunks at the two ends of a passage hold other lines too and stay. So with ``runs`` the lines of every
repeated run of RUN_WORDS words or more go as well: they are what repeated windows cover (see ``windows``).
A line that goes has an equal one at a lesser place, so of each distinct line one stays.

Chunks and windows are pieces. One pass over the texts names each by a hash of its lines' hashes; what follows is narrow, until
the documents with repeated names are joined with their pieces once and stored. There the bytes of the pieces are compared: a
name that different texts share is taken apart by text. Documents without repeated names aren't sent anywhere where those with them
are counted to be few (BROADCAST_ROWS numbers); beyond that all are joined by shuffle, with the same result.
A piece that a third of all documents hold is counted in the map tasks before it is sent, and joins on pieces and documents are
ones that Spark splits. Tables that were read for the last time are deleted.

Cases: null texts stay null, empty ones empty. A document may lose all lines; its row stays. Every row is
a document of its own, numbered when the input is stored once at the start: rows with one key, or a null
key, lose what another of them keeps. Null keys come last in order, rows of one key by their number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swipelake.llm.common import drop, positional, store
from swipelake.llm.spans import BLOCK, let

WINDOW = 2
DIVISOR = 3
LONG_WORDS = 50
LEAST_WORDS = 20
RUN_WORDS = 51
BROADCAST_ROWS = 1_000_000


def n_words(line: Column) -> Column:
    return F.regexp_count(line, F.lit(r"\S+"))


def turned(h: Column, bits: int) -> Column:
    return F.shiftleft(h, bits).bitwiseOR(F.shiftrightunsigned(h, 64 - bits)) if bits else h


def chunk_ends(hashes: Column, counts: Column) -> Column:
    """Numbers of the lines that end a chunk, ascending, from the lines' hashes and words; the last line is one."""

    def is_end(i: Column) -> Column:
        rolling = hashes[i]
        for back in range(1, WINDOW):
            rolling = rolling.bitwiseXOR(F.when(i >= back, turned(hashes[F.greatest(i - back, F.lit(0))], back)).otherwise(F.lit(0)))
        last = F.size(hashes) - 1
        cut = F.shiftrightunsigned(rolling, 33) % DIVISOR == 0
        return (i == last) | cut | (counts[i] >= LONG_WORDS) | (counts[F.least(i + 1, last)] >= LONG_WORDS)

    return F.filter(F.sequence(F.lit(0), F.size(hashes) - 1), is_end)


def chunks(hashes: Column, counts: Column) -> Column:
    """array of (first, size) of the chunks that are compared."""

    def cut(ends: Column) -> Column:
        def one(end: Column, k: Column) -> Column:
            first = F.when(k > 0, ends[F.greatest(k - 1, F.lit(0))] + 1).otherwise(F.lit(0))
            return F.struct(first.alias("first"), (end - first + 1).alias("size"))

        return F.transform(ends, one)

    def enough(chunk: Column) -> Column:
        words = F.aggregate(F.slice(counts, chunk["first"] + 1, chunk["size"]), F.lit(0), lambda a, b: a + b)
        return words >= F.when(chunk["size"] > 1, LEAST_WORDS).otherwise(LONG_WORDS)

    return F.filter(let(chunk_ends(hashes, counts), cut), enough)


def before_each(counts: Column) -> Column:
    """Sums of the numbers before each place, and of all; in blocks, so long arrays are not copied anew for each."""
    last = F.floor((F.size(counts) - 1) / BLOCK).cast("int")
    blocks = F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(counts, k * BLOCK + 1, F.lit(BLOCK)))

    def add(state: Column, n: Column) -> Column:
        return F.struct((state["at"] + n).alias("at"), F.concat(state["out"], F.array(state["at"])).alias("out"))

    def sums(numbers: Column, first: Column) -> Column:
        empty = F.struct(first.alias("at"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(numbers, empty, add, lambda state: state["out"])

    def of_blocks(parts: Column) -> Column:
        totals = F.transform(parts, lambda part: F.aggregate(part, F.lit(0), lambda a, b: a + b))
        firsts = sums(totals, F.lit(0))
        return let(firsts, lambda f: F.flatten(F.transform(parts, lambda part, k: sums(part, f[k]))))

    return let(blocks, of_blocks)


def windows(counts: Column, least: int = RUN_WORDS) -> Column:
    """array of (first, size): from each line the fewest lines on with ``least`` words, and the fewest back.

    Every run of lines with so many words is the union of such windows inside it, and they depend on the
    run's own lines only. So what repeated windows cover is exactly what repeated runs cover.
    """
    owner = F.flatten(F.transform(counts, lambda n, i: F.array_repeat(i, n)))  # the line of each word

    def ends(at: Column, own: Column) -> Column:
        every = F.sequence(F.lit(0), F.size(counts) - 1)
        total = F.size(own)
        on = F.transform(
            F.filter(every, lambda i: (counts[i] > 0) & (at[i] + least <= total)),
            lambda i: F.struct(i.alias("first"), own[at[i] + (least - 1)].alias("last")),
        )
        # A window back that is also one on is left out.
        back = F.transform(
            F.filter(every, lambda e: (counts[e] > 0) & (at[e] + counts[e] >= least)),
            lambda e: F.struct(own[at[e] + counts[e] - least].alias("first"), e.alias("last")),
        )
        other = F.filter(back, lambda w: own[F.least(at[w["first"]] + (least - 1), total - 1)] != w["last"])
        return F.concat(on, other)

    spans = let(before_each(counts), lambda at: let(owner, lambda own: ends(at, own)))
    return F.transform(spans, lambda w: F.struct(w["first"].alias("first"), (w["last"] - w["first"] + 1).alias("size")))


def name_of(hashes: Column) -> Column:
    """One number for the hashes of a piece's lines."""
    return F.xxhash64(hashes)


def pieces(text: Column, runs: bool) -> Column:
    """array of (run, first, size, name) of a text's chunks and, with ``runs``, windows."""

    def named(spans: Column, hashes: Column, run: bool) -> Column:
        return F.transform(
            spans,
            lambda w: F.struct(F.lit(run).alias("run"), w["first"].alias("first"), w["size"].alias("size"), name_of(F.slice(hashes, w["first"] + 1, w["size"])).alias("name")),
        )

    def of_lines(hashes: Column, counts: Column) -> Column:
        found = named(chunks(hashes, counts), hashes, False)
        return F.concat(found, named(windows(counts), hashes, True)) if runs else found

    def of_text(lines: Column) -> Column:
        hashes, counts = F.transform(lines, lambda line: F.xxhash64(line)), F.transform(lines, n_words)
        return let(hashes, lambda h: let(counts, lambda n: of_lines(h, n)))

    return let(F.split(text, "\n", -1), of_text)


def place() -> Column:
    return F.struct(F.col("key").isNull().alias("none"), "key", "row", "first")


def spans_to_go(shared: DataFrame, same: list[str]) -> DataFrame:
    """The rows of ``shared`` with gone_first and gone_size: what goes of each piece, nothing of the first occurrence. Where a
    window overlaps the first occurrence in the same row, only the lines behind that go."""
    keepers = shared.groupBy(*same).agg(F.min(place()).alias("keeper"))
    own = F.col("keeper.row") == F.col("row")
    first = F.when(own, F.greatest(F.col("first"), F.col("keeper.first") + F.col("size"))).otherwise(F.col("first"))
    size = F.when(own & (F.col("keeper.first") == F.col("first")), 0).otherwise(F.col("first") + F.col("size") - first)
    return shared.join(store(keepers), same).withColumns({"gone_first": first, "gone_size": size}).drop("keeper")


SPAN = ("run", "name", "first", "size", "gone_first", "gone_size")


def by_row(spans: DataFrame) -> DataFrame:
    return spans.groupBy(F.col("row").alias("span_row")).agg(F.collect_list(F.struct(*SPAN)).alias("spans"))


def with_texts(touched: DataFrame, key: str, text: str) -> DataFrame:
    """key, row, the parts of each piece, and its text."""

    def cut(lines: Column) -> Column:
        return F.transform("spans", lambda s: F.struct(s.alias("s"), F.array_join(F.slice(lines, s["first"] + 1, s["size"]), "\n").alias("bytes")))

    each = touched.where("spans is not null").select(F.col(key).alias("key"), "row", F.explode(let(F.split(F.col(text), "\n", -1), cut)).alias("p"))
    return each.select("key", "row", *(F.col(f"p.s.{c}").alias(c) for c in SPAN), "p.bytes")


def taken_apart(touched: DataFrame, key: str, text: str) -> DataFrame:
    """``touched`` with the pieces whose name different texts share judged by text."""
    each = with_texts(touched, key, text)
    mixed = store(each.select("run", "name", "bytes").distinct().groupBy("run", "name").agg(F.count("*").alias("texts")).where("texts > 1").drop("texts"))
    if not mixed.head(1):
        return touched
    plain = each.drop("bytes").join(mixed, ["run", "name"], "left_anti").select("row", *SPAN)
    shared = store(each.join(mixed, ["run", "name"], "left_semi").drop("gone_first", "gone_size"))
    judged = spans_to_go(shared, ["run", "name", "bytes"]).select("row", *SPAN)
    return store(touched.drop("spans", "span_row").join(by_row(plain.unionByName(judged)), F.col("row") == F.col("span_row"), "left"))


def marked(docs: DataFrame, key: str, text: str, runs: bool) -> DataFrame:
    """The rows with spans, the pieces of each that occur more than once (null without any); ``docs`` is stored and goes."""
    every = docs.where(F.col(text).isNotNull()).select(F.col(key).alias("key"), "row", F.explode(pieces(F.col(text), runs)).alias("p")).select("key", "row", "p.*")
    every = store(every)
    twice = store(every.groupBy("run", "name").agg(F.count("*").alias("n")).where("n > 1").drop("n"))  # stored, so Spark splits the join where many rows hold one name
    shared = store(every.join(twice, ["run", "name"]))
    drop(every), drop(twice)
    spans = store(by_row(spans_to_go(shared, ["run", "name"])))
    drop(shared)
    rows = spans.select("span_row")
    few = rows.count() <= BROADCAST_ROWS
    own = F.col("row") == F.col("span_row")
    joined = docs.join(F.broadcast(rows), own, "left_semi").join(spans, own) if few else docs.join(spans, own, "left")
    touched = taken_apart(store(joined), key, text)
    drop(spans)
    if not few:
        drop(docs)
        return touched
    rest = docs.join(F.broadcast(touched.select(F.col("row").alias("span_row"))), own, "left_anti")
    return touched.unionByName(rest.withColumns({"span_row": F.lit(None).cast("bigint"), "spans": F.lit(None).cast(touched.schema["spans"].dataType)}))


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", counts: bool = True, runs: bool = False) -> DataFrame:
    """The rows, without the lines of repeated chunks; with ``counts`` also n_lines and n_removed.

    With ``runs`` also without the lines of all repeated runs of RUN_WORDS words or more, whole.
    """
    docs, names = positional(docs)
    key, text = names[key], names[text]
    joined = marked(store(docs.withColumn("row", F.monotonically_increasing_id())), key, text, runs)
    gone = F.filter("spans", lambda s: s["gone_size"] > 0)

    def without(lines: Column) -> Column:
        going = F.flatten(F.transform(gone, lambda g: F.sequence(g["gone_first"], g["gone_first"] + g["gone_size"] - 1)))
        return F.transform(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), going), lambda i: lines[i])

    touched = F.size(F.coalesce(gone, F.array().cast(joined.schema["spans"].dataType))) > 0
    left = F.when(touched & F.col(text).isNotNull(), let(F.split(F.col(text), "\n", -1), without))
    new = F.when(touched, F.array_join(left, "\n")).otherwise(F.col(text))
    lines = F.when(F.col(text).isNull(), 0).otherwise(F.length(text) - F.length(F.replace(F.col(text), F.lit("\n"), F.lit(""))) + 1)
    gone_lines = F.when(touched, lines - F.size(left)).otherwise(0)
    out = joined.withColumn("left_text", new)
    added = {}
    if counts:
        out = out.withColumns({"all_lines": lines.cast("long"), "gone_lines": gone_lines.cast("long")})
        added = {"n_lines": "all_lines", "n_removed": "gone_lines"}  # take the place of columns with these names
    kept = {c: "left_text" if n == text else n for c, n in names.items() if c not in added}
    return out.select(*(F.col(n).alias(c) for c, n in (kept | added).items()))
