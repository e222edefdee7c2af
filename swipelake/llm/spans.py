"""Places of pattern matches in texts, as column expressions of built-in functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

BLOCK = 256
BEFORE = 40

FOUND = "array<struct<start:int,end:int,hit:string,before:string,after:string>>"
SPANS = "array<struct<start:int,rank:int,end:int>>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _placed(steps: Column, first: Column) -> Column:
    """Steps with their starts and ends; ``first`` is where the gap before the first step begins."""

    def go(state: Column, step: Column) -> Column:
        start = state["at"] + step["gap"]
        end = start + step["size"]
        found = F.struct(start.alias("start"), end.alias("end"), step["hit"].alias("hit"), step["before"].alias("before"), step["after"].alias("after"))
        return F.struct(end.alias("at"), F.concat(state["out"], F.array(found)).alias("out"))

    empty = F.struct(first.alias("at"), F.array().cast(FOUND).alias("out"))
    return F.aggregate(steps, empty, go, lambda state: state["out"])


def matches(text: Column, pattern: str) -> Column:
    """All leftmost non-overlapping matches with their places in code points, and the text around them.

    The text is split at the matches, so places are running sums of lengths; they are summed in
    blocks, which keeps texts with very many matches below quadratic work.
    """

    def found(hits: Column) -> Column:
        def steps(gaps: Column) -> Column:
            return F.transform(
                hits,
                lambda hit, i: F.struct(
                    F.length(gaps[i]).alias("gap"),
                    F.length(hit).alias("size"),
                    hit.alias("hit"),
                    F.right(gaps[i], F.lit(BEFORE)).alias("before"),
                    F.left(gaps[i + 1], F.lit(1)).alias("after"),
                ),
            )

        def blocks(all_steps: Column) -> Column:
            last = F.floor((F.size(all_steps) - 1) / BLOCK).cast("int")
            return F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(all_steps, k * BLOCK + 1, F.lit(BLOCK)))

        def placed(parts: Column) -> Column:
            def go(state: Column, part: Column) -> Column:
                size = F.aggregate(part, F.lit(0), lambda n, s: n + s["gap"] + s["size"])
                return F.struct((state["at"] + size).alias("at"), F.concat(state["out"], F.array(state["at"])).alias("out"))

            empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
            firsts = F.aggregate(parts, empty, go, lambda state: state["out"])
            return let(firsts, lambda f: F.flatten(F.transform(parts, lambda part, k: _placed(part, f[k]))))

        return let(F.split(text, pattern, -1), lambda gaps: let(steps(gaps), lambda s: let(blocks(s), placed)))

    every = let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), found)
    return F.when(text.rlike(pattern), every).otherwise(F.array().cast(FOUND))


def ranked(found: Column, rank: int) -> Column:
    return F.transform(found, lambda m: F.struct(m["start"].alias("start"), F.lit(rank).alias("rank"), m["end"].alias("end"))).cast(SPANS)


def joined(spans: Column, kinds: tuple[str, ...]) -> Column:
    """kind:start:end by start, then rank (the place of the kind in ``kinds``), comma-joined."""
    names = F.array(*(F.lit(k) for k in kinds))
    return F.concat_ws(
        ",", F.transform(F.sort_array(spans), lambda s: F.concat_ws(":", names[s["rank"]], s["start"].cast("string"), s["end"].cast("string")))
    )
