"""Secrets in texts: fixed patterns, and entropy of sliding windows. Built-in functions only.

Candidates are long runs of letters, digits and base-64 marks. A window of WINDOW characters slides over each; the counts of the
characters in it (five bits a symbol, a few whole numbers in all), the counts of kinds of characters and the sum of c * log2(c)
are carried from place to place, changed by the one character that comes and the one that goes, and give the window's Shannon
entropy. A window has the class of its own characters: hexadecimal (with a letter and a digit), whatever stands before it in the run, or base 64. Windows
at or above the threshold of their class are joined to spans; a span is hexadecimal if all its windows are.

Two allow-lists suppress what isn't secret. Patterns of whole runs leave a run out. Words that mark examples, and plain
sequences, leave out the part of a run that holds them, between the marks = / _ and -; the other parts are searched.

Cases: null and empty texts have no spans. Rows that repeat are searched each. Null keys are kept.
The work is linear in a text's length but for its number of matches (see ``spans.matches``).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swipelake.llm.spans import SPANS, joined, let, matches, ranked

# Fixed patterns, with (group, least length of the group).
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LENGTH = 6
ACCESS = r"AKIA[A-Z0-9]{16,}"  # runs of 20 or more: a shorter run holds no such start either
HEX = r"[0-9a-f]{24,}"  # likewise
KINDS = ("assign", "access", "hex", "entropy_hex", "entropy_base64")

WINDOW = 20
ALPHABET = "0123456789abcdefABCDEFghijklmnopqrstuvwxyzGHIJKLMNOPQRSTUVWXYZ+/_=- "  # the last stands for what is left out
DIGITS, HEX_DIGITS, LETTERS, OUT = 10, 22, 62, 67  # digits, hexadecimal digits and letters come before these places
BITS, PER_NUMBER = 5, 12  # of a symbol's count, and symbols whose counts share one number
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}"
THRESHOLDS = {"entropy_hex": 3.0, "entropy_base64": 3.7}
ALLOWED = (
    r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",  # universally unique identifiers
    r"(?i)^(sha1|sha256|sha384|sha512|md5)[-=]",  # named digests
    r"^[A-Za-z]+([-_/=+][A-Za-z]+)*[-_/=+]?[0-9]{0,4}$",  # words, joined, with a number behind
    r"^[-_=+/0-9]*[A-Za-z]?[-_=+/0-9]*$",  # rules, dates, numbers
)
ALLOWED_WORDS = r"(?i)example|sample|placeholder|changeme|xxxx|0123456789|abcdefghij|1234567890"
PARTS = r"(?<=[=/_-])|(?=[=/_-])"


def weight(c: Column) -> Column:
    return F.when(c > 1, c * F.log2(c.cast("double"))).otherwise(F.lit(0.0))


def kind_of(code: Column) -> Column:
    """Counts of digits, letters, others than hexadecimal digits, and characters left out, eight bits each."""
    return (
        F.when(code < DIGITS, 1).when(code < HEX_DIGITS, 1 << 8).when(code < LETTERS, (1 << 8) + (1 << 16)).when(code < OUT, 1 << 16).otherwise(1 << 24).cast("bigint")
    )


def windows(candidate: Column, limits: dict[str, float], window: int = WINDOW) -> Column:
    """array of (start, end, hex): joined spans, relative to the candidate, of the windows that count."""

    def number_of(code: Column) -> Column:
        return F.floor(code / PER_NUMBER).cast("int")

    def shift_of(code: Column) -> Column:
        return (code % PER_NUMBER) * BITS

    def count(counts: Column, code: Column) -> Column:
        return F.call_function("shiftright", counts[number_of(code)], shift_of(code)).bitwiseAND(F.lit((1 << BITS) - 1))

    def search(codes: Column) -> Column:
        def go(state: Column, i: Column) -> Column:
            full = i >= window
            come, gone = codes[i], codes[F.greatest(i - window, F.lit(0))]
            counts = state["counts"]
            less = F.when(full, count(counts, gone)).otherwise(F.lit(0))
            # The one that goes leaves first, so it may lower the count of the one that comes.
            base = count(counts, come) - F.when(full & (gone == come), 1).otherwise(0)
            sum_ = state["sum"] - (weight(less) - weight(less - 1)) + weight(base + 1) - weight(base)
            one = F.lit(1).cast("bigint")
            plus, minus = F.call_function("shiftleft", one, shift_of(come)), F.call_function("shiftleft", one, shift_of(gone))
            new = F.transform(
                counts,
                lambda c, k: c + F.when(k == number_of(come), plus).otherwise(0) - F.when(full & (k == number_of(gone)), minus).otherwise(0),
            )
            kinds = state["kinds"] + kind_of(come) - F.when(full, kind_of(gone)).otherwise(0)
            return F.struct(new.alias("counts"), kinds.alias("kinds"), sum_.alias("sum"), i.alias("i"), state["out"].alias("out"))

        def keep(state: Column) -> Column:
            bits = F.lit(math.log2(window)) - state["sum"] / window
            digits, letters, others, left_out = (F.call_function("shiftright", state["kinds"], F.lit(8 * k)).bitwiseAND(F.lit(255)) for k in range(4))
            hexadecimal = others == 0
            limit = F.when(hexadecimal, limits["entropy_hex"]).otherwise(limits["entropy_base64"])
            start, end = state["i"] - (window - 1), state["i"] + 1
            counts = (start >= 0) & (~hexadecimal | ((digits > 0) & (letters > 0))) & (left_out == 0) & (bits >= limit)
            last = F.element_at(state["out"], -1)
            joins = (F.size(state["out"]) > 0) & (last["end"] >= start)
            span = F.struct(start.alias("start"), end.alias("end"), hexadecimal.alias("hex"))
            longer = F.struct(last["start"].alias("start"), end.alias("end"), (last["hex"] & hexadecimal).alias("hex"))
            out = (
                F.when(~counts, state["out"])
                .when(joins, F.concat(F.slice(state["out"], 1, F.size(state["out"]) - 1), F.array(longer)))
                .otherwise(F.concat(state["out"], F.array(span)))
            )
            return F.struct(state["counts"].alias("counts"), state["kinds"].alias("kinds"), state["sum"].alias("sum"), state["i"].alias("i"), out.alias("out"))

        empty = F.struct(
            F.array_repeat(F.lit(0).cast("bigint"), -(-len(ALPHABET) // PER_NUMBER)).alias("counts"),
            F.lit(0).cast("bigint").alias("kinds"),
            F.lit(0.0).alias("sum"),
            F.lit(-1).alias("i"),
            F.array().cast("array<struct<start:int,end:int,hex:boolean>>").alias("out"),
        )
        places = F.sequence(F.lit(0), F.size(codes) - 1)
        return F.aggregate(places, empty, lambda state, i: let(go(state, i), keep), lambda state: state["out"])

    codes = F.transform(F.split(candidate, "", -1), lambda c: F.instr(F.lit(ALPHABET), c) - 1)
    return let(F.filter(codes, lambda k: k >= 0), search)


def searched(hit: Column, words: str = ALLOWED_WORDS) -> Column:
    """The run with spaces in place of the parts that hold allowed words."""
    parts = F.transform(F.split(hit, PARTS, -1), lambda p: F.when(p.rlike(words), F.repeat(F.lit(" "), F.length(p))).otherwise(p))
    return F.when(hit.rlike(words), F.array_join(parts, "")).otherwise(hit)


def may_hold(hit: Column, allowed: tuple[str, ...] = ALLOWED) -> Column:
    """Whether a run is searched: it has a letter and a digit, and no pattern of whole runs matches it."""
    keep = hit.rlike("[0-9]") & hit.rlike("[A-Za-z]")
    for pattern in allowed:
        keep = keep & ~hit.rlike(pattern)
    return keep


def entropy_spans(text: Column, allowed: tuple[str, ...] = ALLOWED, thresholds: dict[str, float] | None = None) -> Column:
    limits = thresholds or THRESHOLDS

    def of_candidate(m: Column) -> Column:
        return F.transform(
            windows(searched(m["hit"]), limits),
            lambda s: F.struct(
                (m["start"] + s["start"]).alias("start"),
                F.when(s["hex"], KINDS.index("entropy_hex")).otherwise(KINDS.index("entropy_base64")).alias("rank"),
                (m["start"] + s["end"]).alias("end"),
            ),
        )

    return F.flatten(F.transform(F.filter(matches(text, CANDIDATE), lambda m: may_hold(m["hit"], allowed)), of_candidate)).cast(SPANS)


def is_assignment(hit: Column) -> Column:
    return F.length(F.regexp_extract(hit, ASSIGN, 2)) >= ASSIGN_LENGTH


def find(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_assign, n_access, n_hex, base_sha256, spans, n_entropy; one row per row."""
    source = docs.select(F.col(key), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("searched"))
    whole = F.col("searched")
    found = source.select(
        key,
        ranked(F.filter(matches(whole, ASSIGN), lambda m: is_assignment(m["hit"])), 0).alias("assign"),
        ranked(matches(whole, ACCESS), 1).alias("access"),
        ranked(matches(whole, HEX), 2).alias("hex"),
        entropy_spans(whole).alias("entropy"),
    )
    base = F.concat("assign", "access", "hex")
    return found.select(
        key,
        *(F.size(k).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")),
        F.sha2(joined(base, KINDS), 256).alias("base_sha256"),
        joined(F.concat(base, F.col("entropy")), KINDS).alias("spans"),
        F.size("entropy").cast("long").alias("n_entropy"),
    )


def redact(docs: DataFrame, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """The rows with each secret of the fixed patterns, then each span of high entropy, replaced by ``mark``.

    Kinds are replaced one after the other, each in what the one before left. Between two matches the
    text stays as it is. Null texts stay null.
    """

    def without(whole: Column, pattern: str, is_secret=None) -> Column:
        def rebuilt(hits: Column) -> Column:
            def put(gaps: Column) -> Column:
                return F.concat(
                    F.array_join(F.transform(hits, lambda h, i: F.concat(gaps[i], F.when(is_secret(h), mark).otherwise(h))), ""),
                    F.element_at(gaps, -1),
                )

            return let(F.split(whole, pattern, -1), put)

        if is_secret is None:
            return F.regexp_replace(whole, pattern, F.lit(mark.replace("\\", "\\\\").replace("$", "\\$")))
        return F.when(whole.rlike(pattern), let(F.regexp_extract_all(whole, F.lit(pattern), F.lit(0)), rebuilt)).otherwise(whole)

    def high(hit: Column) -> Column:
        return F.when(may_hold(hit), F.size(windows(searched(hit), THRESHOLDS)) > 0).otherwise(F.lit(False))

    out = docs
    for pattern, is_secret in ((ASSIGN, is_assignment), (ACCESS, None), (HEX, None), (CANDIDATE, high)):
        out = out.withColumn(text, without(F.col(text), pattern, is_secret))
    return out
