"""Personal data in texts by weak supervision. Built-in functions only.

Candidate spans come from loose patterns; strict forms of them (valid addresses, checksums, lengths)
are the base spans and always stay. Labelers vote on each candidate, for, against or not at all:
strict form, checksum or range, gazetteer (tables of known endings and prefixes, a parameter), words before it, words before it
that speak against it, and whether it stands alone. Counts of vote patterns over all candidates leave the tasks; their number is
bounded by kinds x 3 ** labelers. Expectation-maximisation on them estimates each labeler's reliability and every pattern's chance
to be personal data. With these chances as labels, the final span classifier is a logistic regression on what the span itself looks
like: kind, length, shape, and the two words before it (hashed into a bounded number of classes), not the votes. It is
fitted on at most TRAIN_ROWS kinds of candidates, drawn by a hash, with their counts. So it accepts a span without votes that
looks like those with good ones, and refuses one whose look mostly goes with bad ones. It adds candidates that no fixed pattern
accepts.

Cases: null and empty texts have no spans. Rows that repeat are searched, and counted, each. Null keys
are kept. Without candidates nothing is trained and nothing added.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swipelake.llm.common import store
from swipelake.llm.spans import SPANS, joined, matches

# Fixed patterns. Runs are taken whole (possessive), and none starts inside a run already tried, so
# they find the same places as the plain forms in linear time.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9]++(?:[\x20-][0-9]++)*+"  # of two digits and more; shorter ones fail the length
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
LOCAL_PHONE = r"(?<![0-9+])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])"
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "soft_email", "soft_ip", "soft_card", "soft_phone", "local_phone")

# Gazetteers. Endings of domain names (those of two letters count all), leading digits of card numbers and of
# countries, and the beginnings of addresses that name no host of the public net.
GAZETTEERS: dict[str, tuple[str, ...]] = {
    "domain_ends": ("com", "org", "net", "edu", "gov", "mil", "int", "info", "biz", "io", "app", "dev", "name", "online", "shop", "site", "xyz"),
    "issuers": ("34", "35", "36", "37", "38", "4", "51", "52", "53", "54", "55", "6011", "65", *(str(n) for n in range(22, 28))),
    "country_codes": (
        "1", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48", "49", "51", "52", "53", "54", "55", "56", "57", "58",
        "60", "61", "62", "63", "64", "65", "66", "7", "81", "82", "84", "86", "90", "91", "92", "93", "94", "95", "98",
        *(str(n) for first in (21, 22, 23, 24, 25, 26, 35, 37, 38, 42, 50, 59, 67, 68, 85, 96, 97, 99) for n in range(10 * first, 10 * first + 10)),
    ),
    "private": ("0.", "10.", "127.", "169.254.", "192.168.", *(f"172.{n}." for n in range(16, 32)), *(f"{n}." for n in range(224, 256))),
}
SPEAKS_FOR = {
    "email": r"(?i)(mail|contact|write|correo|courriel|kontakt|escrib)\W*\w*\W*$",
    "ip": r"(?i)(\bip|host|server|address|adresse|from|dirección)\W*\w*\W*$",
    "card": r"(?i)(card|visa|mastercard|amex|carte|tarjeta|karte|payment)\W*\w*\W*$",
    "phone": r"(?i)(phone|\btel|call|mobile|\bfax|téléphone|teléfono|telefon|handy|whatsapp)\W*\w*\W*$",
}
SPEAKS_AGAINST = r"(?i)(version|release|section|chapter|figure|table|isbn|order|invoice|page|\bv|\bno)\W*$"
LABELERS = ("strict", "range", "gazetteer", "context", "against", "alone")
ROUNDS = 50
ACCEPT = 0.5
SHAPES, WORDS = 64, 128  # classes that shapes and words are hashed into
TRAIN_ROWS = 10_000


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether the last digit of a string of digits is its check digit."""

    def worth(c: Column, i: Column) -> Column:
        twice = c.cast("int") * (1 + i % 2)
        return F.when(twice > 9, twice - 9).otherwise(twice)

    each = F.transform(F.filter(F.split(F.reverse(number), "", -1), lambda c: c != ""), worth)
    return F.aggregate(each, F.lit(0), lambda n, d: n + d) % 10 == 0


def octets_fit(hit: Column) -> Column:
    """Parts of at most 255, however many zeros stand before."""
    return F.forall(F.split(hit, r"\."), lambda part: part.rlike(r"^0*([0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))


def between(value: Column, low: int, high: int) -> Column:
    return (value >= low) & (value <= high)


def vote(yes: Column, no: Column) -> Column:
    return F.when(yes, "1").when(no, "2").otherwise("0")


def begins(text: Column, known: tuple[str, ...]) -> Column:
    """Whether the text begins with an entry of a gazetteer."""
    return F.exists(F.array(*(F.lit(k) for k in known)).cast("array<string>"), lambda k: F.startswith(text, k))


def shape_of(hit: Column) -> Column:
    """Class of a span's marks and runs of digits and letters."""
    plain = F.regexp_replace(F.regexp_replace(hit, "[0-9]", "9"), r"\p{L}+", "a")
    return F.pmod(F.xxhash64(F.left(plain, F.lit(24))), F.lit(SHAPES)).cast("int")


def word_before(before: Column, which: int) -> Column:
    """Class of the last word before a span (1), or the one before that (2); -1 without one."""
    found = F.regexp_extract_all(F.lower(before), F.lit(r"\p{L}+"), F.lit(0))
    return F.when(F.size(found) >= which, F.pmod(F.xxhash64(F.try_element_at(found, F.lit(-which))), F.lit(WORDS))).otherwise(F.lit(-1)).cast("int")


def candidates(text: Column, gazetteers: dict[str, tuple[str, ...]] = GAZETTEERS) -> Column:
    """array of (start, rank, end, base, votes, size, shape, word1, word2): all candidates of a text."""

    def struct_of(m: Column, kind: str, rank: int, strict: Column, in_range: Column, known: Column, unknown: Column) -> Column:
        alone = ~F.right(m["before"], F.lit(1)).rlike(r"[\p{L}\p{N}@._-]$") & ~m["after"].rlike(r"^[\p{L}\p{N}@_-]")
        never = F.lit(False)
        votes = F.concat(
            vote(strict, ~strict),
            vote(in_range, ~in_range),
            vote(known, unknown),
            vote(m["before"].rlike(SPEAKS_FOR[kind]), never),
            vote(never, m["before"].rlike(SPEAKS_AGAINST)),
            vote(alone, ~alone),
        )
        accepted = strict & in_range if kind != "phone" or rank < 4 else F.lit(False)
        return F.struct(
            m["start"].alias("start"),
            F.when(accepted, rank).otherwise(rank + 4 if rank < 4 else rank).cast("int").alias("rank"),
            m["end"].alias("end"),
            accepted.alias("base"),
            votes.alias("votes"),
            F.least(F.length(m["hit"]) / 4, F.lit(7)).cast("int").alias("size"),
            shape_of(m["hit"]).alias("shape"),
            word_before(m["before"], 1).alias("word1"),
            word_before(m["before"], 2).alias("word2"),
        )

    def email(m: Column) -> Column:
        end = F.lower(F.substring_index(m["hit"], ".", -1))
        known = end.rlike("^[a-z]{2}$") | F.array_contains(F.array(*(F.lit(k) for k in gazetteers["domain_ends"])).cast("array<string>"), end)
        return struct_of(m, "email", 0, F.lit(True), F.lit(True), known, ~known)

    def ip(m: Column) -> Column:
        private = begins(m["hit"], gazetteers["private"])
        return struct_of(m, "ip", 1, F.lit(True), octets_fit(m["hit"]), F.lit(False), private)

    def card(m: Column) -> Column:
        number = digits(m["hit"])
        fits = between(F.length(number), 14, 19)
        return struct_of(m, "card", 2, fits, fits & luhn(number), begins(number, gazetteers["issuers"]), ~begins(number, gazetteers["issuers"]))

    def phone(m: Column) -> Column:
        fits = between(F.length(digits(m["hit"])), 10, 15)
        code = begins(F.substr(m["hit"], F.lit(2)), gazetteers["country_codes"])
        return struct_of(m, "phone", 3, fits, fits, code, ~code)

    def local(m: Column) -> Column:
        area = ~digits(m["hit"]).rlike("^[01]")
        return struct_of(m, "phone", 8, F.lit(True), F.length(digits(m["hit"])) == 10, area, ~area)

    long_numbers = F.filter(matches(text, CARD), lambda m: F.length(m["hit"]) >= 12)
    return F.concat(
        F.transform(matches(text, EMAIL), email),
        F.transform(matches(text, IP), ip),
        F.transform(F.filter(long_numbers, lambda m: F.length(digits(m["hit"])) >= 12), card),
        F.transform(matches(text, PHONE), phone),
        F.transform(F.filter(matches(text, LOCAL_PHONE), lambda m: ~m["before"].rlike(r"\+[0-9]{1,3}[\x20.-]?$")), local),
    )


def reliabilities(patterns: list[tuple[str, float]]) -> dict[str, float]:
    """Chance of each vote pattern to be personal data, by expectation-maximisation.

    Labelers are taken as independent given the truth; a vote's rates are smoothed, and start from
    the belief that labelers are right more often than not.
    """
    if not patterns:
        return {}
    n = np.array([count for _, count in patterns], dtype=float)
    votes = np.array([[int(v) for v in p] for p, _ in patterns])
    rates = np.empty((2, votes.shape[1], 3))
    rates[1], rates[0] = (0.3, 0.5, 0.2), (0.5, 0.1, 0.4)
    prior = 0.5
    for _ in range(ROUNDS):
        logs = [np.log(rates[y][np.arange(votes.shape[1]), votes]).sum(axis=1) for y in (0, 1)]
        chance = 1 / (1 + np.exp(np.clip(logs[0] - logs[1] + math.log((1 - prior) / prior), -60, 60)))
        prior = float(np.clip((n * chance).sum() / n.sum(), 0.01, 0.99))
        for y, share in ((0, 1 - chance), (1, chance)):
            mass = n * share
            for j in range(votes.shape[1]):
                seen = np.bincount(votes[:, j], weights=mass, minlength=3) + 1
                rates[y, j] = seen / seen.sum()
    return {p: float(c) for (p, _), c in zip(patterns, chance)}


Look = tuple[int, str, int, int, int, int, float]  # rank, votes, size, shape, word1, word2, how many


def kind_of(rank: int) -> int:
    return rank % 4 if rank < 8 else 3


def span_classifier(rows: list[Look], chances: dict[tuple[int, str], float]) -> dict[str, float]:
    """Weights by feature of a logistic regression on looks with their counts; the labels are the chances of their votes."""
    names = sorted({f for r in rows for f in features(*r[:1], *r[2:6])})
    index = {f: i for i, f in enumerate(names)}
    x = np.zeros((len(rows), len(names)), dtype=np.float32)
    for i, r in enumerate(rows):
        x[i, [index[f] for f in features(*r[:1], *r[2:6])]] = 1
    n = np.array([r[6] for r in rows], dtype=float)
    y = np.array([chances[kind_of(r[0]), r[1]] for r in rows])
    w = np.zeros(len(names))
    ridge = np.eye(len(names))
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (n * p * (1 - p))[:, None].astype(np.float32)).T @ x + ridge
        w = w + np.clip(np.linalg.solve(hessian, x.T @ (n * (y - p)) - w), -5, 5)
    return dict(zip(names, map(float, w)))


def features(rank: int, size: int, shape: int, word1: int, word2: int) -> list[str]:
    kind = kind_of(rank)
    return ["all", f"kind{kind}", f"size{kind}:{size}", f"shape{kind}:{shape}", f"one{word1}", f"two{word2}"]


def train(found: DataFrame, most: int = TRAIN_ROWS) -> dict[str, float]:
    """Weights of the span classifier; ``found`` has the column ``candidates``."""
    each = found.select(F.explode("candidates").alias("c")).select("c.*")
    votes = each.groupBy("rank", "votes").agg(F.count("*").alias("n")).collect()  # kinds x 3 ** labelers at most
    if not votes:
        return {}
    chances: dict[tuple[int, str], float] = {}
    for kind in range(4):
        counts: dict[str, float] = {}
        for r in votes:
            if kind_of(r.rank) == kind:
                counts[r.votes] = counts.get(r.votes, 0) + r.n
        chances |= {(kind, v): c for v, c in reliabilities(sorted(counts.items())).items()}
    look = ["rank", "votes", "size", "shape", "word1", "word2"]
    looks = each.groupBy(*look).agg(F.count("*").alias("n")).orderBy(F.xxhash64(*look), *look).limit(most)
    return span_classifier(sorted(tuple(r) for r in looks.collect()), chances)


def chance(c: Column, weights: dict[str, float]) -> Column:
    """The classifier's chance of a candidate that the fixed patterns don't accept."""
    table = F.create_map(*(F.lit(x) for pair in sorted(weights.items()) for x in pair))
    kind = F.when(c["rank"] < 8, c["rank"] % 4).otherwise(3).cast("string")
    names = [F.lit("all"), F.concat(F.lit("kind"), kind)]
    names += [F.concat(F.lit(name), kind, F.lit(":"), c[name].cast("string")) for name in ("size", "shape")]
    names += [F.concat(F.lit(name), c[column].cast("string")) for name, column in (("one", "word1"), ("two", "word2"))]
    total = F.lit(0.0)
    for name in names:
        total = total + F.coalesce(F.try_element_at(table, name), F.lit(0.0))
    return 1 / (1 + F.exp(-total))


def find(docs: DataFrame, key: str = "doc_id", text: str = "text", accept: float = ACCEPT, gazetteers: dict[str, tuple[str, ...]] = GAZETTEERS) -> DataFrame:
    """key, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added; one row per row."""
    source = docs.select(F.col(key), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("searched"))
    found = store(source.select(key, candidates(F.col("searched"), gazetteers).alias("candidates")))
    weights = train(found)

    def spans(c: Column) -> Column:
        return F.transform(c, lambda x: F.struct(x["start"].alias("start"), x["rank"].alias("rank"), x["end"].alias("end"))).cast(SPANS)

    def of_rank(rank: int) -> Column:
        return F.size(F.filter("base", lambda c: c["rank"] == rank)).cast("long")

    base = F.filter("candidates", lambda c: c["base"])
    added = F.filter("candidates", lambda c: ~c["base"] & (chance(c, weights) >= accept)) if weights else F.filter("candidates", lambda c: F.lit(False))
    split = found.select(key, base.alias("base"), added.alias("added"))
    return split.select(
        key,
        *(of_rank(k).alias(f"n_{name}") for k, name in enumerate(BASE_KINDS)),
        F.sha2(joined(spans(F.col("base")), KINDS), 256).alias("base_sha256"),
        joined(spans(F.concat("base", "added")), KINDS).alias("spans"),
        F.size("added").cast("long").alias("n_added"),
    )
