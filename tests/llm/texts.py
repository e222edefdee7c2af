"""A small table with every awkward case, and helpers of the tests."""

import random

PROSE = "the quick brown fox jumps over the lazy dog while seven wizards mix potent brews under a pale moon tonight".split()


def prose(seed, words):
    r = random.Random(seed)
    return " ".join(r.choice(PROSE) + r.choice(["", "", "s", "ed", ","]) for _ in range(words))


def rows():
    passage = prose("passage", 70)
    out = [
        (1, None, "en", "a"),
        (2, "", None, "a"),
        (3, "one", "en", None),
        (3, "one", "en", None),
        (None, "a text without a key, password=hunter2hunter2", "en", "a"),
        (4, " \n\t\x0b\f\r \n", "fr", "b"),
        (5, "two words", "fr", "b"),
        (6, "Ünïcode ☃ 𝒳 ﬁ ① ́e  x y <|endoftext|> <s>▁▁ ZWJ‍", "de", "b"),
        (7, "x" * 30_000 + " " + "1" * 30_000 + " " + "a.b" * 10_000, "de", "c"),
        (8, prose(8, 3000), "en", "c"),
        (9, prose(9, 40) + "\n" + passage + "\n" + prose(10, 30), "en", "c"),
        (10, prose(11, 30) + "\n" + passage, "en", "c"),
        (11, prose(12, 60), "en", "c"),
        (12, prose(12, 60), "en", "c"),
        (13, prose(12, 60), "en", "c"),
    ]
    out += [(20 + i, prose(i, 5 + 17 * i) + "\n" + prose(i, 9), "en", "c") for i in range(40)]
    return out


CLASHING = "key string, batch int, score double, kept boolean, simhash_bits long, gone_chunks string, left_text string, spans string, n_lines long, cell string"


def documents(spark, some=None):
    """The table with further columns whose names operators use inside."""
    some = rows() if some is None else some
    schema = f"doc_id long, text string, lang string, source string, n_chars long, {CLASHING}"
    more = ("k", 1, 0.5, True, 7, "g", "l", "s", 3, "c")
    return spark.createDataFrame([(*r, None if r[1] is None else len(r[1]), *more) for r in some], schema)
