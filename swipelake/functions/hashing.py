"""Draws that depend only on a row's key: the same on every run, retry and engine."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from swipelake.functions.text import as_column

TWO_POW_32 = 4294967296


def key_digest(col: Column | str) -> Column:
    return F.md5(as_column(col).cast("string"))


def digest_word(digest: Column, word: int, hex_digits: int = 8) -> Column:
    """The ``word``-th group of hex digits as a number."""
    return F.conv(F.substring(digest, word * hex_digits + 1, hex_digits), 16, 10).cast("bigint")


def unit_draw(digest: Column, word: int = 0) -> Column:
    """A number in [0, 1)."""
    return digest_word(digest, word) / F.lit(float(TWO_POW_32))
