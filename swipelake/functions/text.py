"""Money text, currency marks, card masks, flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as a currency mark and as part of a number.
LEADING_NON_DIGITS = r"^[^0-9]+"
LEADING_MARK_WITHOUT_SIGN = r"^[^0-9.\-]+"
NOT_PART_OF_A_NUMBER = r"[^0-9.\-]"


def as_column(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_money(col: Column | str) -> Column:
    """``$1,234.50`` to 1234.5. Text that holds no number gives null, also in ANSI mode."""
    return F.regexp_replace(as_column(col), NOT_PART_OF_A_NUMBER, "").try_cast("double")


def currency_mark(col: Column | str, keep_sign: bool = True) -> Column:
    """Text before the first digit.

    A negative amount keeps its sign (``$-77.00`` gives ``$-``) unless ``keep_sign`` is off.
    """
    pattern = LEADING_NON_DIGITS if keep_sign else LEADING_MARK_WITHOUT_SIGN
    return F.regexp_extract(as_column(col), pattern, 0)


def mask_card(col: Column | str, visible: int = 3) -> Column:
    """Stars for all but the last ``visible`` characters, without a look-ahead regex per row."""
    text = as_column(col).cast("string")
    hidden = F.greatest(F.length(text) - F.lit(visible), F.lit(0))
    return F.concat(F.repeat(F.lit("*"), hidden), F.right(text, F.lit(visible)))


def has_text(col: Column | str) -> Column:
    """Neither null nor empty."""
    c = as_column(col)
    return c.isNotNull() & (c != F.lit(""))


def flag(col: Column | str, value: str) -> Column:
    """1 where the column equals ``value``, else 0, null included."""
    return F.when(as_column(col) == F.lit(value), 1).otherwise(0)
