"""Text to typed values. Text that does not parse gives null under either ANSI setting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

_WHOLE_NUMBER = r"^[+-]?(\d+(\.\d*)?|\.\d+)$"

# What a cast takes off at both ends: blanks and control characters.
_CAST_BLANKS = "".join(map(chr, range(33)))


def trimmed(name: str) -> Column:
    return F.trim(F.col(name))


def code_text(name: str) -> Column:
    """Identifier text: surrounding blanks off, upper case."""
    return F.upper(trimmed(name))


def whole_number(name: str) -> Column:
    """``'800'``, ``'800.0'`` and ``'\\t800'`` give 800, ``'.5'`` gives 0; exponents and other text
    give null."""
    text = F.btrim(F.col(name), F.lit(_CAST_BLANKS))
    digits = F.regexp_replace(F.substring_index(text, ".", 1), r"^([+-]?)$", "$10")
    return F.when(text.rlike(_WHOLE_NUMBER), digits.try_cast("int"))


def real_number(name: str) -> Column:
    """A double; the text ``NaN`` counts as missing, as Spark would rank NaN above all numbers."""
    return F.nanvl(trimmed(name).try_cast("double"), F.lit(None).cast("double"))


def first_date(name: str, formats: Sequence[str]) -> Column:
    """The date under the first format that fits.

    A failed parse costs a caught exception per row, so each format is tried only on text that
    holds all of that format's separators.
    """
    text = F.col(name)
    attempts = []
    for fmt in formats:
        parsed = F.try_to_date(text, fmt)
        for separator in sorted({c for c in fmt if not c.isalnum()}):
            parsed = F.when(F.contains(text, F.lit(separator)), parsed)
        attempts.append(parsed)
    return F.coalesce(*attempts)


def is_blank(column: Column) -> Column:
    return F.coalesce(column, F.lit("")) == ""
