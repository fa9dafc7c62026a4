"""Strict text -> value parsers.

Raw values are text. A value that does not parse becomes NULL; the caller
turns that into a finding. All of these are plain Column expressions and stay
inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ISO calendar date, whole value only (``\z``, so a trailing newline fails too).
ISO_DATE_PATTERN = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z"
# Plain decimal number with optional sign and exponent; no grouping, no suffixes, ASCII digits.
NUMBER_PATTERN = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?\z"

_INF = float("inf")


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def iso_date(c: Column | str) -> Column:
    """``YYYY-MM-DD`` that is a real calendar date (years 0001-9999), else NULL."""
    c = col(c)
    return F.when(c.rlike(ISO_DATE_PATTERN) & (F.substring(c, 1, 4) != "0000"), c.try_cast("date"))


def is_iso_text(c: Column | str) -> Column:
    """Pattern-only ISO check (no calendar check), as used by conformance SD0007."""
    return col(c).rlike(ISO_DATE_PATTERN)


def to_number(c: Column | str) -> Column:
    """Decimal text -> double; anything else, and non-finite results, -> NULL."""
    c = col(c)
    x = F.when(c.rlike(NUMBER_PATTERN), c.try_cast("double"))
    return F.when(F.abs(x) < F.lit(_INF), x)


def toxicity_grade(c: Column | str) -> Column:
    """A number equal to one of 1..5 (``3.0`` is fine, ``2.5`` is not) as int, else NULL."""
    g = to_number(c)
    return F.when(g.isin(1.0, 2.0, 3.0, 4.0, 5.0), g.cast("int"))
