"""Whitespace, blanks and small string rules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

ColumnOrName = Column | str

# Every character Unicode counts as white space (F.trim strips only the blank).
_SPACE_RANGES = ((0x09, 0x0D), (0x1C, 0x20), (0x85, 0x85), (0xA0, 0xA0),
                 (0x1680, 0x1680), (0x2000, 0x200A), (0x2028, 0x2029),
                 (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000))
WHITESPACE = "".join(chr(c) for lo, hi in _SPACE_RANGES for c in range(lo, hi + 1))

# --- fixed values ---
SEARCH_URL = "https://www.google.com/search?q="


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and hand it to ``body`` as a lambda variable.

    Keeps a value used in many places from being written out, and computed, in
    each of them, also where a later filter is pushed through the projection.
    """
    return F.transform(F.array(value), body)[0]


def strip(c: ColumnOrName) -> Column:
    return F.btrim(col(c), F.lit(WHITESPACE))


def blank_to_null(c: ColumnOrName) -> Column:
    return F.nullif(strip(c), F.lit(""))


def cik10(c: ColumnOrName) -> Column:
    """Zero-fill an all-digit number to ten places; longer ones stay whole."""
    c = col(c)
    short_number = c.rlike(r"^\p{Nd}+$") & (F.char_length(c) < 10)
    return F.when(short_number, F.lpad(c, 10, "0")).otherwise(c)


def default_company_id(company_id: ColumnOrName, ticker: ColumnOrName) -> Column:
    return F.coalesce(
        blank_to_null(company_id), F.concat(F.lit("com_"), F.lower(col(ticker)))
    )


def search_base_url(name: ColumnOrName) -> Column:
    return F.concat(F.lit(SEARCH_URL), col(name))
