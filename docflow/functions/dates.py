"""Partition dates.

Accepted date texts are the ISO 8601 calendar forms ``YYYY-MM-DD`` and
``YYYYMMDD`` and the week forms ``YYYY-Www[-D]`` and ``YYYYWww[D]``. A plain
cast would also take ``2024`` or ``2024-3-5``, so the text is matched first.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from docflow.functions.text import ColumnOrName, bind, col, strip

# A text of neither calendar form becomes "--", which casts to null.
CALENDAR = r"(?s)^(?!0000)([0-9]{4})(-?)([0-9]{2})\2([0-9]{2})$|^.*$"
WEEK = r"^(?!0000)([0-9]{4})(?:-W([0-9]{2})(?:-([0-9]))?|W([0-9]{2})([0-9])?)$"


def _week_date(text: Column) -> Column:
    """Date of a week text; the day of the week defaults to Monday."""
    parts = F.split(F.regexp_replace(text, WEEK, "$1-$2$4-$3$5"), "-")

    def from_parts(part: Column) -> Column:
        year, week = part[0].cast("int"), part[1].cast("int")
        day = F.coalesce(F.nullif(part[2], F.lit("")), F.lit("1")).cast("int")
        # 4 January always lies in week 1 and 28 December always in the last week.
        week_one = F.make_date(year, F.lit(1), F.lit(4))
        last_week = F.weekofyear(F.make_date(year, F.lit(12), F.lit(28)))
        monday = F.date_sub(week_one, F.weekday(week_one))
        valid = week.between(1, last_week) & day.between(1, 7)
        return F.when(valid, F.date_add(monday, (week - 1) * 7 + day - 1))

    return F.when(text.rlike(WEEK), bind(parts, from_parts))


def iso_date(c: ColumnOrName) -> Column:
    """DATE of an accepted date text, else null."""
    text = strip(c)
    calendar = F.regexp_replace(text, CALENDAR, "$1-$3-$4").try_cast("date")
    return F.coalesce(calendar, _week_date(text))


def year_end(year: ColumnOrName) -> Column:
    return F.concat(col(year).cast("string"), F.lit("-12-31"))


def partition_date(date: ColumnOrName = "date", year: ColumnOrName = "year") -> Column:
    """ISO text of the document date, or the last day of its year."""
    return F.coalesce(iso_date(date).cast("string"), year_end(year))


def row_date(
    date: ColumnOrName = "date",
    year: ColumnOrName = "year",
    current_year: Column | int | None = None,
) -> Column:
    """Partition date of a stored row: its date, else the end of its year."""
    if current_year is None:
        current_year = F.year(F.current_date())
    elif isinstance(current_year, int):
        current_year = F.lit(current_year)
    known_year = F.coalesce(F.nullif(col(year), F.lit(0)), current_year)
    return F.coalesce(
        F.nullif(col(date).cast("string"), F.lit("")), year_end(known_year)
    )
