"""Two-way splits of a frame."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F


class Split(NamedTuple):
    """Rows that pass and rows that do not; together they are the whole input."""

    valid: DataFrame
    rejected: DataFrame


def split_by(df: DataFrame, passes: Column) -> Split:
    """Split on a predicate; an unknown answer counts as a rejection."""
    passes = F.coalesce(passes, F.lit(False))
    return Split(df.where(passes), df.where(~passes))
