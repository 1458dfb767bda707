"""JSON texts."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, functions as F, types as T
from pyspark.sql.functions import pandas_udf

from docflow.functions.text import ColumnOrName, col


def json_list_or_empty(c: ColumnOrName) -> Column:
    """Text array held as JSON; unreadable text gives ``[]``, null stays null."""
    c = col(c)
    parsed = F.coalesce(
        F.from_json(c, "array<string>"), F.array().cast("array<string>")
    )
    return F.when(c.isNotNull(), parsed)


@pandas_udf(T.StringType())
def _sorted_dump(texts: pd.Series) -> pd.Series:
    def dump(text: str | None) -> str | None:
        return None if text is None else json.dumps(json.loads(text), sort_keys=True)

    return texts.map(dump, na_action="ignore")


def sorted_json(c: ColumnOrName) -> Column:
    """The stored text form: sorted keys, ``", "``/``": "``, ASCII escapes.

    No built-in writes this exact text; one Arrow-batched helper does, on the
    company metadata rows only.
    """
    return _sorted_dump(col(c))
