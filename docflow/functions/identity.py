"""Stable identifiers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from docflow.config import FILINGS
from docflow.functions.text import ColumnOrName, col


def short_hash(c: Column) -> Column:
    return F.substring(F.md5(c), 1, 16)


def _text(c: ColumnOrName) -> Column:
    return col(c).cast("string")


def document_id() -> Column:
    """Id of a normalised document; filings hash their accession, others the title."""
    has_accession = F.nullif(F.col("accession_number"), F.lit("")).isNotNull()
    filing = F.concat(
        F.col("accession_number"), F.lit(":"),
        F.coalesce(F.col("primary_document"), F.lit("")),
    )
    hashed = F.when(
        (F.col("source_kind") == FILINGS) & has_accession, filing
    ).otherwise(F.col("title"))
    return F.concat(
        F.col("company_id"), F.lit("_"), _text("year"), F.lit("_"), short_hash(hashed)
    )


def metadata_id(provider: ColumnOrName = "provider") -> Column:
    """Id of a company metadata row, over the company that was asked for."""
    key = F.concat(
        F.col("company_id"), F.lit("|"), F.col("company_ticker"), F.lit("|"),
        F.col("base_url"), F.lit("|"), _text("year"), F.lit("|"), col(provider),
    )
    return F.concat(
        F.col("company_id"), F.lit("_"), _text("year"), F.lit("_"), col(provider),
        F.lit("_"), short_hash(key),
    )


def ingestion_key() -> Column:
    """Key under which one document is ingested at most once per run."""
    return F.concat(
        F.lit("knowledge-ingestion-"), F.col("company_ticker"), F.lit("-"),
        _text("year"), F.lit("-"), F.col("source_kind"), F.lit("-"),
        F.substring_index(F.col("filepath"), "/", -1),
    )
