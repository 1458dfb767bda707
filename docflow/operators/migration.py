"""Moving older filing rows into the filings layout."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from docflow.config import FILINGS
from docflow.functions.dates import iso_date, row_date
from docflow.functions.jsons import json_list_or_empty
from docflow.functions.layout import SOURCE_ARTICLES, SOURCE_FILINGS, URI, source_extension
from docflow.functions.text import strip
from docflow.schemas import INDEX_COLUMN

# --- fixed values: how an older row is recognised as a filing ---
FILING_URL = r"sec\.gov/(archives/edgar|ixviewer)"
FILING_FORM = r"(10-k|10-q|8-k|def 14a|20-f|40-f|s-1)"


def drop_index_column(df: DataFrame) -> DataFrame:
    return df.drop(INDEX_COLUMN)


def legacy_filing_candidates(rows: DataFrame, source_bucket: str) -> DataFrame:
    """Rows that look like filings and still lie under the articles prefix.

    The prefix test is written on the bare column so it reaches the scan.
    """
    looks_like = (
        F.lower("source_url").rlike(FILING_URL)
        | F.lower("title").rlike(FILING_FORM)
        | F.lower("source_gcs_uri").rlike(FILING_FORM)
    )
    legacy = F.col("source_gcs_uri").startswith(f"gs://{source_bucket}/{SOURCE_ARTICLES}")
    return rows.where(legacy & looks_like)


def optional_filters(
    rows: DataFrame, ticker: str | None = None, date: str | dt.date | None = None
) -> DataFrame:
    """Restrict to a ticker and/or a partition date, where given."""
    if ticker:
        rows = rows.where(F.upper("company_ticker") == ticker.upper())
    if date:
        rows = rows.where(F.col("date") == F.lit(date).cast("date"))
    return rows


def order_candidates(rows: DataFrame) -> DataFrame:
    return rows.orderBy("company_ticker", "date", "document_id")


def limit_candidates(rows: DataFrame, n: int | None = None) -> DataFrame:
    """Top ``n`` in candidate order; everything, ordered, without ``n``."""
    ordered = order_candidates(rows)
    return ordered if n is None else ordered.limit(n)


def target_source_key(current_year: int | None = None) -> Column:
    ticker = F.upper(strip(F.coalesce("company_ticker", F.lit(""))))
    return F.concat(
        F.lit(SOURCE_FILINGS), ticker, F.lit("/"), row_date(current_year=current_year),
        F.lit("/"), F.col("document_id"), F.lit("."),
        source_extension("source_gcs_uri", "document_type"),
    )


def with_target(
    rows: DataFrame, source_bucket: str, current_year: int | None = None
) -> DataFrame:
    """``target_uri``: where each row's raw file belongs."""
    return rows.withColumn(
        "target_uri", F.concat(F.lit(f"gs://{source_bucket}/"), target_source_key(current_year))
    )


def exists_in_listing(moves: DataFrame, objects: DataFrame) -> DataFrame:
    """``source_exists`` and ``target_exists`` against a listing; repeated URIs do no harm.

    Both joins read the same distinct URIs, which are dealt out once.
    """
    listed = objects.select("uri").distinct().select("uri", F.lit(True).alias("_hit"))

    def flag(df: DataFrame, column: str, name: str) -> DataFrame:
        side = listed.select(F.col("uri").alias(column), F.col("_hit").alias(name))
        return df.join(side, column, "left").fillna(False, [name])

    moves = flag(moves, "source_gcs_uri", "source_exists")
    return flag(moves, "target_uri", "target_exists")


def classify_moves(
    moves: DataFrame, allow_missing: bool = False, dry_run: bool = False
) -> DataFrame:
    """``move``: noop, move, moved (already there), planned, missing or error.

    A dry run looks at no storage: every readable URI counts as planned.
    """
    source = F.coalesce(F.col("source_gcs_uri"), F.lit(""))
    absent = F.lit("missing" if allow_missing else "error")
    decision = (
        F.when(source == "", absent)
        .when(~source.rlike(URI), "error")
        .when(source == F.col("target_uri"), "noop")
    )
    if dry_run:
        decision = decision.otherwise("planned")
    else:
        decision = (
            decision.when(F.col("source_exists"), "move")
            .when(F.col("target_exists"), "moved")
            .otherwise(absent)
        )
    return moves.withColumn("move", decision)


def move_counts(moves: DataFrame) -> DataFrame:
    counted = F.col("move").isin("noop", "move", "moved", "planned")
    return moves.agg(
        F.count_if(counted).alias("moved"),
        F.count_if(F.col("move") == "missing").alias("missing"),
    )


def planned_by_date(rows: DataFrame, current_year: int | None = None) -> DataFrame:
    """Rows per partition date, ascending."""
    return (
        rows.groupBy(row_date(current_year=current_year).alias("partition_date"))
        .agg(F.count("*").alias("row_count"))
        .orderBy("partition_date")
    )


def normalize_legacy_rows(rows: DataFrame, current_year: int | None = None) -> DataFrame:
    """Rows with ``target_uri`` in the shape of the filings table."""
    changes = {
        "source_gcs_uri": F.col("target_uri"),
        "source_kind": F.lit(FILINGS),
        "date": iso_date(row_date(current_year=current_year)),
    }
    if rows.schema["gemini_chunk_uris"].dataType.simpleString() == "string":
        changes["gemini_chunk_uris"] = json_list_or_empty("gemini_chunk_uris")
    return rows.withColumns(changes).drop("target_uri")
