"""Outcome classes, load routing and run summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from docflow.config import (
    DEFAULT_SOURCES,
    DOCUMENTS_TABLE,
    FILINGS,
    FILINGS_TABLE,
    METADATA,
    METADATA_TABLE,
)
from docflow.functions.layout import STAGE_ARTICLES, STAGE_FILINGS, URI
from docflow.operators.split import Split, split_by

# --- fixed values: summary messages ---
NO_DOCUMENTS = "No documents found."
ALL_STORED = "All documents already ingested."
COMPLETED = "Ingestion completed."


def classify_outcomes(results: DataFrame) -> DataFrame:
    """``outcome``: skipped, processed or failed."""
    skipped = F.coalesce(F.col("skipped"), F.lit(False))
    success = F.coalesce(F.col("success"), F.lit(False))
    outcome = F.when(skipped, "skipped").when(success, "processed").otherwise("failed")
    return results.withColumn("outcome", outcome)


def target_table(kind: Column | None = None) -> Column:
    """Table a row is loaded into, by its source family."""
    kind = F.col("source_kind") if kind is None else kind
    return (
        F.when(kind == FILINGS, FILINGS_TABLE)
        .when(kind == METADATA, METADATA_TABLE)
        .otherwise(DOCUMENTS_TABLE)
    )


def route_to_table(results: DataFrame) -> DataFrame:
    return results.withColumn("table_id", target_table())


def has_stage_uri(results: DataFrame, fallback: str | None = None) -> Split:
    """Rows that can be loaded: a stage URI, or the older prod URI column."""
    uris = [F.nullif(F.col("stage_uri"), F.lit(""))]
    if fallback is not None:
        uris.append(F.nullif(F.col(fallback), F.lit("")))
    found = results.withColumn("load_uri", F.coalesce(*uris))
    return split_by(found, F.col("load_uri").isNotNull())


def valid_uri(df: DataFrame, uri: str, promotable: bool = False) -> Split:
    """Well-formed ``gs://bucket/key`` texts; optionally only promotable keys."""
    passes = F.col(uri).rlike(URI)
    if promotable:
        key = F.regexp_extract(F.col(uri), URI, 2)
        passes &= key.startswith(STAGE_ARTICLES) | key.startswith(STAGE_FILINGS)
    return split_by(df, passes)


def load_row_counts(loads: DataFrame) -> DataFrame:
    return loads.groupBy("table_id", "source_uri").agg(F.count("*").alias("row_count"))


def table_row_count(table: DataFrame) -> DataFrame:
    return table.agg(F.count("*").alias("row_count"))


def success_counts(results: DataFrame) -> DataFrame:
    """Successes and total per company and year; skipped documents count as success."""
    return results.groupBy("company_ticker", "year").agg(
        F.count_if(F.coalesce(F.col("success"), F.lit(False))).alias("successes"),
        F.count("*").alias("total"),
    )


def _first_error(source_kind: str) -> Column:
    """Message of a source's first failure; one buffered value per group."""
    failed = (F.col("source_kind") == source_kind) & F.col("error").isNotNull()
    return F.min(F.when(failed, F.struct("pos", "error")))["error"]


def error_details(errors: DataFrame) -> DataFrame:
    """``articles: msg; edgar: msg`` per company and year, in source order."""
    known = F.col("error").isNotNull() & F.col("source_kind").isin(*DEFAULT_SOURCES)
    grouped = errors.where(known).groupBy("company_ticker", "year").agg(
        *[_first_error(kind).alias(kind) for kind in DEFAULT_SOURCES]
    )
    parts = [
        F.when(F.col(kind).isNotNull(), F.concat(F.lit(f"{kind}: "), F.col(kind)))
        for kind in DEFAULT_SOURCES
    ]
    return grouped.select(
        "company_ticker", "year", F.concat_ws("; ", *parts).alias("error_details")
    )


def failed_discoveries(sources: DataFrame) -> DataFrame:
    """Company-years that found nothing and had at least one source error.

    ``sources`` is (company_ticker, year, source_kind, pos, n_docs, error).
    """
    totals = sources.groupBy("company_ticker", "year").agg(
        F.sum("n_docs").alias("n_docs"), F.count("error").alias("n_errors"),
        *[_first_error(kind).alias(kind) for kind in DEFAULT_SOURCES],
    )
    parts = [
        F.when(F.col(kind).isNotNull(), F.concat(F.lit(f"{kind}: "), F.col(kind)))
        for kind in DEFAULT_SOURCES
    ]
    return totals.where((F.col("n_docs") == 0) & (F.col("n_errors") > 0)).select(
        "company_ticker",
        "year",
        F.concat(
            F.lit("Document discovery failed for "), F.col("company_ticker"),
            F.lit(": "), F.concat_ws("; ", *parts),
        ).alias("message"),
    )


def fail_if_all_sources_failed(sources: DataFrame) -> None:
    """Raise for the first company-year whose discovery failed without results."""
    failure = failed_discoveries(sources).select("message").head()
    if failure is not None:
        raise RuntimeError(failure["message"])


def run_summary(
    requests: DataFrame, outcomes: DataFrame, errors: DataFrame | None = None
) -> DataFrame:
    """One row per request with its counts, source errors and message.

    ``errors`` is (company_ticker, year, source_kind, pos, error) of discovery; a
    completed run lists them in ``source_errors``. ``requests`` is (company_ticker, year, source); ``outcomes`` is
    (company_ticker, year, outcome, n, promoted) with outcome stored, duplicate,
    skipped, processed or failed. Counts are combined before the shuffle, so a
    company with most of the documents costs no more than any other.
    """
    n = F.col("n")

    def total(*names: str) -> Column:
        return F.sum(F.when(F.col("outcome").isin(*names), n).otherwise(0))

    counted = outcomes.groupBy("company_ticker", "year").agg(
        F.sum(n).alias("discovered"),
        total("duplicate", "skipped", "processed", "failed").alias("_new"),
        total("processed").alias("processed"),
        total("skipped").alias("skipped"),
        F.sum(F.when(F.col("promoted"), n).otherwise(0)).alias("promoted"),
    )
    found = F.coalesce(F.col("discovered"), F.lit(0))
    early = (found == 0) | (F.col("_new") == 0)
    failed = F.lit(None).cast("string")
    rows = requests.join(counted, ["company_ticker", "year"], "left")
    if errors is not None:
        rows = rows.join(error_details(errors), ["company_ticker", "year"], "left")
        failed = F.nullif(F.when(~early, F.col("error_details")), F.lit(""))
    return rows.select(
        F.col("company_ticker").alias("company"),
        "year",
        "source",
        found.cast("long").alias("discovered"),
        F.when(early, F.lit(0)).cast("long").alias("ingested"),
        *[
            F.when(~early, F.col(name)).alias(name)
            for name in ("processed", "skipped", "promoted")
        ],
        failed.alias("source_errors"),
        F.when(found == 0, NO_DOCUMENTS)
        .when(F.col("_new") == 0, ALL_STORED)
        .otherwise(COMPLETED)
        .alias("message"),
    )
