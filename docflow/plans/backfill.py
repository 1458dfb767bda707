"""Filing backfill of every company named in a set of holdings files."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from docflow.config import BACKFILL_FIRST_YEAR, BACKFILL_LAST_YEAR, FILINGS, Settings
from docflow.operators.backfill import (
    first_company_per_ticker,
    holdings_to_companies,
    valid_holdings,
)
from docflow.operators.extract import Extractor
from docflow.functions.identity import document_id
from docflow.operators.gates import anti_join_stored, mark_known
from docflow.operators.normalize import company_years, filings_to_documents
from docflow.operators.split import Split
from docflow.operators.summaries import success_counts
from docflow.plans.ingest import (
    ingest_documents,
    kept,
    requested_items,
    route_documents,
    with_success,
    write_gated,
)
from docflow.session import work_dir
from docflow.sinks.writers import delete_path


class BackfillResult(NamedTuple):
    records: DataFrame
    results: DataFrame
    counts: DataFrame
    rejected: DataFrame


def backfill_companies(holdings: DataFrame) -> DataFrame:
    """The company list; this is all a dry run reports."""
    return holdings_to_companies(first_company_per_ticker(valid_holdings(holdings)))


def fresh_filings(
    holdings: DataFrame, filings: DataFrame, names: DataFrame, first_year: int, last_year: int
) -> Split:
    """Filings of the holdings' companies past gate 1, and the items that cannot be used."""
    asked = company_years(backfill_companies(holdings), first_year, last_year)
    requests = asked.withColumn("source_kind", F.lit(FILINGS))
    items = requested_items(requests, filings, FILINGS)
    docs = filings_to_documents(items.valid)
    fresh = anti_join_stored(docs, names).drop("prefix", "filename")
    return Split(fresh, items.rejected.select("company_ticker", "year", "pos", "reject_reason"))


def backfill(
    holdings: DataFrame,
    filings: DataFrame,
    names: DataFrame,
    known: DataFrame,
    contents: DataFrame,
    pages: DataFrame,
    settings: Settings,
    first_year: int = BACKFILL_FIRST_YEAR,
    last_year: int = BACKFILL_LAST_YEAR,
    run_ts: Column | None = None,
    extractor: Extractor | None = None,
) -> BackfillResult:
    """Discovered filings past gate 1, ingested, with successes per company-year.

    Known documents count as successes. ``counts`` has the company-years that
    had something to do. There are no sinks; :func:`run_backfill` has them. Gated and
    routed documents are written once to the work folder.
    """
    spark = holdings.sparkSession
    work = work_dir(spark, "backfill")
    fresh, rejected = fresh_filings(holdings, filings, names, first_year, last_year)
    gated = mark_known(fresh.withColumn("document_id", document_id()), known)
    gated = kept(spark, gated, f"{work}/gated")
    routed = route_documents(gated.where(~F.col("skipped")), contents, settings)
    routed = kept(spark, routed, f"{work}/routed")
    records, results = ingest_documents(
        gated, known, contents, pages, settings, run_ts, extractor, routed
    )
    filing_results = results.where(F.col("source_kind") == FILINGS)
    return BackfillResult(records, results, success_counts(filing_results), rejected)


def run_backfill(
    spark: SparkSession,
    holdings: DataFrame,
    filings: DataFrame,
    names: DataFrame,
    known: DataFrame,
    contents: DataFrame,
    pages: DataFrame,
    settings: Settings,
    root: str,
    first_year: int = BACKFILL_FIRST_YEAR,
    last_year: int = BACKFILL_LAST_YEAR,
    extractor: Extractor | None = None,
) -> DataFrame:
    """The backfill with its sinks: chunk parts, stage, load, log, promote.

    Returns the successes per company-year, kept below ``runs/`` with the rejected items.
    """
    work = work_dir(spark, "backfill")
    fresh, rejected = fresh_filings(holdings, filings, names, first_year, last_year)
    gated = mark_known(fresh.withColumn("document_id", document_id()), known)
    gated = kept(spark, gated, f"{work}/gated")
    done = write_gated(spark, gated, contents, pages, settings, root, work, extractor)
    counts = success_counts(with_success(gated, done))
    run = f"{root}/runs/{work.rsplit('/', 1)[-1]}"
    kept(spark, rejected, f"{run}/rejected")
    counts = kept(spark, counts, f"{run}/counts")
    delete_path(spark, work)
    return counts
