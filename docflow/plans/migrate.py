"""Migration of older filing rows into the filings layout and table."""

from __future__ import annotations

import datetime as dt
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F

from docflow.config import FILINGS
from docflow.functions.dates import row_date
from docflow.functions.layout import prod_filing_key
from docflow.operators.migration import (
    classify_moves,
    drop_index_column,
    exists_in_listing,
    legacy_filing_candidates,
    limit_candidates,
    move_counts,
    normalize_legacy_rows,
    optional_filters,
    planned_by_date,
    with_target,
)
from docflow.operators.summaries import table_row_count
from docflow.session import work_dir
from docflow.sinks import journal, writers


class MigrationPlan(NamedTuple):
    candidates: DataFrame
    moves: DataFrame
    rows: DataFrame
    prod_uris: DataFrame
    by_date: DataFrame
    counts: DataFrame


def migration_candidates(
    table: DataFrame,
    source_bucket: str,
    ticker: str | None = None,
    date: str | dt.date | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Candidate rows; ordered only where a limit makes the order matter."""
    rows = optional_filters(
        legacy_filing_candidates(drop_index_column(table), source_bucket), ticker, date
    )
    return rows if limit is None else limit_candidates(rows, limit)


def plan_migration(
    table: DataFrame,
    objects: DataFrame | None,
    source_bucket: str,
    prod_bucket: str,
    *,
    ticker: str | None = None,
    date: str | dt.date | None = None,
    limit: int | None = None,
    allow_missing: bool = False,
    current_year: int | None = None,
) -> MigrationPlan:
    """Everything a migration would do. Without a listing it is a dry run."""
    candidates = migration_candidates(table, source_bucket, ticker, date, limit)
    targeted = with_target(candidates, source_bucket, current_year)
    dry_run = objects is None
    located = targeted if dry_run else exists_in_listing(targeted, objects)
    moves = classify_moves(located, allow_missing, dry_run)
    flags = ("move", "source_exists", "target_exists")
    rows = normalize_legacy_rows(
        moves.where(F.col("move") != "error").drop(*flags), current_year
    )
    uri = F.concat(
        F.lit(f"gs://{prod_bucket}/"), prod_filing_key(row_date(current_year=current_year))
    )
    return MigrationPlan(
        candidates,
        moves,
        rows,
        targeted.select("document_id", uri.alias("prod_uri")),
        planned_by_date(candidates, current_year),
        move_counts(moves),
    )


class MigrationReport(NamedTuple):
    """What an executed migration did.

    ``row_count`` of the table (of prod where the load is skipped), every candidate's
    ``moves`` decision (the ``move`` rows are the byte moves for the storage's transfer
    job), rows ``by_date``, moved and missing ``counts``, and the planned ``prod_uris``.
    """

    row_count: DataFrame
    moves: DataFrame
    by_date: DataFrame
    counts: DataFrame
    prod_uris: DataFrame


def execute_migration(
    spark: SparkSession,
    table: DataFrame,
    objects: DataFrame,
    root: str,
    source_bucket: str,
    prod_bucket: str,
    *,
    skip_load: bool = False,
    skip_gcs: bool = False,
    **options,
) -> MigrationReport:
    """Create the filings table, rewrite prod, load what the table lacks, report.

    A source that is missing without leave stops the job before any write, as does an
    unreadable URI. ``skip_gcs`` moves and writes nothing: prod is taken as it is and the
    candidates it holds are loaded. Migrated rows are written once and replace only their
    own older prod rows; rows the table has already are not loaded again, so the job can
    be repeated and done in parts. Byte moves are entered in the journal
    (:mod:`docflow.sinks.journal`) before prod names their targets; a move that is under way
    keeps its state.
    """
    plan = plan_migration(table, objects, source_bucket, prod_bucket, **options)
    work = work_dir(spark, "migrate")
    plan.moves.write.parquet(f"{work}/moves")
    moves = spark.read.schema(plan.moves.schema).parquet(f"{work}/moves")
    current_year = options.get("current_year")
    target = writers.table_path(root, FILINGS)
    if skip_gcs:
        rows = moves.select("document_id")
    else:
        broken = moves.where(F.col("move") == "error").select("source_gcs_uri").head()
        if broken is not None:
            raise FileNotFoundError(f"source object not found: {broken['source_gcs_uri']!r}")
        flags = ("move", "source_exists", "target_exists")
        rows = normalize_legacy_rows(moves.drop(*flags), current_year)
        journal.plan(spark, root, moves.where(F.col("move") == "move"))
        writers.rewrite_prod(spark, rows, root)
    prod = writers.read_prod(spark, root, FILINGS)
    if not skip_load:
        writers.create_filings_table(spark, prod, target)
        writers.bulk_load(spark, [writers.prod_path(root, FILINGS)], target, among=rows)
    counted = prod if skip_load else writers.loaded_ids(spark, root, FILINGS)
    return MigrationReport(
        table_row_count(counted),
        moves,
        planned_by_date(moves, current_year),
        move_counts(moves.where(F.lit(not skip_gcs))),
        plan.prod_uris,
    )
