"""Company metadata ingestion for all requested companies at once."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from docflow.config import METADATA
from docflow.functions.identity import metadata_id
from docflow.functions.layout import metadata_stage_key
from docflow.functions.text import strip
from docflow.operators.company_metadata import (
    metadata_artifacts,
    normalize_provider,
    stage_rows,
    valid_metadata_response,
)
from docflow.operators.normalize import normalize_company
from docflow.operators.split import Split
from docflow.schemas import METADATA_ROW
from docflow.session import work_dir
from docflow.sinks import versions, writers

# --- fixed values: summary messages ---
NOT_FOUND = "No company metadata found."
COMPLETED = "Company metadata ingestion completed."


class MetadataResult(NamedTuple):
    rows: DataFrame
    rejected: DataFrame
    summary: DataFrame


def requested(companies: DataFrame, year: int, provider: str) -> DataFrame:
    return normalize_company(companies).withColumns(
        {"year": F.lit(year), "provider": F.lit(normalize_provider(provider))}
    )


def answered(requests: DataFrame, responses: DataFrame) -> Split:
    """Requests with a response, split into usable and unusable ones.

    ``responses`` is (company_ticker, year, provider, body, response), one row
    per request at most; a request without one has no metadata.
    """
    ticker = F.upper(strip("company_ticker"))
    landed = responses.select(
        ticker.alias("company_ticker"), "year", "provider", "body", "response"
    )
    joined = requests.join(landed, ["company_ticker", "year", "provider"])
    return valid_metadata_response(joined)


def metadata_summary(requests: DataFrame, artifacts: DataFrame, prod_bucket: str) -> DataFrame:
    """One row per request: counts, id, prod URI and message."""
    made = artifacts.select("metadata_id", F.lit(True).alias("_made"), "_key")
    key = F.regexp_replace("_key", "^stage/", "prod/")
    found = F.coalesce(F.col("_made"), F.lit(False))
    count = found.cast("long")
    return (
        requests.withColumn("metadata_id", metadata_id())
        .join(made, "metadata_id", "left")
        .select(
            F.col("company_ticker").alias("company"),
            F.lit(METADATA).alias("source"),
            F.when(found, F.col("provider")).alias("provider"),
            *[count.alias(n) for n in ("discovered", "processed", "promoted")],
            F.when(found, F.col("metadata_id")).alias("metadata_id"),
            F.when(found, F.concat(F.lit(f"gs://{prod_bucket}/"), key)).alias("prod_gcs_uri"),
            F.when(found, COMPLETED).otherwise(NOT_FOUND).alias("message"),
        )
    )


def ingest_company_metadata(
    companies: DataFrame,
    responses: DataFrame,
    year: int,
    provider: str = "lseg",
    prod_bucket: str = "b",
    run_ts: Column | None = None,
) -> MetadataResult:
    """Rows, rejected responses and summary, without writing anything."""
    requests = requested(companies, year, provider)
    usable, rejected = answered(requests, responses)
    artifacts = metadata_artifacts(usable)
    keyed = artifacts.withColumn("_key", metadata_stage_key())
    return MetadataResult(
        stage_rows(artifacts, run_ts), rejected, metadata_summary(requests, keyed, prod_bucket)
    )


def run_company_metadata(
    spark: SparkSession, companies: DataFrame, responses: DataFrame, year: int,
    root: str, provider: str = "lseg", prod_bucket: str = "b",
) -> DataFrame:
    """Stage, load, log, promote; returns the summary, kept below ``runs/``.

    Rows an interrupted run has loaded already are not loaded twice. The summary is
    made after promotion, from the rows that are in the table by then.
    """
    made = ingest_company_metadata(companies, responses, year, provider, prod_bucket)
    stage = writers.stage_company_metadata(spark, made.rows, root)
    rows = writers.read_company_metadata_rows(spark, stage)
    table = writers.table_path(root, METADATA)
    known = versions.read(spark, table, METADATA_ROW).select("metadata_id")
    new = rows.join(known, "metadata_id", "left_anti").select(*rows.columns)
    writers.append_load(spark, new, table)
    writers.append_load_log(rows, METADATA, f"{root}/load_log", prod_bucket)
    writers.promote_metadata(spark, root)
    requests = requested(companies, year, provider)
    loaded = versions.read(spark, table, METADATA_ROW).select("metadata_id", "company_ticker", "year", "provider")
    keyed = loaded.withColumn("_key", metadata_stage_key()).dropDuplicates(["metadata_id"])
    summary = metadata_summary(requests, keyed, prod_bucket)
    path = work_dir(spark, "metadata").rsplit("/", 1)[-1]
    summary.write.parquet(f"{root}/runs/{path}/summary")
    return spark.read.schema(summary.schema).parquet(f"{root}/runs/{path}/summary")
