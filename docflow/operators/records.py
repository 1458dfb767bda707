"""Source URIs, relocation plans and stage records."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from docflow.config import FILINGS
from docflow.functions.dates import partition_date
from docflow.functions.features import features_json
from docflow.functions.layout import filing_source_key, is_filing, uri_key
from docflow.schemas import ARTICLE_RECORD, FILING_COLUMNS, FILING_RECORD


def resolve_source_uri(docs: DataFrame, fetched: DataFrame) -> DataFrame:
    """``source_gcs_uri``: the given URI of a downloaded document, else the fetched one.

    ``fetched`` is (url, fetched_uri), one row per URL. A document with neither
    keeps a null URI and ``needs_fetch``.
    """
    given = F.when(F.col("downloaded") & (F.col("gcs_uri") != ""), F.col("gcs_uri"))
    uri = F.coalesce(given, F.nullif(F.col("fetched_uri"), F.lit("")))
    return (
        docs.join(fetched, "url", "left")
        .withColumns({"source_gcs_uri": uri, "needs_fetch": given.isNull()})
        .drop("fetched_uri")
    )


def plan_relocation(docs: DataFrame, source_bucket: str) -> DataFrame:
    """Canonical URI of each filing's raw file and whether it has to move."""
    canonical = F.concat(
        F.lit(f"gs://{source_bucket}/"), filing_source_key(uri_key("source_gcs_uri"))
    )
    target = F.when(is_filing(), canonical).otherwise(F.col("source_gcs_uri"))
    return docs.withColumn("target_gcs_uri", target).withColumn(
        "needs_move", F.col("source_gcs_uri") != F.col("target_gcs_uri")
    )


def build_records(docs: DataFrame, run_ts: Column | None = None) -> DataFrame:
    """Stage rows of documents with ``features`` and a source URI.

    Rows without a chunk list are direct ones and get an empty list and 0. The
    frame holds both families; :func:`family_records` gives each its columns.
    """
    run_ts = F.current_timestamp() if run_ts is None else run_ts
    no_chunks = F.array().cast("array<string>")
    chunks = (
        F.coalesce(F.col("gemini_chunk_uris"), no_chunks)
        if "gemini_chunk_uris" in docs.columns
        else no_chunks
    )
    return docs.select(
        "document_id",
        "company_id",
        "company_ticker",
        F.col("year").cast("long").alias("year"),
        "title",
        F.col("url").alias("source_url"),
        "source_gcs_uri",
        F.col("type").alias("document_type"),
        features_json("features").alias("standard_features"),
        run_ts.alias("ingestion_timestamp"),
        partition_date().cast("date").alias("date"),
        F.col("source_gcs_uri").alias("gemini_file_uri"),
        chunks.alias("gemini_chunk_uris"),
        F.size(chunks).cast("long").alias("gemini_chunk_count"),
        *FILING_COLUMNS,
    )


def family_records(records: DataFrame, source_kind: str) -> DataFrame:
    """Records of one family; article rows do not have the filing columns."""
    filings = F.col("source_kind") == FILINGS
    if source_kind == FILINGS:
        return cast_stage_types(records.where(filings), FILING_RECORD)
    return cast_stage_types(records.where(~filings).drop(*FILING_COLUMNS), ARTICLE_RECORD)


def cast_stage_types(df: DataFrame, declared: T.StructType = FILING_RECORD) -> DataFrame:
    """Force the declared type of every known column the frame has; keep the rest."""
    types = {field.name: field.dataType for field in declared}
    return df.select(
        *[
            F.col(name).cast(types[name]).alias(name) if name in types else F.col(name)
            for name in df.columns
        ]
    )


def add_missing_columns(df: DataFrame, fields: list[T.StructField]) -> DataFrame:
    """Append the fields the frame lacks, as nulls."""
    missing = [f for f in fields if f.name not in df.columns]
    return df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing})


def add_filing_columns(df: DataFrame) -> DataFrame:
    """Append whichever of the seven filing columns are missing."""
    return add_missing_columns(df, FILING_RECORD.fields[-len(FILING_COLUMNS):])


def evolve_schema(frames: list[DataFrame]) -> DataFrame:
    """Append in order; columns new to a later frame are null in earlier rows."""
    return reduce(
        lambda old, new: old.unionByName(new, allowMissingColumns=True), frames
    )
