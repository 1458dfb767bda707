"""Declared schemas of the data in flight and at rest."""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.StringType(), True) for name in names]


# --- fixed values: field names and their order ---
COMPANY_FIELDS = ("company_ticker", "company_name", "company_id", "base_url")
FILING_FIELDS = (
    "filing_type",
    "filing_date",
    "report_date",
    "accession_number",
    "primary_document",
    "cik",
)
FILING_COLUMNS = ("source_kind",) + FILING_FIELDS
INDEX_COLUMN = "__index_level_0__"

# Fields of a discovery item that are read; VARIANT tells a text from a number.
ITEM_FIELDS = (
    "title", "url", "date", "type", "article_type", "is_pdf", "filepath", "form",
    *FILING_FIELDS,
)
ITEM = ", ".join(f"{name}: variant" for name in ITEM_FIELDS)

COMPANY = T.StructType(_strings(*COMPANY_FIELDS))

DOCUMENT = T.StructType(
    _strings("title", "company_name", "company_id", "company_ticker", "base_url")
    + [T.StructField("year", T.IntegerType(), True)]
    + _strings("date", "url", "type", "filepath")
    + [T.StructField("downloaded", T.BooleanType(), True)]
    + _strings("gcs_uri", "source_kind", *FILING_FIELDS)
)

FEATURES = T.StructType(
    [
        T.StructField("summary", T.StringType(), True),
        T.StructField("key_entities", T.ArrayType(T.StringType()), True),
        T.StructField("topics", T.ArrayType(T.StringType()), True),
    ]
)

ARTICLE_RECORD = T.StructType(
    _strings("document_id", "company_id", "company_ticker")
    + [T.StructField("year", T.LongType(), True)]
    + _strings("title", "source_url", "source_gcs_uri", "document_type")
    + _strings("standard_features")
    + [
        T.StructField("ingestion_timestamp", T.TimestampType(), True),
        T.StructField("date", T.DateType(), True),
        T.StructField("gemini_file_uri", T.StringType(), True),
        T.StructField("gemini_chunk_uris", T.ArrayType(T.StringType()), True),
        T.StructField("gemini_chunk_count", T.LongType(), True),
    ]
)

FILING_RECORD = T.StructType(ARTICLE_RECORD.fields + _strings(*FILING_COLUMNS))

METADATA_ROW = T.StructType(
    _strings("metadata_id", *COMPANY_FIELDS[:3], "base_url")
    + [T.StructField("year", T.LongType(), True)]
    + _strings(
        "provider",
        "matched_on",
        "source_snapshot_uri",
        "source_snapshot_date",
        "metadata_json",
        "source_record_json",
        "ingestion_timestamp",
    )
)
