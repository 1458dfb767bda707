"""Storage keys: prefixes, file names and the stage/prod layout."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from docflow.config import FILINGS
from docflow.functions.dates import partition_date, row_date
from docflow.functions.identity import document_id
from docflow.functions.text import ColumnOrName, col, strip

# --- fixed values: key prefixes of the stored layout ---
SOURCE_ARTICLES = "source/knowledge/"
SOURCE_FILINGS = "source/edgar/"
STAGE_ARTICLES = "stage/knowledge/"
STAGE_FILINGS = "stage/edgar/v1/"
PROD_ARTICLES = "prod/knowledge/"
PROD_FILINGS = "prod/edgar/v1/"
STAGE_METADATA = "stage/knowledge/company_metadata/"

URI = r"(?s)^gs://([^/]+)/(.+)$"
SUFFIX = r"(?s)^.+\.([^.]+)$"


def basename(path: ColumnOrName) -> Column:
    """Last segment of a path; trailing slashes and ``/.`` do not count."""
    trimmed = F.regexp_replace(col(path), r"(?:/\.?)+$", "")
    name = F.substring_index(trimmed, "/", -1)
    return F.when(name == ".", F.lit("")).otherwise(name)


def suffix(path: ColumnOrName) -> Column:
    """Lower-case suffix of the last segment without its dot, null if none."""
    found = F.regexp_extract(basename(path), SUFFIX, 1)
    return F.nullif(F.lower(found), F.lit(""))


def type_extension(document_type: ColumnOrName = "type") -> Column:
    return F.when(F.lower(strip(document_type)) == "pdf", "pdf").otherwise("html")


def source_extension(
    stored_key: ColumnOrName, document_type: ColumnOrName = "type"
) -> Column:
    """Suffix of the stored object if it has one, else by document type."""
    return F.coalesce(suffix(stored_key), type_extension(document_type))


def is_filing() -> Column:
    return F.col("source_kind") == FILINGS


def source_prefix() -> Column:
    ticker = F.upper(F.col("company_ticker"))
    return F.when(
        is_filing(),
        F.concat(F.lit(SOURCE_FILINGS), ticker, F.lit("/"), partition_date(), F.lit("/")),
    ).otherwise(
        F.concat(
            F.lit(SOURCE_ARTICLES), ticker, F.lit("/"),
            F.col("year").cast("string"), F.lit("/"),
        )
    )


def source_filename(filepath: ColumnOrName = "filepath") -> Column:
    return F.when(
        is_filing(), F.concat(document_id(), F.lit("."), type_extension())
    ).otherwise(basename(filepath))


def filing_source_key(stored_key: ColumnOrName) -> Column:
    """Canonical key of a filing's raw file, keeping the stored suffix."""
    return F.concat(
        source_prefix(), document_id(), F.lit("."), source_extension(stored_key)
    )


def stage_key(doc_id: ColumnOrName = "document_id") -> Column:
    file_name = F.concat(col(doc_id), F.lit(".parquet"))
    return F.when(
        is_filing(),
        F.concat(F.lit(STAGE_FILINGS + "date="), partition_date(), F.lit("/"), file_name),
    ).otherwise(F.concat(F.lit(STAGE_ARTICLES), file_name))


def prod_key(key: ColumnOrName) -> Column:
    """Prod key matching a stage key; null where the prefix may not be promoted."""
    key = col(key)
    known = key.startswith(STAGE_ARTICLES) | key.startswith(STAGE_FILINGS)
    return F.when(
        known, F.concat(F.lit("prod"), F.substr(key, F.lit(len("stage") + 1)))
    )


def uri_bucket(uri: ColumnOrName) -> Column:
    """Bucket of a ``gs://bucket/key`` text, null if it is not one."""
    return F.nullif(F.regexp_extract(col(uri), URI, 1), F.lit(""))


def uri_key(uri: ColumnOrName) -> Column:
    return F.nullif(F.regexp_extract(col(uri), URI, 2), F.lit(""))


def mime_type(document_type: ColumnOrName = "type") -> Column:
    return F.when(
        F.lower(col(document_type)) == "pdf", "application/pdf"
    ).otherwise("text/html")


def prod_filing_key(date_text: Column | None = None) -> Column:
    date_text = row_date() if date_text is None else date_text
    return F.concat(
        F.lit(PROD_FILINGS + "date="), date_text, F.lit("/"),
        F.col("document_id"), F.lit(".parquet"),
    )


def metadata_stage_key() -> Column:
    return F.concat(
        F.lit(STAGE_METADATA + "provider="), F.col("provider"),
        F.lit("/ticker="), F.col("company_ticker"),
        F.lit("/year="), F.col("year").cast("string"),
        F.lit("/"), F.col("metadata_id"), F.lit(".parquet"),
    )


def chunk_key(
    prefix: str, doc_id: ColumnOrName = "document_id", chunk_no: ColumnOrName = "chunk_no"
) -> Column:
    """Key of one chunk part; the number has at least five digits."""
    return F.format_string(
        prefix.strip("/").replace("%", "%%") + "/%s/part-%05d.pdf",
        col(doc_id), col(chunk_no).cast("long"),
    )
