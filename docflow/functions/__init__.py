"""Column expressions. All arguments are column names or Columns."""

from docflow.functions.dates import partition_date, row_date
from docflow.functions.errors import (
    error_outcome,
    is_file_size_error,
    is_invalid_argument,
    is_transient,
)
from docflow.functions.features import features_json, standard_features
from docflow.functions.identity import document_id, ingestion_key, metadata_id
from docflow.functions.items import document_filepath, document_type
from docflow.functions.jsons import json_list_or_empty, sorted_json
from docflow.functions.layout import (
    basename,
    chunk_key,
    filing_source_key,
    metadata_stage_key,
    mime_type,
    prod_filing_key,
    prod_key,
    source_extension,
    source_filename,
    source_prefix,
    stage_key,
    uri_bucket,
    uri_key,
)
from docflow.functions.text import (
    blank_to_null,
    cik10,
    default_company_id,
    search_base_url,
    strip,
)

__all__ = [
    "basename", "blank_to_null", "chunk_key", "cik10", "default_company_id",
    "document_filepath", "document_id", "document_type", "error_outcome",
    "features_json", "filing_source_key", "ingestion_key", "is_file_size_error",
    "is_invalid_argument", "is_transient", "json_list_or_empty", "metadata_id",
    "metadata_stage_key", "mime_type", "partition_date", "prod_filing_key",
    "prod_key", "row_date", "search_base_url", "sorted_json", "source_extension",
    "source_filename", "source_prefix", "stage_key", "standard_features", "strip",
    "uri_bucket", "uri_key",
]
