"""Plain settings object; every operator takes the values it needs as arguments."""

from __future__ import annotations

from dataclasses import dataclass

# --- fixed values: limits, names and prefixes of the stored layout ---
DIRECT_PDF_MAX_BYTES = 52_428_800
CHUNK_TARGET_BYTES = 45_000_000
CHUNK_PREFIX = "stage/knowledge/gemini_chunks"
DOCUMENTS_TABLE = "documents"
FILINGS_TABLE = "edgar"
METADATA_TABLE = "company_metadata"
ARTICLES = "articles"
FILINGS = "edgar"
METADATA = "metadata"
DEFAULT_SOURCES = (ARTICLES, FILINGS)
METADATA_PROVIDERS = ("lseg",)
BACKFILL_FIRST_YEAR = 2021
BACKFILL_LAST_YEAR = 2026


@dataclass(frozen=True)
class Settings:
    """Knobs of a run. ``chunk_bucket`` falls back to ``prod_bucket``."""

    source_bucket: str = "b"
    prod_bucket: str = "b"
    chunk_bucket: str | None = None
    chunk_prefix: str = CHUNK_PREFIX
    direct_max_bytes: int = DIRECT_PDF_MAX_BYTES
    chunk_target_bytes: int = CHUNK_TARGET_BYTES

    @property
    def chunk_root(self) -> str:
        bucket = self.chunk_bucket or self.prod_bucket
        return f"gs://{bucket}/{self.chunk_prefix.strip('/')}"
