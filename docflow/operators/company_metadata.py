"""Company metadata responses turned into stored rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from docflow.config import METADATA_PROVIDERS
from docflow.functions.identity import metadata_id
from docflow.functions.jsons import sorted_json
from docflow.functions.text import strip
from docflow.operators.split import Split, split_by

# --- fixed values: keys a response must have ---
REQUIRED_KEYS = (
    "company_ticker",
    "company_name",
    "company_id",
    "base_url",
    "matched_on",
    "source_snapshot_uri",
)


def field_type(response: str, name: str) -> Column:
    return F.schema_of_variant(F.variant_get(response, f"$.{name}", "variant"))


def field_text(response: str, name: str) -> Column:
    return F.try_variant_get(F.col(response), f"$.{name}", "string")


def normalize_provider(provider: str) -> str:
    """The provider's canonical name; an unknown one is an error."""
    name = provider.strip().lower()
    if name not in METADATA_PROVIDERS:
        raise ValueError(f"unsupported metadata provider: {provider!r}")
    return name


def require_provider(requests: DataFrame, provider: str = "provider") -> Split:
    """Requests naming a supported provider, its name canonical; others rejected."""
    name = F.lower(strip(provider))
    valid, rejected = split_by(requests, name.isin(*METADATA_PROVIDERS))
    return Split(valid.withColumn(provider, name), rejected)


def valid_metadata_response(responses: DataFrame) -> Split:
    """Responses (VARIANT ``response``) that are objects with every required key.

    The free-form parts must be objects, and the snapshot date a text, where
    they are given and not empty.
    """
    present = [field_type("response", key).isNotNull() for key in REQUIRED_KEYS]
    snapshot = F.coalesce(
        field_type("response", "source_snapshot_date").isin("STRING", "VOID"), F.lit(True)
    )
    passes = snapshot & _object_or_empty("metadata") & _object_or_empty("source_record")
    for check in present:
        passes &= check
    return split_by(responses, passes)


def _object_or_empty(name: str) -> Column:
    kind = field_type("response", name)
    text = field_text("response", name)
    empty = kind.isNull() | text.isNull() | text.isin("", "0", "false", "[]", "{}")
    return empty | kind.startswith("OBJECT")


def _free_form(name: str) -> Column:
    kind = field_type("response", name)
    text = F.get_json_object("body", f"$.{name}")
    return F.when(kind.startswith("OBJECT"), text).otherwise("{}")


def metadata_artifacts(responses: DataFrame) -> DataFrame:
    """Stored rows from valid responses.

    Input has the *requested* company (``company_ticker``, ``company_id``,
    ``base_url``, ``year``, ``provider``), the ``response`` and its text ``body``.
    The id is made of the request, the descriptive fields come from the response.
    """
    answered = {
        name: strip(field_text("response", name)) for name in REQUIRED_KEYS
    }
    answered["company_ticker"] = F.upper(answered["company_ticker"])
    return responses.select(
        metadata_id().alias("metadata_id"),
        *[answered[n].alias(n) for n in ("company_ticker", "company_name", "company_id", "base_url")],
        F.col("year").cast("long").alias("year"),
        "provider",
        answered["matched_on"].alias("matched_on"),
        answered["source_snapshot_uri"].alias("source_snapshot_uri"),
        field_text("response", "source_snapshot_date").alias("source_snapshot_date"),
        _free_form("metadata").alias("metadata_json"),
        _free_form("source_record").alias("source_record_json"),
    )


def stage_rows(artifacts: DataFrame, run_ts: Column | None = None) -> DataFrame:
    """Artifacts with the stored JSON text form and the run time as ISO text."""
    run_ts = F.current_timestamp() if run_ts is None else run_ts
    iso = F.date_format(run_ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    return artifacts.withColumns(
        {
            "metadata_json": sorted_json("metadata_json"),
            "source_record_json": sorted_json("source_record_json"),
            "ingestion_timestamp": F.regexp_replace(iso, "Z$", "+00:00"),
        }
    )


def latest_key(keys: DataFrame, key: str = "key") -> DataFrame:
    """Lexicographically greatest key."""
    return keys.agg(F.max(key).alias(key))
