"""Expressions over one discovery item, a STRUCT of VARIANT fields.

VARIANT keeps what a typed reader would lose: whether a field is absent or an
explicit null, and whether a value was a text or a number.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from docflow.functions.text import ColumnOrName, bind, col, strip
from docflow.schemas import ITEM

# Schemes whose last path segment may carry ``;parameters`` (fixed values of
# the URL standard library; a URL without a scheme counts too).
PARAMETER_SCHEMES = (
    "", "ftp", "hdl", "prospero", "http", "https", "shttp", "rtsp", "rtsps",
    "rtspu", "sip", "sips", "mms", "sftp", "tel",
)
URL_SCHEME = r"^([A-Za-z][A-Za-z0-9+.-]*):"
URL_PATH = r"(?s)^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)"


def item_fields(variant: Column) -> Column:
    """The fields read from an item, taken in one pass; null if it is no object."""
    return F.try_variant_get(variant, "$", f"struct<{ITEM}>")


def field(item: ColumnOrName, name: str) -> Column:
    return col(item)[name]


def field_type(item: ColumnOrName, name: str) -> Column:
    """SQL type name of a field: null if absent, ``VOID`` for an explicit null."""
    return F.schema_of_variant(field(item, name))


def field_text(item: ColumnOrName, name: str) -> Column:
    return F.try_variant_get(field(item, name), "$", "string")


def truthy_text(item: ColumnOrName, name: str) -> Column:
    """Text of a field, null where the value is empty, zero, false or missing."""
    text = field_text(item, name)
    zero = F.coalesce(text.try_cast("double") == 0, F.lit(False))
    blank = zero | text.isin("false", "[]", "{}")
    is_text = field_type(item, name) == "STRING"
    return F.when(is_text, F.nullif(text, F.lit(""))).when(~blank, text)


def url_path(url: ColumnOrName) -> Column:
    """Path of a URL without query, fragment or last-segment parameters."""
    url = col(url)
    path = F.regexp_extract(url, URL_PATH, 1)
    scheme = F.lower(F.regexp_extract(url, URL_SCHEME, 1))
    return F.when(
        scheme.isin(*PARAMETER_SCHEMES), F.regexp_replace(path, r";[^/]*$", "")
    ).otherwise(path)


def document_type(item: ColumnOrName = "item") -> Column:
    """``pdf`` or ``html``: stated type first, then flag, URL and file path."""
    stated = F.lower(
        F.coalesce(
            truthy_text(item, "type"), truthy_text(item, "article_type"), F.lit("")
        )
    )
    flagged = F.when(
        field_type(item, "is_pdf") == "BOOLEAN", field_text(item, "is_pdf") == "true"
    )

    def ends_pdf(path: Column) -> Column:
        return F.coalesce(F.lower(path).endswith(".pdf"), F.lit(False))

    looks_pdf = (
        F.coalesce(flagged, F.lit(False))
        | ends_pdf(url_path(field_text(item, "url")))
        | ends_pdf(field_text(item, "filepath"))
    )
    return bind(
        stated,
        lambda said: F.when(said.isin("pdf", "html"), said)
        .when(looks_pdf, "pdf")
        .otherwise("html"),
    )


def given_filepath(item: ColumnOrName = "item") -> Column:
    """The relative path an item states; null if it states none."""
    return bind(
        strip(truthy_text(item, "filepath")),
        lambda path: F.when((path != "") & ~path.contains("://"), path),
    )


def hashed_filepath(
    url: ColumnOrName = "url",
    company_id: ColumnOrName = "company_id",
    year: ColumnOrName = "year",
    doc_type: ColumnOrName = "type",
) -> Column:
    """A path made of the URL's hash."""
    return F.concat(
        F.lit("data/"), col(company_id), F.lit("/"), col(year).cast("string"),
        F.lit("/"), F.md5(col(url)), F.lit("."), col(doc_type),
    )


def document_filepath(
    item: ColumnOrName = "item",
    company_id: ColumnOrName = "company_id",
    year: ColumnOrName = "year",
    doc_type: ColumnOrName | None = None,
) -> Column:
    """Given relative path, else a path made of the URL's hash."""
    doc_type = document_type(item) if doc_type is None else col(doc_type)
    hashed = hashed_filepath(field_text(item, "url"), company_id, year, doc_type)
    return F.coalesce(given_filepath(item), hashed)
