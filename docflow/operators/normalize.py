"""Companies, requests and discovery items turned into normalised documents."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from docflow.config import ARTICLES, DEFAULT_SOURCES, FILINGS, METADATA
from docflow.functions.items import (
    document_type,
    field,
    field_text,
    field_type,
    given_filepath,
    hashed_filepath,
    truthy_text,
)
from docflow.functions.text import bind, blank_to_null, cik10, default_company_id, strip
from docflow.operators.split import Split, split_by
from docflow.schemas import FILING_FIELDS

SUPPORTED_SOURCES = (*DEFAULT_SOURCES, METADATA)


def normalize_company(companies: DataFrame) -> DataFrame:
    """Strip the texts, upper-case the ticker and fill a missing id."""
    ticker = F.upper(strip("company_ticker"))
    return companies.withColumns(
        {
            "company_ticker": ticker,
            "company_name": strip("company_name"),
            "company_id": default_company_id("company_id", ticker),
            "base_url": strip("base_url"),
        }
    )


def requested_sources(source: str | None) -> tuple[str, ...]:
    """Source families one request asks for; an unknown name is an error."""
    if source is None:
        return DEFAULT_SOURCES
    name = source.strip().lower()
    if name not in SUPPORTED_SOURCES:
        raise ValueError(f"unsupported source: {source!r}")
    return (name,)


def expand_sources(requests: DataFrame, source: str = "source") -> Split:
    """One row per requested family in ``source_kind``; unknown names rejected."""
    asked = F.lower(strip(source))
    known = split_by(requests, F.col(source).isNull() | asked.isin(*SUPPORTED_SOURCES))
    families = F.when(
        F.col(source).isNull(), F.array(*[F.lit(s) for s in DEFAULT_SOURCES])
    ).otherwise(F.array(asked))
    return Split(
        known.valid.withColumn("source_kind", F.explode(families)), known.rejected
    )


def one_company_per_ticker(companies: DataFrame) -> DataFrame:
    """One row per ticker of normalised companies: the first by name, id and URL."""
    order = [c for c in ("company_name", "company_id", "base_url") if c in companies.columns]
    window = Window.partitionBy("company_ticker").orderBy(*order)
    ranked = companies.withColumn("_rank", F.row_number().over(window))
    return ranked.where(F.col("_rank") == 1).drop("_rank")


def attach_company(
    items: DataFrame, companies: DataFrame, on: tuple[str, ...] = ("company_ticker",)
) -> DataFrame:
    """Copy the company's context onto its items, by normalised ticker (and year).

    ``companies`` holds one row per normalised ticker (and year). They grow with the input,
    and their size is guessed from files that are smaller than the rows made of them, so they
    are merged and never gathered on the driver; AQE splits skewed tickers on the item side.
    """
    ticker = F.upper(strip("company_ticker"))
    context = companies.select(*on, "company_name", "company_id", "base_url")
    slim = items.drop("company_name", "company_id", "base_url")
    return slim.withColumn("company_ticker", ticker).join(context.hint("merge"), list(on))


def company_years(companies: DataFrame, first: int, last: int) -> DataFrame:
    """Every company crossed with every year of the closed range."""
    return companies.withColumn(
        "year", F.explode(F.sequence(F.lit(first), F.lit(last)))
    )


def _reject_reason(filing: bool) -> Column:
    """Name of the first field whose JSON type makes the item unusable."""

    def must_be_text(name: str) -> Column:
        return F.coalesce(field_type("item", name) != "STRING", F.lit(True))

    def may_be_null(name: str) -> Column:
        kind = field_type("item", name)
        return F.coalesce(~kind.isin("STRING", "VOID"), F.lit(False))

    faults = {name: must_be_text(name) for name in ("title", "url")}
    faults["date"] = may_be_null("date")
    if filing:
        stated = truthy_text("item", "filing_type").isNotNull()
        faults["filing_type"] = F.when(stated, must_be_text("filing_type")).otherwise(
            may_be_null("form")
        )
        faults |= {name: may_be_null(name) for name in FILING_FIELDS[1:]}
    return F.coalesce(*[F.when(bad, F.lit(name)) for name, bad in faults.items()])


def mark_invalid(items: DataFrame, filing: bool | None = False) -> DataFrame:
    """Add ``reject_reason``: the first field of the wrong type, null if fine.

    ``filing`` None: items of both families, told apart by ``source_kind``.
    """
    if filing is None:
        both = F.when(F.col("source_kind") == FILINGS, _reject_reason(True))
        return items.withColumn("reject_reason", both.otherwise(_reject_reason(False)))
    return items.withColumn("reject_reason", _reject_reason(filing))


def split_invalid(items: DataFrame, filing: bool = False) -> Split:
    """Usable items, and those one bad field sets aside; rows of :func:`take_fields` are marked."""
    marked = items if "reject_reason" in items.columns else mark_invalid(items, filing)
    valid = marked.where(F.col("reject_reason").isNull()).drop("reject_reason")
    return Split(valid, marked.where(F.col("reject_reason").isNotNull()))


def _date_text() -> Column:
    """Text of a stated date; null for an explicit null."""
    return F.when(field_type("item", "date") != "VOID", field_text("item", "date"))


def _with_fields(items: DataFrame, extra: dict[str, Column]) -> DataFrame:
    """Items with plain columns in place of ``item``: all that documents take from it."""
    taken = {
        "title": field_text("item", "title"),
        "url": field_text("item", "url"),
        "type": document_type("item"),
        "_date": _date_text(),
        "_undated": field("item", "date").isNull(),
        "_given": given_filepath("item"),
        **extra,
    }
    rest = [c for c in items.columns if c != "item" and c not in taken]
    return items.select(*rest, *[value.alias(name) for name, value in taken.items()])


def take_fields(items: DataFrame, filing: bool = False) -> DataFrame:
    """Items of one family with ``reject_reason`` and the texts that documents take from them.

    Each VARIANT field repeats the names of its whole item. What is joined or shuffled later
    has only the texts, and an item is looked into once.
    """
    return _with_fields(mark_invalid(items, filing), _filing_fields() if filing else {})


def _to_documents(items: DataFrame, source_kind: Column, extra: dict[str, Column]) -> DataFrame:
    none = F.lit(None).cast("string")
    carried = [c for c in ("pos", "reject_reason") if c in items.columns]
    taken = _with_fields(items, extra) if "item" in items.columns else items
    # Absent: the year as text. Explicit null: null. Else the text itself.
    date = F.when(F.col("_undated"), F.col("year").cast("string")).otherwise(F.col("_date"))
    return normalize_document(
        taken.select(
            *carried,
            "title",
            "company_name",
            "company_id",
            "company_ticker",
            "base_url",
            F.col("year").cast("int").alias("year"),
            date.alias("date"),
            "url",
            "type",
            F.coalesce("_given", hashed_filepath()).alias("filepath"),
            F.lit(False).alias("downloaded"),
            none.alias("gcs_uri"),
            source_kind.alias("source_kind"),
            *[F.col(name) if name in taken.columns else none.alias(name) for name in FILING_FIELDS],
        )
    )


def articles_to_documents(items: DataFrame) -> DataFrame:
    """Valid article items (``item`` or its fields + company context) as documents."""
    return _to_documents(items, F.lit(ARTICLES), {})


def filings_to_documents(items: DataFrame) -> DataFrame:
    """Valid filing items as documents; ``form`` stands in for the filing type."""
    items = items.withColumn(
        "company_id", default_company_id("company_id", "company_ticker")
    )
    return _to_documents(items, F.lit(FILINGS), _filing_fields())


def _filing_fields() -> dict[str, Column]:
    fields = {name: field_text("item", name) for name in FILING_FIELDS}
    fields["filing_type"] = F.coalesce(
        truthy_text("item", "filing_type"), field_text("item", "form")
    )
    return fields


def items_to_documents(items: DataFrame) -> DataFrame:
    """Items of both families, told apart by ``source_kind``, as documents in one pass.

    ``reject_reason`` is kept where items have it: fields of a rejected item mean nothing.
    """
    filing = F.col("source_kind") == FILINGS
    own_id = F.when(filing, default_company_id("company_id", "company_ticker"))
    items = items.withColumn("company_id", own_id.otherwise(F.col("company_id")))
    fields = {name: F.when(filing, value) for name, value in _filing_fields().items()}
    return _to_documents(items, F.col("source_kind"), fields)


def normalize_document(docs: DataFrame) -> DataFrame:
    """Strip and case-fold the key fields; blank optional fields become null."""
    optional = {name: blank_to_null(name) for name in FILING_FIELDS}
    optional["filing_type"] = F.upper(optional["filing_type"])
    optional["cik"] = bind(optional["cik"], cik10)
    kind = F.coalesce(F.nullif(F.col("source_kind"), F.lit("")), F.lit(ARTICLES))
    return docs.withColumns(
        {
            "company_ticker": F.upper(strip("company_ticker")),
            "company_id": strip("company_id"),
            "type": F.lower(strip("type")),
            "source_kind": F.lower(strip(kind)),
            **optional,
        }
    )


def union_sources(frames: list[DataFrame]) -> DataFrame:
    """Bag union of the families that answered; missing columns become null."""
    return reduce(
        lambda left, right: left.unionByName(right, allowMissingColumns=True), frames
    )
