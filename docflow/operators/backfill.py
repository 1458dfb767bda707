"""Companies of a holdings backfill."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from docflow.functions.text import default_company_id, search_base_url, strip


def valid_holdings(holdings: DataFrame) -> DataFrame:
    """Lines with a usable ticker: not null, not empty, not the cash dash."""
    return holdings.where(~F.col("ticker").isin("", "-"))


def first_company_per_ticker(
    holdings: DataFrame, order: tuple[str, ...] = ("file_no", "line_no")
) -> DataFrame:
    """First line of each normalised ticker in file and line order; a missing name is empty.

    ``row_number() = 1`` is cut to one row per ticker and partition before the
    exchange, so a ticker held by every fund costs no more than any other.
    """
    window = Window.partitionBy("ticker").orderBy(*order)
    return (
        holdings.withColumn("ticker", F.upper(strip("ticker")))
        .withColumn("_rank", F.row_number().over(window))
        .where(F.col("_rank") == 1)
        .select("ticker", F.coalesce("name", F.lit("")).alias("name"))
    )


def holdings_to_companies(firsts: DataFrame) -> DataFrame:
    """Normalised companies with a search page as base URL."""
    ticker = F.col("ticker")
    return firsts.select(
        ticker.alias("company_ticker"),
        strip("name").alias("company_name"),
        default_company_id(F.lit(None).cast("string"), ticker).alias("company_id"),
        strip(search_base_url("name")).alias("base_url"),
    )
