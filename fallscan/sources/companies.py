"""The company dimension and selections from it."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from fallscan.schemas import COMPANIES

# Fixed value: stands for an attribute a company does not report.
MISSING = "N/A"


def company_info(companies: DataFrame) -> DataFrame:
    """Name, sector and industry per ticker, missing attributes replaced."""
    attributes = COMPANIES.fieldNames()[1:]
    return companies.select(
        "ticker", *[F.coalesce(F.col(a), F.lit(MISSING)).alias(a) for a in attributes]
    )


def of_sector(companies: DataFrame, sector: str) -> DataFrame:
    """Companies of one sector; an unknown sector never matches."""
    return company_info(companies.where(F.col("sector") == F.lit(sector)))
