"""Symbol listings: delimited text with a header line and possibly a footer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from fallscan.schemas import LISTING

# The starts of a listing's footer and header.
FOOTER_PREFIX = "File Creation Time"
HEADER_PREFIX = "Symbol|"

_WIDTH = len(LISTING.fields)


def read_listing(spark: SparkSession, path: str) -> DataFrame:
    """Read listing files by ``parse_listing``; every file begins with the same header line.

    Fields beyond the six named ones are ignored. Lines with fewer fields (blank
    lines) and the footer are left out. Test issues are kept, and so are empty
    fields and quotes.
    """
    lines = spark.read.text(path).withColumnRenamed("value", "line")
    return parse_listing(lines, header_prefix=HEADER_PREFIX)


def parse_listing(
    lines: DataFrame, line: str = "line", header: str | None = None,
    header_prefix: str | None = None,
) -> DataFrame:
    """Split a text column into listing fields.

    ``header`` is a line to skip, ``header_prefix`` the beginning of one.
    """
    text = F.trim(F.col(line))
    fields = F.split(text, r"\|", -1)
    if header is not None:
        lines = lines.where(text != header)
    if header_prefix is not None:
        lines = lines.where(~text.startswith(header_prefix))
    return (
        lines.where(F.size(fields) >= _WIDTH)
        .select(*[F.trim(fields[i]).alias(name) for i, name in enumerate(LISTING.fieldNames())])
        .where(~F.col("ticker").startswith(FOOTER_PREFIX))
    )
