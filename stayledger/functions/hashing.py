"""Deterministic identities."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: separator between hashed parts.
SEPARATOR = "||"


def fingerprint(parts: list[Column]) -> Column:
    """SHA-256 (hex) over the parts. NULL parts are skipped."""
    return F.sha2(F.concat_ws(SEPARATOR, *parts), 256)


def record_hash(columns: list[str]) -> Column:
    """Identity of a business state: raw text, blind to case and outer spaces.

    An absent value counts as empty text so that every column keeps its place.
    """
    return fingerprint([F.lower(F.trim(F.coalesce(F.col(c).cast("string"), F.lit("")))) for c in columns])


def content_number(columns: list[str]) -> Column:
    """A row's raw text as a whole number of 64 bits, to be added up over rows in any order.

    Case and spaces count, unlike in ``record_hash``; NULL equals empty text, as in a CSV file.
    Each value's length stands before it, so that moved text is another row.
    """
    texts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    framed = F.concat_ws("|", *[part for t in texts for part in (F.length(t).cast("string"), t)])
    return F.conv(F.substring(F.md5(framed), 1, 16), 16, 10).cast("decimal(20,0)")


def row_ingestion_id(object_path: str = "source_object_path") -> Column:
    """Identity of a delivered row; equal when the same file is loaded again."""
    parts = [object_path, "booking_key", "batch_id", "batch_row_number"]
    return fingerprint([F.col(p).cast("string") for p in parts])
