"""Prompt text, token estimate, annotation ids and clock text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# One piece per five letters, three digits or other visible character.
TOKEN_PIECE = r"\p{L}{1,5}|\p{N}{1,3}|[^\s\p{L}\p{N}]"


def prompt_text(url: Column, block_text: Column) -> Column:
    return F.concat(url, F.lit("\n\n"), block_text)


def token_estimate(text: Column) -> Column:
    """Estimated tokens of a text by counting pieces; NULL counts as 0."""
    return F.coalesce(F.regexp_count(text, F.lit(TOKEN_PIECE)), F.lit(0)).cast("bigint")


def annotation_id(url: Column, text: Column, xpath: Column) -> Column:
    return F.concat(F.lit("urn:sha256:"), F.sha2(F.concat(url, text, xpath), 256))


def utc_text(timestamp: Column) -> Column:
    """ISO text with microseconds and a ``Z``; expects the session zone UTC."""
    return F.date_format(timestamp, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
