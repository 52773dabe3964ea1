"""Text cleaning expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def unmasked(value: Column, sentinel: str = "?") -> Column:
    """Null where the text is exactly the sentinel; padding makes it differ."""
    return F.nullif(value, F.lit(sentinel))


def normalized(value: Column) -> Column:
    """Lower case without leading and trailing spaces (tabs stay)."""
    return F.lower(F.trim(value))
