"""String expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def cut_at_marker(c: Column, name: str) -> Column:
    """Keep what follows the first ``/<name>/``; values without it stay unchanged."""
    marker = f"/{name}/"
    at = F.locate(marker, c)
    return F.when(at > 0, F.substr(c, at + F.lit(len(marker)))).otherwise(c)


def percent(c: Column, digits: int = 1) -> Column:
    """0.1234 -> '12.3%'."""
    return F.format_string(f"%.{digits}f%%", c * 100)
