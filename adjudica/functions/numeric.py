"""Numeric expressions with pandas-like null behaviour under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, NumericType

def finite_or_null(c: Column) -> Column:
    """NaN becomes NULL, so that one missing marker exists downstream."""
    return F.nanvl(c, F.lit(None).cast("double"))


def to_number(c: Column, dtype: DataType | None = None) -> Column:
    """Coerce to double; whatever does not parse becomes NULL.

    Pass the source type when it is known: numeric columns then skip the string
    checks and stay a plain cast.
    """
    if isinstance(dtype, (NumericType, BooleanType)):
        return finite_or_null(c.cast("double"))
    text = c.cast("string")
    # Java's double parser accepts "1d" and "2.5f"; those are not numbers here
    suffixed = F.lower(F.right(F.rtrim(text), F.lit(1))).isin("d", "f")
    infinite = F.lower(F.trim(text)).isin("inf", "+inf", "-inf")
    return finite_or_null(F.when(~suffixed | infinite, text.try_cast("double")))


def clip(c: Column, lower: float | None = None, upper: float | None = None) -> Column:
    """Clip to [lower, upper] and keep NULL (``greatest`` would replace it)."""
    out = c
    if lower is not None and upper is not None:
        return F.when(c < lower, F.lit(lower)).when(c > upper, F.lit(upper)).otherwise(c)
    if lower is not None:
        out = F.when(c < lower, F.lit(lower)).otherwise(c)
    if upper is not None:
        out = F.when(c > upper, F.lit(upper)).otherwise(c)
    return out


def clamp_min(c: Column, lower: float) -> Column:
    return clip(c, lower=lower)


def safe_ratio(num: Column, den: Column, default: float = 0.0) -> Column:
    """num / den, or ``default`` where the denominator is zero."""
    return F.when(den == 0, F.lit(default)).otherwise(num / den)
