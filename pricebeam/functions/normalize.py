"""Sign normalization."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def normalize(value: Column | str) -> Column:
    """Value over its magnitude; 0.0 for null and for zero, NaN where the quotient is undefined."""
    number = (F.col(value) if isinstance(value, str) else value).cast("double")
    return F.coalesce(F.try_divide(number, F.abs(number)), F.lit(0.0))
