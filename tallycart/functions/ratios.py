"""The three ways a ratio treats an empty or missing denominator."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio_or_zero(num: Column, den: Column) -> Column:
    """n/d, and 0 where d is 0 or either side is missing."""
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


def ratio_zero_as_one(num: Column, den: Column) -> Column:
    """n/d with d = 0 read as 1; a missing side stays missing."""
    safe = F.when(den == 0, F.lit(1.0)).otherwise(den.cast("double"))
    return num.cast("double") / safe


def ratio_if_positive(num: Column, den: Column) -> Column:
    """n/d where d > 0, else 0."""
    return F.when(den > 0, F.try_divide(num.cast("double"), den.cast("double"))).otherwise(
        F.lit(0.0)
    )
