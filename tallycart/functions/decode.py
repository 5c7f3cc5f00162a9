"""Code-to-name look-ups and date parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Codes used in the input files and the names they stand for.
ACTION_NAMES = {0: "click", 1: "add-to-cart", 2: "purchase", 3: "add-to-favorite"}
GENDER_NAMES = {0: "female", 1: "male", 2: "unknown"}
AGE_NAMES = {
    1: "first group",
    2: "second group",
    3: "third group",
    4: "fourth group",
    5: "fifth group",
    6: "sixth group",
    7: "seventh group",
    8: "eighth group",
}
UNKNOWN = "unknown"
LOG_YEAR = 2016
PROMO_MONTH, PROMO_DAY = 11, 11


def lookup(code: Column, names: dict[int, str]) -> Column:
    """Name of a code; null for a code that is not listed."""
    first, *rest = names.items()
    out = F.when(code == first[0], first[1])
    for key, name in rest:
        out = out.when(code == key, name)
    return out


def action_name(code: Column) -> Column:
    return lookup(code, ACTION_NAMES)


def gender_name(code: Column) -> Column:
    return F.coalesce(lookup(code, GENDER_NAMES), F.lit(UNKNOWN))


def age_name(code: Column) -> Column:
    return F.coalesce(lookup(code, AGE_NAMES), F.lit(UNKNOWN))


# Month, then day, each of one or two digits; the longer month is tried first.
MONTH_DAY = r"^(1[0-2]|0[1-9]|[1-9])(3[01]|[12][0-9]|0[1-9]|[1-9])$"


def parse_day(mmdd: Column, year: int = LOG_YEAR, lenient: bool = False) -> Column:
    """Month and day text of one year as a date; a bad day raises unless lenient.

    ``0829`` and ``829`` are the same day; ``111`` is 1 November, as a month of two
    digits goes first where the rest is a day.
    """
    parts = [F.lpad(F.regexp_extract(mmdd, MONTH_DAY, i), 2, "0") for i in (1, 2)]
    padded = F.when(mmdd.rlike(MONTH_DAY), F.concat(*parts)).otherwise(mmdd)
    text = F.concat(F.lit(str(year)), padded)
    if lenient:
        return F.try_to_date(text, "yyyyMMdd")
    return F.to_date(text, "yyyyMMdd")


def is_promo_day(day: Column, month: int = PROMO_MONTH, dom: int = PROMO_DAY) -> Column:
    return (F.month(day) == month) & (F.dayofmonth(day) == dom)
