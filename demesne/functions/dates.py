"""Remaining terms and expiry dates in mixed notations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def years_remaining(expiry: Column, reference: Column) -> Column:
    return F.datediff(expiry, reference) / F.lit(365.25)


def term_category(years: Column) -> Column:
    """Bands of the remaining term (fixed values)."""
    return F.when(years < 70, "<70").when(years < 80, "70-80").when(years < 90, "80-90").when(years < 100, "90-100").when(years.isNotNull(), "100+")


def is_approaching(years: Column) -> Column:
    return (years >= 70) & (years < 90)


def any_expiry(text: Column, earliest: int = 1900) -> Column:
    """A date in one of six notations, or a bare year (to its first day); else NULL."""
    t = F.trim(text)
    forms = ["yyyy-MM-dd", "dd/MM/yyyy", "dd-MM-yyyy", "yyyy/MM/dd"]
    tries = [F.when(F.length(t) == 10, F.try_to_date(t, f)) for f in forms] + [F.when(t.rlike(r"^\d{4}-\d\d-\d\d[T ]"), F.try_to_date(F.substring(t, 1, 10), "yyyy-MM-dd"))]
    year = F.when(t.rlike(r"^\d{4}$"), t.try_cast("int"))
    return F.coalesce(*tries, F.when(year.between(earliest, 3000), F.make_date(year, F.lit(1), F.lit(1))))
