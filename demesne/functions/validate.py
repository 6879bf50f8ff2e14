"""Validation of parsed lease terms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Codes that make a term invalid; all others are warnings.
ERRORS = ("NULL_DATA", "INVALID_TYPE", "INVALID_DATE_ORDER", "INVALID_TENURE")


def findings(start: Column, expiry: Column, tenure: Column, reference: Column, tolerance_days: int = 10) -> Column:
    """array<struct<code, severity>>; a missing part ends the checks."""
    nothing = start.isNull() & expiry.isNull() & tenure.isNull()
    partial = start.isNull() | expiry.isNull() | tenure.isNull()
    # a million years is beyond any expiry and still a date; larger tenures would overflow
    years = F.floor(F.greatest(F.least(tenure, F.lit(1e6)), F.lit(-1e6))).cast("int")
    off = F.abs(F.datediff(F.add_months(start, years * 12), expiry))
    checks = [
        ("INVALID_DATE_ORDER", start >= expiry),
        ("INVALID_TENURE", tenure <= 0),
        ("TENURE_MISMATCH", off > tolerance_days),
        ("FUTURE_START_DATE", start > reference),
        ("UNREASONABLE_START_DATE", start < F.lit("1800-01-01").cast("date")),
        ("EXCESSIVE_TENURE", tenure > 1000),
        ("LEASE_EXPIRED", expiry < reference),
    ]

    def one(code: str) -> Column:
        return F.struct(F.lit(code).alias("code"), F.lit("error" if code in ERRORS else "warning").alias("severity"))

    all_ = F.filter(F.array(*[F.when(test, one(code)) for code, test in checks]), lambda x: x.isNotNull())
    return F.when(nothing, F.array(one("NULL_DATA"))).when(partial, F.array(one("INVALID_TYPE"))).otherwise(all_)


def is_valid(found: Column) -> Column:
    return ~F.exists(found, lambda x: x["severity"] == "error")
