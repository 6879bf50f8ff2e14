"""What several queries share: one row per record, and the reference date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demesne.common import table

#: Reference dates are literals: results must not depend on the day of the run.
REFERENCE = "2026-06-30"
_EXT = ("uid", "lid", "st", "exp", "ty", "cl", "apc", "aup", "pt", "tf")
_LEASE = ("uid", "uprn", "rpd", "apd", "pc", "cty", "rgn", "ro", "apid", "ppd", "aci", "term", "dol")


def ref() -> Column:
    return F.lit(REFERENCE).cast("date")


def first_delivery(df: DataFrame, key: str, columns: tuple[str, ...]) -> DataFrame:
    """The row of each key that was delivered first, whole; equal times are told apart by the columns in order."""
    return df.groupBy(key).agg(F.min(F.struct("loaded_at", *columns)).alias("_row")).select(key, *[f"_row.{c}" for c in columns])


def _first_sql(name: str, table_name: str, columns: tuple[str, ...]) -> str:
    order = ", ".join(f"{c} NULLS FIRST" for c in ("loaded_at", *columns))
    return f"{name} AS (SELECT DISTINCT ON (_id) _id, {', '.join(columns)} FROM {table_name} ORDER BY _id, {order})"


def ext(spark: SparkSession, d: str) -> DataFrame:
    """One row per enriched record."""
    return first_delivery(table(spark, d, "leasesext"), "_id", _EXT).withColumn("cl", F.trim("cl"))


def leases(spark: SparkSession, d: str) -> DataFrame:
    """One row per lease."""
    return first_delivery(table(spark, d, "leases"), "_id", _LEASE)


EXT_CTE = _first_sql("ext0", "leasesext", _EXT) + ", ext AS (SELECT * REPLACE (trim(cl) AS cl) FROM ext0)"
LEASES_CTE = _first_sql("lease", "leases", _LEASE)
