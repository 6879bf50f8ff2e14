"""Analytical aggregates over enriched leases."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def share(part: Column, whole: Column) -> Column:
    """Per cent, 0 where there is nothing."""
    return F.coalesce(F.try_divide(part * F.lit(100.0), whole), F.lit(0.0))


def missing_fields(df: DataFrame, fields: list[str]) -> DataFrame:
    """field, total, n_null, n_blank, missing_percent; one pass over the data."""
    flags = [F.struct(F.lit(f).alias("field"), F.col(f).isNull().alias("is_null"), F.coalesce(F.trim(F.col(f).cast("string")) == "", F.lit(False)).alias("is_blank")) for f in fields]
    g = df.select(F.inline(F.array(*flags))).groupBy("field").agg(F.count("*").alias("total"), F.count_if("is_null").alias("n_null"), F.count_if("is_blank").alias("n_blank"))
    return g.withColumn("missing_percent", F.round(share(F.col("n_null") + F.col("n_blank"), F.col("total")), 6))


def average_rank(df: DataFrame, value: str, out: str, by: list[str] | None = None) -> DataFrame:
    """Ranks from 1, ties sharing their average.

    Counts per distinct value are ranked, not rows: the single-partition window sees distinct values only,
    and the ranks are joined back.
    """
    by = by or []
    counts = df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("_n"))
    w = Window.partitionBy(*by).orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    ranks = counts.withColumn(out, F.coalesce(F.sum("_n").over(w), F.lit(0)) + (F.col("_n") + 1) / 2).select(*by, value, out)
    return df.join(ranks, [*by, value])


def spearman(df: DataFrame, a: str, b: str) -> DataFrame:
    both = df.filter(F.col(a).isNotNull() & F.col(b).isNotNull()).select(a, b)
    return average_rank(average_rank(both, a, "_ra"), b, "_rb").agg(F.corr("_ra", "_rb").alias("rho"), F.count("*").alias("n"))


def two_sample_t(df: DataFrame, value: str, group: Column) -> DataFrame:
    """Equal-variance t, degrees of freedom and two-sided p-value of value where group holds against where it does not."""
    m = df.filter(F.col(value).isNotNull() & group.isNotNull()).agg(
        *[f(F.when(g, F.col(value))).alias(f"{n}{k}") for k, g in ((1, group), (2, ~group)) for n, f in (("n", F.count), ("m", F.avg), ("v", F.var_samp))]
    )
    pooled = ((F.col("n1") - 1) * F.col("v1") + (F.col("n2") - 1) * F.col("v2")) / (F.col("n1") + F.col("n2") - 2)
    return m.select("n1", "n2", ((F.col("m1") - F.col("m2")) / F.sqrt(pooled * (1 / F.col("n1") + 1 / F.col("n2")))).alias("t"), (F.col("n1") + F.col("n2") - 2).alias("df")).withColumn("p", F.pandas_udf(two_sided_t, "double")("t", "df"))


def mann_whitney(df: DataFrame, value: str, group: Column) -> DataFrame:
    """U of the first group, z by the tie-corrected normal approximation, and its two-sided p-value."""
    d = df.filter(F.col(value).isNotNull() & group.isNotNull()).select(value, group.alias("_g"))
    ranked = average_rank(d, value, "_r")
    ties = d.groupBy(value).count().agg(F.sum(F.col("count") ** 3 - F.col("count")).alias("ties"))
    s = ranked.agg(F.count_if("_g").alias("n1"), F.count_if(~F.col("_g")).alias("n2"), F.sum(F.when(F.col("_g"), F.col("_r"))).alias("r1")).crossJoin(F.broadcast(ties))  # one row each
    u, n = F.col("r1") - F.col("n1") * (F.col("n1") + 1) / 2, F.col("n1") + F.col("n2")
    sd = F.sqrt(F.col("n1") * F.col("n2") / 12.0 * ((n + 1) - F.col("ties") / (n * (n - 1))))
    return s.select("n1", "n2", u.alias("u"), ((u - F.col("n1") * F.col("n2") / 2.0) / sd).alias("z")).withColumn("p", F.pandas_udf(two_sided_normal, "double")("z"))


def two_sided_normal(z: pd.Series) -> pd.Series:
    """The chance of a standard normal at least as far from 0; for one row per test."""
    return z.astype("float64").map(lambda x: math.erfc(abs(x) / math.sqrt(2)), na_action="ignore")


def student_tail(t: float, df: float) -> float:
    """The chance of a t value at least as far from 0: the incomplete beta function by its continued fraction."""
    x = df / (df + t * t)
    a, b = df / 2, 0.5
    if x >= 1:
        return 1.0
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log(1 - x))

    def fraction(a: float, b: float, x: float) -> float:
        c, d = 1.0, 1 / (1 - (a + b) * x / (a + 1))
        h = d
        for m in range(1, 300):
            for k in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
                d, c = 1 / (1 + k * d), 1 + k / c
                h *= c * d
            if abs(c * d - 1) < 1e-15:
                break
        return h

    return front * fraction(a, b, x) / a if x < (a + 1) / (a + b + 2) else 1 - front * fraction(b, a, 1 - x) / b


def two_sided_t(t: pd.Series, df: pd.Series) -> pd.Series:
    """student_tail of each row; for one row per test."""
    return pd.Series([None if pd.isna(x) else student_tail(float(x), float(n)) for x, n in zip(t, df, strict=True)], dtype="float64")


def histogram(df: DataFrame, value: str, bins: int) -> DataFrame:
    """bin (from 0), n: equal widths between the extremes, the last bin closed."""
    ends = df.agg(F.min(value).cast("double").alias("lo"), F.max(value).cast("double").alias("hi"))
    at = F.floor((F.col(value) - F.col("lo")) * bins / F.nullif(F.col("hi") - F.col("lo"), F.lit(0.0)))
    return df.filter(F.col(value).isNotNull()).crossJoin(F.broadcast(ends)).groupBy(F.coalesce(F.least(at, F.lit(bins - 1)), F.lit(0)).cast("int").alias("bin")).agg(F.count("*").alias("n"))


def hashed_sample(df: DataFrame, key: str, n: int) -> DataFrame:
    """A repeatable sample of n rows: the lowest hashes of the key."""
    return df.orderBy(F.md5(F.col(key).cast("string")), key).limit(n)
