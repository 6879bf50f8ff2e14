"""Applying a stream of inserts, updates and deletes.

A transaction is one version (a monthly file); its changes carry a sequence number. Replay has four
steps: deliveries are reduced to one row per (version, row_no) and assembled into transactions; the
commit order of the versions is walked, and everything behind a gap (a missing month, or a version
that the manifest says is incomplete) is held; keys do not conflict with one another, so each replays
on its own, in parallel; and only the state up to the contiguous committed watermark is exposed.

Within a version all deletions precede all additions, and additions follow row_no; hence the last
event of a key is the maximum of (version, is addition, row_no), and the key exists exactly if that
event is an addition. A maximum needs no sorted per-key history: it is combined on the map side, so a
key with a third of all changes costs one row per task in the shuffle.

Defined results. Unusable indicators are ignored. Rows whose version is not YYYY-MM or whose row_no is
null cannot be ordered and are left out of the state (see `quarantined`). If deliveries of one change
differ, the first received counts (ties: lowest change_id). Null or blank key parts are ''. An empty
feed gives an empty state. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demesne.common import cut, micros, strip

KEY = ("uid", "ro", "apid")


def plain_number(c: Column) -> Column:
    """Trimmed; a whole number without sign clutter, leading zeros or an empty fraction; NULL gives ''."""
    s = F.coalesce(strip(c), F.lit(""))
    digits = F.regexp_extract(s, r"^\+?(-?)0*(\d+)(?:\.0*)?$", 2)
    sign = F.regexp_extract(s, r"^\+?(-?)0*(\d+)(?:\.0*)?$", 1)
    number = F.when(digits != "", F.when(digits == "0", digits).otherwise(F.concat(sign, digits)))
    return F.coalesce(number, s)


def normalised_changes(changes: DataFrame) -> DataFrame:
    indicator = F.upper(strip("change_indicator"))
    return changes.select(
        F.when(strip("version").rlike(r"^\d{4}-(0[1-9]|1[0-2])$"), strip("version")).alias("version"),
        F.col("row_no").cast("long").alias("row_no"),
        micros("received_at").alias("received"),
        F.col("change_id").cast("long").alias("change_id"),
        F.when(indicator.isin("A", "D"), indicator).alias("op"),
        F.coalesce(F.upper(strip("unique_identifier")), F.lit("")).alias("uid"),
        plain_number(F.col("reg_order")).alias("ro"),
        plain_number(F.col("associated_property_description_id")).alias("apid"),
    )


def quarantined(changes: DataFrame) -> DataFrame:
    """Changes that cannot be ordered or applied, with the reason."""
    n = normalised_changes(changes)
    why = F.when(F.col("version").isNull(), "version").when(F.col("row_no").isNull(), "row_no").when(F.col("op").isNull(), "indicator")
    return n.withColumn("reason", why).filter(F.col("reason").isNotNull()).select("change_id", "version", "row_no", "reason")


def transactions(changes: DataFrame) -> DataFrame:
    """One row per distinct change: deliveries of the same (version, row_no) are one."""
    usable = normalised_changes(changes).filter(F.col("version").isNotNull() & F.col("row_no").isNotNull())
    order = F.struct(F.coalesce("received", F.lit(2**62)).alias("received"), F.coalesce("change_id", F.lit(2**62)).alias("change_id"))
    first = F.min(F.struct(order.alias("o"), F.struct("op", *KEY).alias("v"))).alias("first")
    return usable.groupBy("version", "row_no").agg(first, F.count("*").alias("n_deliveries")).select("version", "row_no", "n_deliveries", "first.v.*")


def _next_month(version: str) -> str:
    y, m = map(int, version.split("-"))
    return f"{y + m // 12:04d}-{m % 12 + 1:02d}"


def watermark(assembled: DataFrame, manifest: DataFrame | None = None, start: str | None = None) -> DataFrame:
    """Each version with its number of changes and whether it is committed.

    manifest (version, n_changes) tells how many changes make a version complete; without one a version
    that has arrived is complete. start is the first version of the feed, by default the earliest seen.
    The walk over the versions runs on the driver: there is one row per month.
    """
    spark = assembled.sparkSession
    got = assembled.groupBy("version").agg(F.count("*").alias("n"))
    if manifest is not None:
        got = got.join(manifest.select(strip("version").alias("version"), F.col("n_changes").cast("long")), "version", "full").withColumn("complete", F.coalesce(F.col("n"), F.lit(0)) >= F.coalesce(F.col("n_changes"), F.lit(0)))
    else:
        got = got.withColumn("complete", F.lit(True))
    rows = sorted((r["version"], r["n"] or 0, r["complete"]) for r in got.select("version", "n", "complete").collect())
    out, expected, open_ = [], start or (rows[0][0] if rows else None), True
    for version, n, complete in rows:
        open_ = open_ and version <= expected and complete
        if version == expected:
            expected = _next_month(version)
        out.append((version, int(n), open_))
    return spark.createDataFrame(out, "version string, n_changes long, committed boolean")


def committed_through(marks: DataFrame) -> str | None:
    return marks.filter("committed").agg(F.max("version")).first()[0]


def replay(changes: DataFrame, manifest: DataFrame | None = None, start: str | None = None, ordered: DataFrame | None = None) -> DataFrame:
    """(uid, ro, apid, version, row_no) of every key that exists at the watermark."""
    assembled = ordered if ordered is not None else cut(transactions(changes))
    through = committed_through(watermark(assembled, manifest, start))
    visible = assembled.filter(F.col("op").isNotNull() & (F.col("version") <= F.lit(through)))
    last = F.max(F.struct("version", (F.col("op") == "A").alias("added"), "row_no")).alias("last")
    return visible.groupBy(*KEY).agg(last).filter("last.added").select(*KEY, "last.version", "last.row_no")
