"""Queries of the integrity problems: orphan references, positions, load profiles, change replay."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demesne.common import table
from demesne.operators import changefeed, orphans, spatial
from demesne.operators.profile import ColumnRule, base_aggregates, findings, profile_loads, value_counts
from demesne.plans.registry import Registry

REGISTRY = Registry()

# ---------------------------------------------------------------- P1

_P1_SQL = r"""
WITH bare AS (
  SELECT _id AS ext_id, loaded_at,
         regexp_replace(regexp_replace(regexp_replace(lower(lid), '[\s\x{00A0}]+', '', 'g'), '^[^0-9a-z]*((new)?(objectid|oid)[^0-9a-z]+)?', ''), '[^0-9a-z]+$', '') AS lid,
         regexp_replace(regexp_replace(regexp_replace(lower(uid), '[\s\x{00A0}]+', '', 'g'), '^[^0-9a-z]*((new)?(objectid|oid)[^0-9a-z]+)?', ''), '[^0-9a-z]+$', '') AS uid
  FROM leasesext),
first AS (SELECT ext_id, min(loaded_at) AS t0 FROM bare GROUP BY 1),
refs AS (
  SELECT DISTINCT b.ext_id, f.t0, r.ref_field, r.key
  FROM bare b JOIN first f USING (ext_id),
       LATERAL (SELECT 'lid' AS ref_field, b.lid AS key UNION ALL SELECT 'uid', b.uid) r
  WHERE r.key IS NOT NULL AND r.key <> ''),
live AS (
  SELECT 'lid' AS ref_field, lower(trim(_id)) AS key, min(loaded_at) AS t0 FROM leases GROUP BY 1, 2
  UNION ALL SELECT 'uid', lower(trim(uid)), min(loaded_at) AS t0 FROM leases GROUP BY 1, 2),
dead AS (SELECT DISTINCT 'lid' AS ref_field, lower(trim(lease_id)) AS key FROM deletedids
  UNION SELECT DISTINCT 'uid', lower(trim(uid)) FROM deletedids),
found AS (
  SELECT r.ext_id, r.ref_field, r.t0,
         CASE WHEN l.key IS NULL AND d.key IS NULL THEN 'missing' WHEN l.key IS NULL THEN 'deleted' WHEN l.t0 > r.t0 THEN 'late' END AS kind
  FROM refs r LEFT JOIN live l USING (ref_field, key) LEFT JOIN dead d USING (ref_field, key)),
p1 AS (SELECT ext_id, ref_field, max(kind) AS kind, strftime(min(t0), '%Y-%m') AS period FROM found WHERE kind IS NOT NULL GROUP BY 1, 2)
"""


@REGISTRY.add("p1_found", _P1_SQL + "SELECT ext_id, ref_field, kind, period FROM p1")
def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    leases, deleted = table(spark, sf_dir, "leases"), table(spark, sf_dir, "deletedids")
    found = orphans.orphan_references(
        table(spark, sf_dir, "leasesext"),
        {"lid": [(leases, "_id")], "uid": [(leases, "uid")]},
        {"lid": [(deleted, "lease_id")], "uid": [(deleted, "uid")]},
    )
    return found.select(F.col("record_id").alias("ext_id"), "ref_field", "kind", F.date_format("first_at", "yyyy-MM").alias("period"))


@REGISTRY.add("p1_orphan_report", _P1_SQL + "SELECT ref_field, kind, period, count(*) AS n_records FROM p1 GROUP BY 1, 2, 3")
def p1_orphan_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orphans.orphan_report(p1_found(spark, sf_dir))


# ---------------------------------------------------------------- P5

_P5_SQL = r"""
WITH n AS (
  SELECT version, row_no, upper(trim(change_indicator)) AS op, upper(trim(coalesce(unique_identifier, ''))) AS uid,
         regexp_replace(trim(coalesce(reg_order, '')), '^0*(\d+)(\.0*)?$', '\1') AS ro,
         regexp_replace(trim(coalesce(associated_property_description_id, '')), '^0*(\d+)(\.0*)?$', '\1') AS apid
  FROM leasechanges),
c AS (SELECT DISTINCT * FROM n WHERE op IN ('A', 'D')),
r AS (SELECT *, row_number() OVER (PARTITION BY uid, ro, apid ORDER BY version DESC, op, row_no DESC) AS k FROM c)
"""


@REGISTRY.add("p5_found", _P5_SQL + "SELECT uid, ro, apid, version, row_no FROM r WHERE k = 1 AND op = 'A'")
def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changefeed.replay(table(spark, sf_dir, "leasechanges"))


@REGISTRY.add(
    "p5_watermark",
    "SELECT version, count(DISTINCT row_no) AS n_changes, true AS committed FROM leasechanges GROUP BY 1",
)
def p5_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions and whether they lie below the contiguous committed watermark."""
    return changefeed.watermark(changefeed.transactions(table(spark, sf_dir, "leasechanges")))


_P5_VERSIONS = ", vs AS (SELECT version, row_number() OVER (ORDER BY version) AS nth FROM (SELECT DISTINCT version FROM leasechanges))"
_P5_UNTIL = ", w AS (SELECT *, row_number() OVER (PARTITION BY uid, ro, apid ORDER BY version DESC, op, row_no DESC) AS kk FROM c JOIN vs USING (version) WHERE nth < {nth}) SELECT uid, ro, apid, version, row_no FROM w WHERE kk = 1 AND op = 'A'"


def _version(changes: DataFrame, nth: int) -> str:
    return [r[0] for r in changes.select("version").distinct().orderBy("version").collect()][nth - 1]  # one row per month


@REGISTRY.add("p5_held_gap", _P5_SQL + _P5_VERSIONS + _P5_UNTIL.format(nth=4))
def p5_held_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feed whose fourth month is missing: later months have arrived and are held back."""
    changes = table(spark, sf_dir, "leasechanges")
    return changefeed.replay(changes.filter(F.col("version") != _version(changes, 4)))


@REGISTRY.add("p5_held_incomplete", _P5_SQL + _P5_VERSIONS + _P5_UNTIL.format(nth=6))
def p5_held_incomplete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A manifest says how many changes each month has; the sixth lacks one, so it and what follows are held back."""
    changes = table(spark, sf_dir, "leasechanges")
    manifest = changes.groupBy("version").agg((F.countDistinct("row_no") + (F.first("version") == _version(changes, 6)).cast("long")).alias("n_changes"))
    return changefeed.replay(changes, manifest)


# ---------------------------------------------------------------- P2

P2_CTE = """
WITH raw AS (
  SELECT _id AS id, loc.coordinates[1] AS a, loc.coordinates[2] AS b, len(loc.coordinates) AS n, lon AS c, lat AS d FROM leasesext),
pos AS (
  SELECT DISTINCT id,
    CASE WHEN n = 2 AND a BETWEEN -8 AND 2 AND b BETWEEN 49 AND 61 THEN a WHEN n = 2 AND b BETWEEN -8 AND 2 AND a BETWEEN 49 AND 61 THEN b
         WHEN c BETWEEN -8 AND 2 AND d BETWEEN 49 AND 61 THEN c WHEN d BETWEEN -8 AND 2 AND c BETWEEN 49 AND 61 THEN d END AS lon,
    CASE WHEN n = 2 AND a BETWEEN -8 AND 2 AND b BETWEEN 49 AND 61 THEN b WHEN n = 2 AND b BETWEEN -8 AND 2 AND a BETWEEN 49 AND 61 THEN a
         WHEN c BETWEEN -8 AND 2 AND d BETWEEN 49 AND 61 THEN d WHEN d BETWEEN -8 AND 2 AND c BETWEEN 49 AND 61 THEN c END AS lat
  FROM raw),
p AS (SELECT id, lon, lat, CAST(floor(lat / 0.0002) AS BIGINT) AS gy FROM pos WHERE lon IS NOT NULL),
near AS (
  SELECT DISTINCT 'near' AS rel, p.id AS id_a, q.id AS id_b
  FROM p JOIN (SELECT id, lon, lat, gy + k AS gy FROM p, (VALUES (-1), (0), (1)) v(k)) q USING (gy)
  WHERE p.id < q.id AND abs(p.lon - q.lon) < 0.0005
    AND 2 * 6371008.8 * asin(sqrt(pow(sin(radians(q.lat - p.lat) / 2), 2) + cos(radians(p.lat)) * cos(radians(q.lat)) * pow(sin(radians(q.lon - p.lon) / 2), 2))) <= 20),
g AS (SELECT lad_code, CAST(geometry AS JSON) AS j FROM districts),
polys AS (
  SELECT lad_code, json_extract(j, '$.coordinates[*]') AS rings FROM g WHERE j->>'$.type' = 'Polygon'
  UNION ALL SELECT lad_code, json_extract(x, '$[*]') FROM (SELECT lad_code, unnest(json_extract(j, '$.coordinates[*]')) AS x FROM g WHERE j->>'$.type' = 'MultiPolygon')),
rings AS (SELECT lad_code, unnest(rings) AS r FROM polys),
pts AS (SELECT lad_code, CAST(r AS DOUBLE[][]) AS v FROM rings),
edges AS (SELECT lad_code, v[i][1] AS x1, v[i][2] AS y1, v[i % len(v) + 1][1] AS x2, v[i % len(v) + 1][2] AS y2 FROM (SELECT lad_code, v, unnest(range(1, len(v) + 1)) AS i FROM pts)),
places AS (SELECT DISTINCT lon, lat FROM p),
crossed AS (
  SELECT lon, lat, lad_code FROM places JOIN edges ON (y1 > lat) <> (y2 > lat) AND lon < x1 + (lat - y1) * (x2 - x1) / (y2 - y1)
  GROUP BY 1, 2, 3 HAVING count(*) % 2 = 1)"""
_P2_SQL = P2_CTE + """
SELECT * FROM near UNION ALL SELECT DISTINCT 'in', p.id, c.lad_code FROM p JOIN crossed c USING (lon, lat)
"""


@REGISTRY.add("p2_found", _P2_SQL)
def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    ext = table(spark, sf_dir, "leasesext")
    near = spatial.near_pairs(ext, 20.0).select(F.lit("near").alias("rel"), "id_a", "id_b")
    held = spatial.containing_regions(ext, table(spark, sf_dir, "districts"), "lad_code")
    return near.unionAll(held.select(F.lit("in").alias("rel"), F.col("id").alias("id_a"), F.col("region").alias("id_b")))


# ---------------------------------------------------------------- P4

_YEAR = 365.25
_DAYS = (lambda d: (datetime.date.fromisoformat(d) - datetime.date(1970, 1, 1)).days)
LEASE_RULES = [
    ColumnRule("st", "date", _DAYS("1700-01-01"), _DAYS("2025-12-31"), 0.08, null_shift=0.18, top_shift=0.22, median_shift=40 * _YEAR),
    ColumnRule("exp", "date", _DAYS("1750-01-01"), _DAYS("3999-12-31"), 0.08, null_shift=0.18, top_shift=0.22, median_shift=300 * _YEAR),
    ColumnRule("ty", "number", 1, 3000, 0.08, null_shift=0.18, top_shift=0.22, median_shift=300),
    ColumnRule("cl", "text", pattern="^[A-Z][A-Z0-9]{0,5}$", max_violating=0.10, null_shift=0.18, top_shift=0.22),
]

_P4_BASE = r"""
WITH v AS (
  SELECT strftime(loaded_at, '%Y-%m') AS version, c.*
  FROM leasesext, LATERAL (
    SELECT 'st' AS column_name, CAST(st AS VARCHAR) AS value, CAST(date_diff('day', DATE '1970-01-01', st) AS DOUBLE) AS number
    UNION ALL SELECT 'exp', CAST(exp AS VARCHAR), CAST(date_diff('day', DATE '1970-01-01', exp) AS DOUBLE)
    UNION ALL SELECT 'ty', CAST(ty AS VARCHAR), CAST(ty AS DOUBLE)
    UNION ALL SELECT 'cl', nullif(trim(cl), ''), NULL) c
  WHERE loaded_at IS NOT NULL),
t AS (SELECT version, column_name, max(n) AS n_top FROM (SELECT version, column_name, value, count(*) AS n FROM v WHERE value IS NOT NULL GROUP BY ALL) GROUP BY ALL),
b AS (
  SELECT version, column_name, count(*) AS n_rows, count(*) - count(value) AS n_null, count(DISTINCT value) AS n_distinct,
         median(number) AS median, min(number) AS low, max(number) AS high,
         count(*) FILTER (column_name = 'st' AND (value < '1700-01-01' OR value > '2025-12-31') OR column_name = 'exp' AND (value < '1750-01-01' OR value > '3999-12-31') OR column_name = 'ty' AND (number < 1 OR number > 3000)) AS n_outside,
         count(*) FILTER (column_name = 'cl' AND NOT regexp_full_match(value, '[A-Z][A-Z0-9]{0,5}')) AS n_violating
  FROM v GROUP BY ALL),
p AS (SELECT b.*, t.n_top, n_null / n_rows AS null_share, n_top / (n_rows - n_null) AS top_share, n_outside / (n_rows - n_null) AS outside_share, n_violating / (n_rows - n_null) AS violating_share FROM b LEFT JOIN t USING (version, column_name)),
u AS (SELECT column_name, median(null_share) AS u_null, median(top_share) AS u_top, median(median) AS u_median FROM p GROUP BY 1)
"""
_P4_FOUND = _P4_BASE + """
SELECT version, column_name, f.finding FROM p JOIN u USING (column_name), LATERAL (
  SELECT 'nulls' AS finding, abs(null_share - u_null) > 0.18 AS hit
  UNION ALL SELECT 'top', abs(top_share - u_top) > 0.22
  UNION ALL SELECT 'median', abs(median - u_median) > CASE column_name WHEN 'st' THEN 40 * 365.25 WHEN 'exp' THEN 300 * 365.25 WHEN 'ty' THEN 300 END
  UNION ALL SELECT 'range', outside_share > 0.08
  UNION ALL SELECT 'pattern', violating_share > 0.10) f
WHERE f.hit
"""


def _lease_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile_loads(table(spark, sf_dir, "leasesext"), F.date_format("loaded_at", "yyyy-MM"), F.col("_id"), LEASE_RULES)


@REGISTRY.add("p4_found", _P4_FOUND)
def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return findings(_lease_profile(spark, sf_dir))


@REGISTRY.add("p4_profile")
def p4_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole profile with the classifier's discrimination; its AUCs have no SQL form."""
    return _lease_profile(spark, sf_dir)


@REGISTRY.add(
    "p4_base_aggregates",
    _P4_BASE + "SELECT version, column_name, n_rows, n_null, n_distinct, n_top, low, high, median, n_outside, n_violating FROM p",
)
def p4_base_aggregates(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = value_counts(table(spark, sf_dir, "leasesext"), F.date_format("loaded_at", "yyyy-MM"), LEASE_RULES)
    return base_aggregates(counts, LEASE_RULES).select("version", "column_name", "n_rows", "n_null", "n_distinct", "n_top", "low", "high", "median", "n_outside", "n_violating")
