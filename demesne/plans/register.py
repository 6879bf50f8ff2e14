"""Queries of the register's own operators, each with the SQL it is checked against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from demesne.common import table
from demesne.functions import dates, geo, text
from demesne.functions.validate import findings
from demesne.operators import analytics, delta, match, regions
from demesne.operators.spatial import containing_regions, position
from demesne.plans.integrity import P2_CTE
from demesne.plans.records import EXT_CTE as _EXT, LEASES_CTE, REFERENCE, ext as _ext, leases as _leases, ref as _ref
from demesne.plans.registry import Registry
from demesne.plans.terms import codes_sql

REGISTRY = Registry()
add = REGISTRY.add


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return table(spark, sf_dir, name)


_YEARS = f"date_diff('day', DATE '{REFERENCE}', exp) / 365.25"

# ---------------------------------------------------------------- scans, projections, filters


@add("scan_change_split", "SELECT upper(trim(change_indicator)) AS kind, count(*) AS n, count(DISTINCT version) AS n_versions FROM leasechanges WHERE upper(trim(change_indicator)) IN ('A', 'D') GROUP BY 1")
def scan_change_split(spark, d):
    deletes, adds = delta.split_changes(_t(spark, d, "leasechanges"))
    return deletes.unionAll(adds).groupBy(F.upper(F.trim("change_indicator")).alias("kind")).agg(F.count("*").alias("n"), F.countDistinct("version").alias("n_versions"))


_MAP = r"""
SELECT change_id, nullif(trim(unique_identifier), '') AS uid, nullif(trim(register_property_description), '') AS rpd, nullif(trim(term), '') AS term,
  CASE WHEN regexp_full_match(trim(os_uprn), '[0-9]+') THEN CAST(trim(os_uprn) AS BIGINT) END AS uprn_n,
  CASE WHEN regexp_full_match(trim(reg_order), '[0-9]+') THEN CAST(trim(reg_order) AS BIGINT) END AS ro_n,
  CASE WHEN regexp_full_match(trim(price_paid), '[0-9]+') THEN CAST(trim(price_paid) AS BIGINT) END AS ppd_n,
  nullif(upper(regexp_replace(regexp_extract(concat_ws(' ', nullif(trim(register_property_description), ''), nullif(trim(associated_property_description), '')), '(?i)\b[A-Z]{1,2}\d{1,2}[A-Z]?\s?\d[A-Z]{2}\b', 0), '\s+', ' ', 'g')), '') AS pc
FROM leasechanges
"""


@add("proj_mapped_rows", _MAP)
def proj_mapped_rows(spark, d):
    return text.mapped_rows(_t(spark, d, "leasechanges")).select("change_id", "uid", "rpd", "term", "uprn_n", "ro_n", "ppd_n", "pc")


@add("proj_short_keys", "SELECT _id AS lease_id, uid, ty AS tenure_years, trim(cl) AS class, apc AS ab_postcode FROM leasesext")
def proj_short_keys(spark, d):
    e = _t(spark, d, "leasesext").drop("xc", "yc", "ud").withColumnsRenamed({"_id": "lease_id", "ty": "tenure_years", "cl": "class", "apc": "ab_postcode"})
    return e.select("lease_id", "uid", "tenure_years", F.trim("class").alias("class"), "ab_postcode")


@add(
    "flt_postcodes_differ",
    f"WITH {_EXT}, {LEASES_CTE}, l AS (SELECT _id, pc FROM lease) SELECT e._id AS ext_id, l.pc, e.apc, coalesce(l.pc, e.apc) AS filled FROM ext e JOIN l ON e.lid = l._id WHERE l.pc <> e.apc OR l.pc IS NULL AND e.apc IS NOT NULL",
)
def flt_postcodes_differ(spark, d):
    leases = _leases(spark, d).select("_id", "pc")
    j = _ext(spark, d).withColumnRenamed("_id", "ext_id").join(leases, F.col("lid") == leases["_id"])
    return j.filter((F.col("pc") != F.col("apc")) | (F.col("pc").isNull() & F.col("apc").isNotNull())).select("ext_id", "pc", "apc", F.coalesce("pc", "apc").alias("filled"))


@add("flt_exists", "SELECT count(*) FILTER (term IS NULL OR trim(term) = '') AS n_no_term, count(*) FILTER (dol IS NOT NULL AND trim(dol) <> '') AS n_with_dol, count(*) FILTER (uprn IS NULL AND pc IS NOT NULL) AS n_pc_only FROM leases")
def flt_exists(spark, d):
    blank = lambda c: F.col(c).isNull() | (F.trim(c) == "")
    return _t(spark, d, "leases").agg(F.count_if(blank("term")).alias("n_no_term"), F.count_if(~blank("dol")).alias("n_with_dol"), F.count_if(F.col("uprn").isNull() & F.col("pc").isNotNull()).alias("n_pc_only"))


@add("flt_page", "SELECT _id, uid FROM (SELECT DISTINCT _id, uid FROM leases WHERE _id > '68') ORDER BY _id, uid LIMIT 25 OFFSET 50")
def flt_page(spark, d):
    """A page of a keyset scan that resumes after an id."""
    return _t(spark, d, "leases").filter(F.col("_id") > "68").select("_id", "uid").distinct().orderBy("_id", "uid").offset(50).limit(25)


@add(
    "flt_residential",
    "SELECT coalesce(substr(upper(trim(cl)), 1, 1) IN ('R', 'X', 'P'), false) AS residential, coalesce(coalesce(upper(trim(cl)), 'R') IN ('R', 'X', 'P'), false) AS kept_exact, count(*) AS n FROM leasesext GROUP BY 1, 2",
)
def flt_residential(spark, d):
    e = _t(spark, d, "leasesext").select(text.is_residential(F.col("cl")).alias("residential"), text.is_residential(F.coalesce("cl", F.lit("R")), exact=True).alias("kept_exact"))
    return e.groupBy("residential", "kept_exact").agg(F.count("*").alias("n"))


@add("flt_short_terms", f"WITH {_EXT} SELECT _id, ty FROM ext WHERE ty IS NULL OR ty >= 21")
def flt_short_terms(spark, d):
    return delta.keep_long_terms(_ext(spark, d)).select("_id", "ty")


@add("flt_compound", f"WITH {_EXT} SELECT _id, apc, cl, ty, exp FROM ext WHERE apc LIKE 'QA1%' AND cl LIKE 'R%' AND ty <= 125 AND exp BETWEEN DATE '2030-01-01' AND DATE '2120-12-31'")
def flt_compound(spark, d):
    e = _ext(spark, d)
    return e.filter(F.col("apc").startswith("QA1") & F.col("cl").startswith("R") & (F.col("ty") <= 125) & F.col("exp").between("2030-01-01", "2120-12-31")).select("_id", "apc", "cl", "ty", "exp")


@add("flt_active_short", f"WITH {_EXT} SELECT count(*) AS n FROM ext WHERE ty < 21 AND exp > DATE '{REFERENCE}'")
def flt_active_short(spark, d):
    return _ext(spark, d).filter((F.col("ty") < 21) & (F.col("exp") > _ref())).agg(F.count("*").alias("n"))


@add("flt_route", "SELECT CASE WHEN uprn IS NOT NULL THEN 'uprn' WHEN pc IS NOT NULL THEN 'pc' WHEN cty IS NOT NULL THEN 'city' ELSE 'none' END AS route, count(*) AS n FROM leases GROUP BY 1")
def flt_route(spark, d):
    return _t(spark, d, "leases").groupBy(match.route(F.col("uprn"), F.col("pc"), F.col("cty")).alias("route")).agg(F.count("*").alias("n"))


@add("proj_version", "SELECT DISTINCT concat('CHANGES_', replace(version, '-', '_'), '.zip') AS file, version FROM leasechanges")
def proj_version(spark, d):
    f = _t(spark, d, "leasechanges").select(F.concat(F.lit("CHANGES_"), F.replace("version", F.lit("-"), F.lit("_")), F.lit(".zip")).alias("file")).distinct()
    return f.withColumn("version", text.version_of(F.col("file")))


# ---------------------------------------------------------------- joins


@add("join_uprn", "WITH g AS (SELECT uprn, max(id) AS gid FROM ab_plus GROUP BY 1) SELECT DISTINCT l._id AS lease_id, g.gid FROM leases l JOIN g USING (uprn)")
def join_uprn(spark, d):
    g = match.unique_uprn(_t(spark, d, "ab_plus").select("uprn", "id")).select("uprn", F.col("id").alias("gid"))
    return _t(spark, d, "leases").join(g, "uprn").select(F.col("_id").alias("lease_id"), "gid").distinct()


_NUMBER = r"(\d+[A-Z]?(?:-\d+)?) ([A-Z]+(?: [A-Z]+)*)"


def _requests(spark, d):
    """Look-up requests from the associated address: number, road, postcode, town."""
    a = F.upper("apd")
    r = _leases(spark, d).withColumnRenamed("_id", "request_id")
    none = F.lit("")
    return r.select(
        "request_id", "uid", "uprn",
        F.nullif(F.regexp_extract(a, rf"(?:^|, ){_NUMBER}", 1), none).alias("house_number"),
        F.nullif(F.regexp_extract(a, rf"(?:^|, ){_NUMBER}", 2), none).alias("road"),
        F.nullif(F.regexp_extract(a, r", ([A-Z]+)(?: QA[0-9A-Z ]+)?$", 1), none).alias("city"),
        F.col("pc").alias("postcode"),
    )


_REQUESTS = LEASES_CTE + r""",
r0 AS (SELECT _id AS request_id, uid, uprn, upper(apd) AS apd, pc AS postcode FROM lease),
r1 AS (SELECT request_id, uid, uprn, nullif(regexp_extract(apd, '(?:^|, )(\d+[A-Z]?(?:-\d+)?) ([A-Z]+(?: [A-Z]+)*)', 1), '') AS house_number,
         nullif(regexp_extract(apd, '(?:^|, )(\d+[A-Z]?(?:-\d+)?) ([A-Z]+(?: [A-Z]+)*)', 2), '') AS road,
         nullif(regexp_extract(apd, ', ([A-Z]+)(?: QA[0-9A-Z ]+)?$', 1), '') AS city, postcode FROM r0),
r AS (SELECT *, coalesce(nullif(regexp_extract(trim(split_part(house_number, '-', 1)), '^(\d+)', 1), ''), trim(split_part(house_number, '-', 1))) AS base FROM r1)
"""
_PRIORITY = "CASE WHEN upper(g.building_number) = upper(r.house_number) THEN 1 WHEN upper(g.building_name) = upper(r.house_number) THEN 2 WHEN starts_with(upper(g.building_number), upper(r.base)) THEN 3 WHEN starts_with(upper(g.building_name), upper(r.base)) THEN 4 END"
_CASCADE = f"""
WITH {_REQUESTS},
u AS (SELECT uprn, max(id) AS id FROM ab_plus GROUP BY 1),
c AS (
  SELECT request_id, 1 AS stage, u.id AS gazetteer_id, u.uprn, 1 AS priority FROM r JOIN u USING (uprn)
  UNION ALL SELECT request_id, 2, g.id, g.uprn, {_PRIORITY} AS p FROM r JOIN ab_plus g ON upper(g.thoroughfare) = r.road AND upper(g.postcode) = upper(r.postcode) WHERE p IS NOT NULL
  UNION ALL SELECT request_id, 3, g.id, g.uprn, {_PRIORITY} AS p FROM r JOIN ab_plus g ON upper(g.thoroughfare) = r.road AND upper(g.post_town) = r.city WHERE p IS NOT NULL),
m AS (SELECT request_id, stage, gazetteer_id, uprn FROM (SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY stage, priority, gazetteer_id) AS k FROM c) WHERE k = 1)
"""


@add("join_match_cascade", _CASCADE + "SELECT request_id, stage, gazetteer_id, uprn FROM m")
def join_match_cascade(spark, d):
    return match.matches(_requests(spark, d), _t(spark, d, "ab_plus"))


@add("join_postcode_stage", _CASCADE + "SELECT stage, count(*) AS n, count(DISTINCT uprn) AS n_uprn FROM m GROUP BY 1")
def join_postcode_stage(spark, d):
    """How many requests each stage of the cascade settles (with the stage semantics of the postcode and town joins)."""
    return match.matches(_requests(spark, d), _t(spark, d, "ab_plus")).groupBy("stage").agg(F.count("*").alias("n"), F.countDistinct("uprn").alias("n_uprn"))


@add("join_found_split", _CASCADE + "SELECT m.request_id IS NOT NULL AS found, count(*) AS n FROM r LEFT JOIN m USING (request_id) GROUP BY 1")
def join_found_split(spark, d):
    r = _requests(spark, d)
    m = match.matches(r, _t(spark, d, "ab_plus"))
    found, missed = r.join(m, "request_id", "left_semi"), r.join(m, "request_id", "left_anti")
    return found.agg(F.lit(True).alias("found"), F.count("*").alias("n")).unionAll(missed.agg(F.lit(False), F.count("*")))


@add(
    "join_title_propagation",
    _CASCADE + ", own AS (SELECT r.uid, request_id, gazetteer_id FROM r JOIN m USING (request_id)), f AS (SELECT uid, arg_min(gazetteer_id, request_id) AS gid FROM own GROUP BY 1) SELECT request_id, gazetteer_id, 'own' AS how FROM own UNION ALL SELECT r.request_id, f.gid, 'title' FROM r JOIN f USING (uid) WHERE r.request_id NOT IN (SELECT request_id FROM own)",
)
def join_title_propagation(spark, d):
    r = _requests(spark, d)
    return match.propagated(r, match.matches(r, _t(spark, d, "ab_plus")))


@add(
    "join_geocode",
    f"WITH {_EXT}, g AS (SELECT upper(replace(trim(postcode), ' ', '')) AS k, round(avg(latitude), 5) AS lat, round(avg(longitude), 5) AS lon FROM ab_plus WHERE postcode IS NOT NULL GROUP BY 1), {LEASES_CTE}, l AS (SELECT _id, pc FROM lease) SELECT l._id AS lease_id, g.k AS postcode, g.lat, g.lon FROM l LEFT JOIN g ON upper(replace(trim(l.pc), ' ', '')) = g.k",
)
def join_geocode(spark, d):
    g = _t(spark, d, "ab_plus").filter("postcode IS NOT NULL").groupBy(text.cache_key(F.col("postcode")).alias("postcode")).agg(F.round(F.avg("latitude"), 5).alias("lat"), F.round(F.avg("longitude"), 5).alias("lon"))
    leases = _leases(spark, d).select(F.col("_id").alias("lease_id"), "pc")
    return leases.join(g, text.cache_key(F.col("pc")) == g["postcode"], "left").select("lease_id", "postcode", "lat", "lon")


@add("join_cache_stats", "WITH l AS (SELECT DISTINCT upper(replace(trim(pc), ' ', '')) AS k FROM leases WHERE pc IS NOT NULL), g AS (SELECT DISTINCT upper(replace(trim(postcode), ' ', '')) AS k FROM ab_plus WHERE postcode IS NOT NULL) SELECT count(*) AS size, count(g.k) AS hits, count(*) - count(g.k) AS misses FROM l LEFT JOIN g USING (k)")
def join_cache_stats(spark, d):
    keys = lambda t, c: _t(spark, d, t).filter(F.col(c).isNotNull()).select(text.cache_key(F.col(c)).alias("k")).distinct()
    j = keys("leases", "pc").join(keys("ab_plus", "postcode").withColumn("hit", F.lit(1)), "k", "left")
    return j.agg(F.count("*").alias("size"), F.count("hit").alias("hits"), (F.count("*") - F.count("hit")).alias("misses"))


_VIEWS = "v AS (SELECT DISTINCT ON (uniqueid) uniqueid AS uid, viewcount AS views FROM leaseviewstats ORDER BY uniqueid, lastviewedat DESC NULLS LAST, _id DESC NULLS LAST, viewcount DESC NULLS LAST)"


def _views(spark, d):
    """(uid, views): of repeated rows of a title the one viewed last counts."""
    last = F.max_by(F.struct("viewcount"), F.struct("lastviewedat", "_id", "viewcount"))
    return _t(spark, d, "leaseviewstats").groupBy(F.col("uniqueid").alias("uid")).agg(last.alias("x")).select("uid", F.col("x.viewcount").alias("views"))


def _viewed(spark, d):
    v = _views(spark, d)
    return _ext(spark, d).join(v, "uid").withColumn("years", dates.years_remaining(F.col("exp"), _ref()))


@add("join_views", f"WITH {_EXT}, {_VIEWS} SELECT e._id, uid, v.views, {_YEARS} AS years FROM ext e JOIN v USING (uid)")
def join_views(spark, d):
    return _viewed(spark, d).select("_id", "uid", "views", "years")


@add(
    "join_range_expansion",
    "SELECT id, uprn, building_number, building_name, thoroughfare, 'base' AS origin FROM ab_plus UNION ALL SELECT id, uprn, CAST(n AS VARCHAR), NULL, thoroughfare, 'range' FROM (SELECT *, unnest(generate_series(CAST(split_part(building_name, '-', 1) AS BIGINT), CAST(split_part(building_name, '-', 2) AS BIGINT))) AS n FROM ab_plus WHERE regexp_full_match(building_name, '[0-9]+-[0-9]+')) UNION ALL SELECT id, uprn, building_number, building_name, replace(thoroughfare, 'ST.', 'ST'), 'st' FROM ab_plus WHERE contains(thoroughfare, 'ST.')",
)
def join_range_expansion(spark, d):
    return match.expanded(_t(spark, d, "ab_plus")).select("id", "uprn", "building_number", "building_name", "thoroughfare", "origin")


@add("join_update_fields", f"WITH {_EXT}, {LEASES_CTE}, u AS (SELECT lid, min(cl) AS cl FROM ext GROUP BY 1), l AS (SELECT _id, aci FROM lease) SELECT l._id, coalesce(u.cl, l.aci) AS aci FROM l LEFT JOIN u ON u.lid = l._id")
def join_update_fields(spark, d):
    l = _leases(spark, d).select("_id", "aci")
    u = _ext(spark, d).groupBy(F.col("lid").alias("_id")).agg(F.min("cl").alias("aci"))
    return match.updated(l, u, "_id", ["aci"])


# ---------------------------------------------------------------- validation and scalar functions


@add("val_term_findings", f"WITH {_EXT} SELECT _id, {codes_sql('st', 'exp', 'ty')} AS codes FROM ext")
def val_term_findings(spark, d):
    """Every record with its findings, whatever its tenure."""
    e = _ext(spark, d)
    return e.select("_id", F.array_join(findings(F.col("st"), F.col("exp"), F.col("ty").cast("double"), _ref())["code"], ",").alias("codes"))


@add("fn_house_numbers", r"SELECT id, trim(split_part(building_name, '-', 1)) AS head, coalesce(nullif(regexp_extract(trim(split_part(building_name, '-', 1)), '^(\d+)', 1), ''), trim(split_part(building_name, '-', 1))) AS base FROM ab_plus WHERE building_name IS NOT NULL")
def fn_house_numbers(spark, d):
    return _t(spark, d, "ab_plus").filter("building_name IS NOT NULL").select("id", text.house_number_start(F.col("building_name")).alias("head"), text.base_number(F.col("building_name")).alias("base"))


@add(
    "fn_char_difference",
    "WITH p AS (SELECT DISTINCT rpd, apd FROM leases WHERE rpd IS NOT NULL AND apd IS NOT NULL), q AS (SELECT rpd, apd, trim(rpd) AS a, upper(trim(apd)) AS b FROM p) SELECT rpd, apd, CASE WHEN a = b THEN 0 ELSE len(list_filter(range(1, greatest(length(a), length(b)) + 1), lambda i: substr(a, i, 1) <> substr(b, i, 1))) END AS difference FROM q",
)
def fn_char_difference(spark, d):
    p = _t(spark, d, "leases").filter("rpd IS NOT NULL AND apd IS NOT NULL").select("rpd", "apd").distinct()
    return p.select("rpd", "apd", text.char_difference(text.text_value(F.col("rpd")), F.upper(text.text_value(F.col("apd")))).cast("long").alias("difference"))


@add("fn_geojson_point", "SELECT _id, there, CASE WHEN there THEN 'Point' END AS type, CASE WHEN there THEN round(lon, 9) END AS x, CASE WHEN there THEN round(lat, 9) END AS y FROM (SELECT *, coalesce(lat <> 0 AND lon <> 0 AND NOT isnan(lat) AND NOT isnan(lon), false) AS there FROM leasesext)")
def fn_geojson_point(spark, d):
    p = _t(spark, d, "leasesext").select("_id", geo.geojson_point(F.col("lon"), F.col("lat")).alias("p"))
    return p.select("_id", F.col("p").isNotNull().alias("there"), "p.type", F.round(F.get("p.coordinates", F.lit(0)), 9).alias("x"), F.round(F.get("p.coordinates", F.lit(1)), 9).alias("y"))


@add("fn_years_remaining", f"WITH {_EXT} SELECT _id, round({_YEARS}, 6) AS years, CAST(floor({_YEARS}) AS BIGINT) AS whole, CASE WHEN {_YEARS} < 70 THEN '<70' WHEN {_YEARS} < 80 THEN '70-80' WHEN {_YEARS} < 90 THEN '80-90' WHEN {_YEARS} < 100 THEN '90-100' ELSE '100+' END AS category FROM ext WHERE exp IS NOT NULL")
def fn_years_remaining(spark, d):
    y = dates.years_remaining(F.col("exp"), _ref())
    return _ext(spark, d).filter("exp IS NOT NULL").select("_id", F.round(y, 6).alias("years"), F.floor(y).alias("whole"), dates.term_category(y).alias("category"))


_ANY = r"""
WITH e AS (SELECT DISTINCT CAST(exp AS VARCHAR) AS t FROM leasesext WHERE exp IS NOT NULL),
x AS (SELECT dol AS t FROM leases WHERE dol IS NOT NULL UNION SELECT version FROM leasechanges UNION SELECT t FROM e UNION SELECT t || 'T00:00:00' FROM e UNION SELECT replace(t, '-', '/') FROM e UNION SELECT t[:4] FROM e),
y AS (SELECT t, trim(t) AS s FROM x)
SELECT t, CASE WHEN length(s) = 10 THEN coalesce(try_strptime(s, '%Y-%m-%d'), try_strptime(s, '%d/%m/%Y'), try_strptime(s, '%d-%m-%Y'), try_strptime(s, '%Y/%m/%d'))::DATE
  WHEN regexp_matches(s, '^[0-9]{4}-[0-9][0-9]-[0-9][0-9][T ]') THEN try_strptime(s[:10], '%Y-%m-%d')::DATE
  WHEN regexp_full_match(s, '[0-9]{4}') AND CAST(s AS INTEGER) BETWEEN 1900 AND 3000 THEN make_date(CAST(s AS INTEGER), 1, 1) END AS day FROM y
"""


@add("fn_any_expiry", _ANY)
def fn_any_expiry(spark, d):
    """Dates in every notation of the tables: dates of leases, versions (no date), expiries in four forms and as a bare year."""
    e = _t(spark, d, "leasesext").filter("exp IS NOT NULL").select(F.col("exp").cast("string").alias("t")).distinct()
    forms = e.select(F.explode(F.array("t", F.concat("t", F.lit("T00:00:00")), F.replace("t", F.lit("-"), F.lit("/")), F.substring("t", 1, 4))).alias("t"))
    dol, version = _t(spark, d, "leases").filter("dol IS NOT NULL").select(F.col("dol").alias("t")), _t(spark, d, "leasechanges").select(F.col("version").alias("t"))
    return dol.unionAll(version).unionAll(forms).distinct().withColumn("day", dates.any_expiry(F.col("t")))


_PC = r"(?i)\b[A-Z]{1,2}\d{1,2}[A-Z]?\s?\d[A-Z]{2}\b"
_PARTS = rf"""
WITH a AS (SELECT _id, CASE WHEN len(string_split(apd, ',')) > 2 THEN array_to_string(list_transform(string_split(apd, ',')[2:], lambda s: trim(s)), ', ') ELSE apd END AS t FROM leases),
b AS (SELECT _id, nullif(upper(regexp_replace(regexp_extract(t, '{_PC}', 0), '\s+', ' ', 'g')), '') AS postcode,
  list_filter(list_transform(string_split(regexp_replace(regexp_replace(upper(t), '{_PC}', '', 'g'), '[()]', ' ', 'g'), ','), lambda s: trim(regexp_replace(s, '\s+', ' ', 'g'))), lambda s: s <> '') AS ps FROM a),
c AS (SELECT *, list_filter(ps, lambda s: regexp_matches(s, '^\d+[A-Z]?(-\d+[A-Z]?)?\s+\S'))[-1] AS numbered FROM b),
e AS (SELECT _id, postcode, nullif(regexp_extract(numbered, '^(\d+[A-Z]?(?:-\d+[A-Z]?)?)\s', 1), '') AS house_number, CASE WHEN len(ps) > 1 AND NOT regexp_matches(ps[-1], '^\d') THEN ps[-1] END AS city,
  upper(coalesce(nullif(regexp_replace(numbered, '^\d+[A-Z]?(?:-\d+[A-Z]?)?\s+', ''), ''), ps[1])) AS r FROM c),
s AS (SELECT *, CASE {" ".join(rf"WHEN regexp_matches(r, '^.+?\s+{w}\s+.+$') THEN '{w}'" for w in text.BUILDING_WORDS)} END AS w FROM e)
SELECT _id, house_number, city, postcode, CASE {" ".join(rf"WHEN w = '{w}' THEN concat_ws(' ', house_number, trim(regexp_extract(r, '^(.+?\s+{w})\s+(.+)$', 1)))" for w in text.BUILDING_WORDS)} END AS house,
  CASE {" ".join(rf"WHEN w = '{w}' THEN trim(regexp_extract(r, '^(.+?\s+{w})\s+(.+)$', 2))" for w in text.BUILDING_WORDS)} ELSE r END AS road FROM s
"""


@add("fn_address_parts", _PARTS)
def fn_address_parts(spark, d):
    """Components of the associated address by rules, and a building split off its road."""
    p = _t(spark, d, "leases").select("_id", text.address_parts(text.short_address(F.col("apd"))).alias("p"))
    return p.select("_id", "p.*", text.split_road(F.col("p.road"), F.col("p.house_number")).alias("s")).select("_id", "house_number", "city", "postcode", "s.house", "s.road")


# ---------------------------------------------------------------- aggregates


@add(
    "agg_missing_fields",
    "SELECT f.field, count(*) AS total, count(*) FILTER (f.v IS NULL) AS n_null, count(*) FILTER (trim(f.v) = '') AS n_blank, round(100.0 * count(*) FILTER (f.v IS NULL OR trim(f.v) = '') / count(*), 6) AS missing_percent FROM leases, LATERAL (SELECT 'term' AS field, term AS v UNION ALL SELECT 'dol', dol UNION ALL SELECT 'pc', pc UNION ALL SELECT 'rpd', rpd UNION ALL SELECT 'apd', apd UNION ALL SELECT 'uprn', CAST(uprn AS VARCHAR)) f GROUP BY 1",
)
def agg_missing_fields(spark, d):
    return analytics.missing_fields(_t(spark, d, "leases"), ["term", "dol", "pc", "rpd", "apd", "uprn"])


@add("agg_commercial_suspects", f"WITH {_EXT} SELECT count(*) AS n FROM ext WHERE ty < 25 AND pt IS NULL")
def agg_commercial_suspects(spark, d):
    return _ext(spark, d).filter((F.col("ty") < 25) & F.col("pt").isNull()).agg(F.count("*").alias("n"))


@add("agg_coverage", "SELECT count(*) AS total, count(loc.coordinates) AS with_loc, count(exp) AS with_exp, count(*) FILTER (loc.coordinates IS NOT NULL AND exp IS NOT NULL) AS with_both, round(100.0 * count(*) FILTER (loc.coordinates IS NOT NULL AND exp IS NOT NULL) / count(*), 6) AS both_percent, count(*) - count(loc.coordinates) AS no_loc FROM leasesext")
def agg_coverage(spark, d):
    both = F.col("loc.coordinates").isNotNull() & F.col("exp").isNotNull()
    return _t(spark, d, "leasesext").agg(F.count("*").alias("total"), F.count("loc.coordinates").alias("with_loc"), F.count("exp").alias("with_exp"), F.count_if(both).alias("with_both"), F.round(analytics.share(F.count_if(both), F.count("*")), 6).alias("both_percent"), (F.count("*") - F.count("loc.coordinates")).alias("no_loc"))


def _located(spark, d):
    """Records with their district: code, OUTSIDE_DISTRICTS, ERRORS (a location that cannot be used), or NO_LOCATION."""
    raw = _t(spark, d, "leasesext")
    held = containing_regions(raw, _t(spark, d, "districts"), "lad_code").groupBy("id").agg(F.min("region").alias("code"))
    given = F.col("loc.coordinates").isNotNull() | F.col("lat").isNotNull() | F.col("lon").isNotNull()
    placed = raw.filter(given).groupBy(F.col("_id").alias("id")).agg(F.bool_or(position().isNotNull()).alias("placed"))
    j = _ext(spark, d).join(held, F.col("_id") == held["id"], "left").drop("id").join(placed, F.col("_id") == placed["id"], "left").drop("id")
    code = F.coalesce("code", F.when(F.col("placed"), "OUTSIDE_DISTRICTS").when(~F.col("placed"), "ERRORS").otherwise("NO_LOCATION"))
    return j.withColumn("code", code).withColumn("years", dates.years_remaining(F.col("exp"), _ref())).drop("placed")


_LOCATED = f"""{P2_CTE}, {_EXT},
held AS (SELECT p.id, min(c.lad_code) AS lad FROM p JOIN crossed c USING (lon, lat) GROUP BY 1),
placed AS (SELECT DISTINCT id FROM p),
given AS (SELECT DISTINCT _id AS id FROM leasesext WHERE loc.coordinates IS NOT NULL OR lat IS NOT NULL OR lon IS NOT NULL),
located AS (SELECT ext.*, coalesce(lad, CASE WHEN placed.id IS NOT NULL THEN 'OUTSIDE_DISTRICTS' WHEN given.id IS NOT NULL THEN 'ERRORS' ELSE 'NO_LOCATION' END) AS code, {_YEARS} AS years FROM ext LEFT JOIN held ON held.id = ext._id LEFT JOIN placed ON placed.id = ext._id LEFT JOIN given ON given.id = ext._id)
"""


@add("agg_district_counts", _LOCATED + "SELECT code, count(*) AS n FROM located GROUP BY 1")
def agg_district_counts(spark, d):
    return _located(spark, d).groupBy("code").agg(F.count("*").alias("n"))


@add("agg_district_reconciled", _LOCATED + "SELECT (SELECT count(*) FROM located) AS bucketed, (SELECT count(*) FROM ext) AS total")
def agg_district_reconciled(spark, d):
    """The districts' counts and the synthetic rows sum to the number of records."""
    n = agg_district_counts(spark, d).agg(F.sum("n").alias("bucketed"))
    return n.crossJoin(_ext(spark, d).agg(F.count("*").alias("total")))  # one row each


@add("agg_district_short_share", _LOCATED + "SELECT code, total, valid, short, percent, row_number() OVER (ORDER BY percent DESC NULLS LAST, code) AS rank FROM (SELECT code, count(*) AS total, count(exp) AS valid, count(*) FILTER (years <= 80) AS short, round(100.0 * count(*) FILTER (years <= 80) / nullif(count(exp), 0), 6) AS percent FROM located WHERE code LIKE 'Z%' GROUP BY 1)")
def agg_district_short_share(spark, d):
    g = _located(spark, d).filter(F.col("code").startswith("Z")).groupBy("code").agg(F.count("*").alias("total"), F.count("exp").alias("valid"), F.count_if(F.col("years") <= 80).alias("short"))
    g = g.withColumn("percent", F.round(F.try_divide(F.col("short") * 100.0, F.col("valid")), 6))
    # one row per district
    return g.withColumn("rank", F.row_number().over(Window.orderBy(F.desc_nulls_last("percent"), "code")).cast("long"))


@add("agg_district_years", _LOCATED + "SELECT code, CASE WHEN years IS NOT NULL THEN CAST(least(floor(years), 999) AS BIGINT) END AS years_left, count(*) AS n FROM located GROUP BY 1, 2")
def agg_district_years(spark, d):
    """Whole years left, 999 at most; unknown years are a group of their own."""
    left = F.when(F.col("years").isNotNull(), F.least(F.floor("years"), F.lit(999)).cast("long"))
    return _located(spark, d).groupBy("code", left.alias("years_left")).agg(F.count("*").alias("n"))


@add("agg_region_totals", _LOCATED + "SELECT substr(code, 1, 4) AS region, count(*) AS n, round(avg(years), 4) AS avg_years FROM located WHERE code LIKE 'Z%' GROUP BY 1")
def agg_region_totals(spark, d):
    return _located(spark, d).filter(F.col("code").startswith("Z")).groupBy(F.substring("code", 1, 4).alias("region")).agg(F.count("*").alias("n"), F.round(F.avg("years"), 4).alias("avg_years"))


@add("agg_code_subset", _LOCATED + "SELECT code LIKE 'ZD06%' AS inside, count(*) AS n, count(DISTINCT code) AS n_districts FROM located WHERE code LIKE 'Z%' GROUP BY 1")
def agg_code_subset(spark, d):
    """Records in the districts whose code begins so, against all others."""
    inside = F.col("code").startswith("ZD06").alias("inside")
    return _located(spark, d).filter(F.col("code").startswith("Z")).groupBy(inside).agg(F.count("*").alias("n"), F.countDistinct("code").alias("n_districts"))


_CENTROIDS = P2_CTE + """
, cr AS (SELECT lad_code, row_number() OVER () AS ring, r FROM (SELECT lad_code, rings[1] AS r FROM polys)),
holes AS (SELECT lad_code, unnest(rings[2:]) AS r FROM polys),
rr AS (SELECT lad_code, 1 AS sign, CAST(r AS DOUBLE[][]) AS v FROM cr UNION ALL SELECT lad_code, -1, CAST(r AS DOUBLE[][]) FROM holes),
ee AS (SELECT lad_code, sign, k, v[1][1] AS ox, v[1][2] AS oy, v[i][1] - v[1][1] AS x1, v[i][2] - v[1][2] AS y1, v[i % len(v) + 1][1] - v[1][1] AS x2, v[i % len(v) + 1][2] - v[1][2] AS y2 FROM (SELECT *, row_number() OVER () AS k FROM rr) q, unnest(range(1, len(v) + 1)) AS u(i)),
ringsum AS (SELECT lad_code, sign, k, any_value(ox) AS ox, any_value(oy) AS oy, sum(x1 * y2 - x2 * y1) / 2 AS a, sum((x1 + x2) * (x1 * y2 - x2 * y1)) / 6 AS sx, sum((y1 + y2) * (x1 * y2 - x2 * y1)) / 6 AS sy FROM ee GROUP BY ALL)
SELECT lad_code AS code, round(sum(sign * sign(a) * (sx + ox * a)) / sum(sign * abs(a)), 6) AS lon, round(sum(sign * sign(a) * (sy + oy * a)) / sum(sign * abs(a)), 6) AS lat FROM ringsum GROUP BY 1
"""


@add("geo_centroids", _CENTROIDS)
def geo_centroids(spark, d):
    """Centroids of the districts, holes excepted."""
    return regions.with_points(_t(spark, d, "districts"), "lad_code").select("code", F.round("centre_lon", 6).alias("lon"), F.round("centre_lat", 6).alias("lat"))


@add("geo_inner_points", P2_CTE + "SELECT lad_code AS code, true AS held FROM districts WHERE geometry IS NOT NULL")
def geo_inner_points(spark, d):
    """The representative point of every district lies in it and in no other."""
    p = regions.with_points(_t(spark, d, "districts"), "lad_code").select(F.col("code").alias("_id"), F.col("inner_lon").alias("lon"), F.col("inner_lat").alias("lat"), F.lit(None).cast("struct<type:string,coordinates:array<double>>").alias("loc"))
    return containing_regions(p, _t(spark, d, "districts"), "lad_code").groupBy(F.col("id").alias("code")).agg((F.collect_set("region") == F.array("code")).alias("held"))


def _strips(spark):
    """Three larger areas with gaps between and around them."""
    box = lambda a, b: f'{{"type": "Polygon", "coordinates": [[[{a}, 49.5], [{b}, 49.5], [{b}, 60.5], [{a}, 60.5], [{a}, 49.5]]]}}'
    return spark.createDataFrame([("west", box(-7.5, -4.4)), ("middle", box(-4.2, -2.1)), ("east", box(-1.9, 1.5))], "region string, geometry string")


@add("join_district_region")
def join_district_region(spark, d):
    """Each district with its region by representative point, centroid or nearness (brute force in the tests)."""
    return regions.regions_of(_t(spark, d, "districts"), _strips(spark), "lad_code", "region")


@add("join_merged_geometry", _LOCATED + "SELECT lad_code, lad_name, geometry, coalesce(n, 0) AS n FROM districts LEFT JOIN (SELECT code, count(*) AS n FROM located GROUP BY 1) c ON c.code = lad_code")
def join_merged_geometry(spark, d):
    """Every district's geometry with its result, zero where it has none."""
    n = _located(spark, d).groupBy("code").agg(F.count("*").alias("n"))
    return _t(spark, d, "districts").join(n, F.col("lad_code") == F.col("code"), "left").select("lad_code", "lad_name", "geometry", F.coalesce("n", F.lit(0)).alias("n"))


@add("agg_top_districts", _LOCATED + "SELECT code, count(*) AS n FROM located WHERE code LIKE 'Z%' GROUP BY 1 ORDER BY n DESC, code LIMIT 5")
def agg_top_districts(spark, d):
    return _located(spark, d).filter(F.col("code").startswith("Z")).groupBy("code").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "code").limit(5)


@add("agg_bottom_districts", _LOCATED + "SELECT code, count(*) AS n FROM located WHERE code LIKE 'Z%' GROUP BY 1 ORDER BY n, code LIMIT 20")
def agg_bottom_districts(spark, d):
    return _located(spark, d).filter(F.col("code").startswith("Z")).groupBy("code").agg(F.count("*").alias("n")).orderBy("n", "code").limit(20)


@add("agg_expiring_soon", _LOCATED + "SELECT code, count(*) AS n, rank() OVER (ORDER BY count(*) DESC) AS rank FROM located WHERE code LIKE 'Z%' AND years BETWEEN 0 AND 50 GROUP BY 1")
def agg_expiring_soon(spark, d):
    g = _located(spark, d).filter(F.col("code").startswith("Z") & F.col("years").between(0, 50)).groupBy("code").agg(F.count("*").alias("n"))
    return g.withColumn("rank", F.rank().over(Window.orderBy(F.desc("n"))).cast("long"))


@add("agg_demand_by_district", _LOCATED + f", {_VIEWS} SELECT code, sum(views) AS views, count(*) AS n, round(avg(views), 4) AS average FROM located JOIN v USING (uid) WHERE years < 80 AND code LIKE 'Z%' GROUP BY 1")
def agg_demand_by_district(spark, d):
    v = _views(spark, d)
    j = _located(spark, d).join(v, "uid").filter((F.col("years") < 80) & F.col("code").startswith("Z"))
    return j.groupBy("code").agg(F.sum("views").alias("views"), F.count("*").alias("n"), F.round(F.avg("views"), 4).alias("average"))


@add("agg_district_summary", _LOCATED + "SELECT round(avg(n), 4) AS mean, median(n) AS median, round(stddev_samp(n), 4) AS std, min(n) AS low, max(n) AS high FROM (SELECT count(*) AS n FROM located WHERE code LIKE 'Z%' GROUP BY code)")
def agg_district_summary(spark, d):
    n = agg_district_counts(spark, d).filter(F.col("code").startswith("Z"))
    return n.agg(F.round(F.avg("n"), 4).alias("mean"), F.median("n").alias("median"), F.round(F.stddev_samp("n"), 4).alias("std"), F.min("n").alias("low"), F.max("n").alias("high"))


_VIEWED = f"WITH {_EXT}, {_VIEWS}, viewed AS (SELECT ext._id, uid, views, {_YEARS} AS years FROM ext JOIN v USING (uid))"
_CATEGORY = "CASE WHEN years < 70 THEN '<70' WHEN years < 80 THEN '70-80' WHEN years < 90 THEN '80-90' WHEN years < 100 THEN '90-100' ELSE '100+' END"


@add("agg_views_by_category", _VIEWED + f" SELECT {_CATEGORY} AS category, count(views) AS n, sum(views) AS total, round(avg(views), 2) AS mean, round(median(views), 2) AS median, round(stddev_samp(views), 2) AS std FROM viewed WHERE years IS NOT NULL GROUP BY 1")
def agg_views_by_category(spark, d):
    v = _viewed(spark, d).filter("years IS NOT NULL").groupBy(dates.term_category(F.col("years")).alias("category"))
    return v.agg(F.count("views").alias("n"), F.sum("views").alias("total"), F.round(F.avg("views"), 2).alias("mean"), F.round(F.median("views"), 2).alias("median"), F.round(F.stddev_samp("views"), 2).alias("std"))


@add("agg_mean_by_fixed_category", _VIEWED + f", c AS (SELECT * FROM (VALUES (1, '<70'), (2, '70-80'), (3, '80-90'), (4, '90-100'), (5, '100+'), (6, 'none')) x(k, category)) SELECT k, c.category, round(avg(views), 4) AS mean FROM c LEFT JOIN viewed ON years IS NOT NULL AND {_CATEGORY} = c.category GROUP BY 1, 2")
def agg_mean_by_fixed_category(spark, d):
    c = spark.createDataFrame([(k, x) for k, x in enumerate(("<70", "70-80", "80-90", "90-100", "100+", "none"), 1)], "k int, category string")
    v = _viewed(spark, d).filter("years IS NOT NULL").withColumn("category", dates.term_category(F.col("years")))
    return c.join(v.groupBy("category").agg(F.round(F.avg("views"), 4).alias("mean")), "category", "left")


@add("agg_views_by_decade", _VIEWED + " SELECT CAST(floor(years / 10) AS BIGINT) AS decade, round(avg(views), 4) AS mean, count(views) AS n FROM viewed WHERE years >= 0 AND years < 190 GROUP BY 1 HAVING count(views) >= 10")
def agg_views_by_decade(spark, d):
    v = _viewed(spark, d).filter("years >= 0 AND years < 190").groupBy(F.floor(F.col("years") / 10).alias("decade"))
    return v.agg(F.round(F.avg("views"), 4).alias("mean"), F.count("views").alias("n")).filter("n >= 10")


@add("agg_pearson", _VIEWED + " SELECT round(corr(years, views), 6) AS r, count(*) AS n FROM viewed WHERE years IS NOT NULL AND views IS NOT NULL")
def agg_pearson(spark, d):
    return _viewed(spark, d).filter("years IS NOT NULL AND views IS NOT NULL").agg(F.round(F.corr("years", "views"), 6).alias("r"), F.count("*").alias("n"))


_RANKED = "ranked AS (SELECT views, years, rank() OVER (ORDER BY views) + (count(*) OVER (PARTITION BY views) - 1) / 2 AS rv, rank() OVER (ORDER BY years) + (count(*) OVER (PARTITION BY years) - 1) / 2 AS ry FROM viewed WHERE years IS NOT NULL AND views IS NOT NULL)"


@add("agg_spearman", _VIEWED + f", {_RANKED} SELECT round(corr(rv, ry), 6) AS rho, count(*) AS n FROM ranked")
def agg_spearman(spark, d):
    return analytics.spearman(_viewed(spark, d), "views", "years").select(F.round("rho", 6).alias("rho"), "n")


_GROUPS = "g AS (SELECT views, years >= 70 AND years < 90 AS near FROM viewed WHERE years IS NOT NULL AND views IS NOT NULL)"


@add("agg_t_test", _VIEWED + f", {_GROUPS}, m AS (SELECT count(*) FILTER (near) AS n1, count(*) FILTER (NOT near) AS n2, avg(views) FILTER (near) AS m1, avg(views) FILTER (NOT near) AS m2, var_samp(views) FILTER (near) AS v1, var_samp(views) FILTER (NOT near) AS v2 FROM g) SELECT n1, n2, round((m1 - m2) / sqrt(((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2) * (1.0 / n1 + 1.0 / n2)), 6) AS t, n1 + n2 - 2 AS df FROM m")
def agg_t_test(spark, d):
    v = _viewed(spark, d).filter("years IS NOT NULL")
    return analytics.two_sample_t(v, "views", dates.is_approaching(F.col("years"))).select("n1", "n2", F.round("t", 6).alias("t"), "df")  # p is checked in the tests


@add("agg_mann_whitney", _VIEWED + f", {_GROUPS}, k AS (SELECT near, rank() OVER (ORDER BY views) + (count(*) OVER (PARTITION BY views) - 1) / 2 AS r FROM g) SELECT count(*) FILTER (near) AS n1, count(*) FILTER (NOT near) AS n2, round(sum(r) FILTER (near) - count(*) FILTER (near) * (count(*) FILTER (near) + 1) / 2, 4) AS u, round((u - n1 * n2 / 2) / sqrt(n1 * n2 / 12.0 * ((n1 + n2 + 1) - (SELECT sum(pow(n, 3) - n) FROM (SELECT count(*) AS n FROM g GROUP BY views)) / ((n1 + n2) * (n1 + n2 - 1)))), 4) AS z FROM k")
def agg_mann_whitney(spark, d):
    v = _viewed(spark, d).filter("years IS NOT NULL")
    return analytics.mann_whitney(v, "views", dates.is_approaching(F.col("years"))).select("n1", "n2", F.round("u", 4).alias("u"), F.round("z", 4).alias("z"))


@add("agg_histogram", f"WITH {_EXT}, y AS (SELECT {_YEARS} AS v FROM ext WHERE exp IS NOT NULL), e AS (SELECT min(v) AS lo, max(v) AS hi FROM y) SELECT CAST(coalesce(least(floor((v - lo) * 30 / nullif(hi - lo, 0)), 29), 0) AS INTEGER) AS bin, count(*) AS n FROM y, e GROUP BY 1")
def agg_histogram(spark, d):
    return analytics.histogram(_ext(spark, d).filter("exp IS NOT NULL").select(dates.years_remaining(F.col("exp"), _ref()).alias("v")), "v", 30)


@add("agg_value_counts", "SELECT trim(cl) AS class, count(*) AS n FROM leasesext GROUP BY 1")
def agg_value_counts(spark, d):
    return _t(spark, d, "leasesext").groupBy(F.trim("cl").alias("class")).agg(F.count("*").alias("n"))


@add("agg_word_frequency", r"SELECT word, count(*) AS n FROM (SELECT unnest(string_split(lower(regexp_replace(trim(term), '\s+', ' ', 'g')), ' ')) AS word FROM leases WHERE term IS NOT NULL) WHERE word <> '' GROUP BY 1 ORDER BY n DESC, word LIMIT 20")
def agg_word_frequency(spark, d):
    w = _t(spark, d, "leases").filter("term IS NOT NULL").select(F.explode(F.split(F.lower(F.regexp_replace(F.trim("term"), r"\s+", " ")), " ")).alias("word"))
    return w.filter("word <> ''").groupBy("word").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "word").limit(20)


@add("agg_length_quantiles", "SELECT quantile_cont(length(term), 0.25) AS q25, median(length(term)) AS q50, quantile_cont(length(term), 0.75) AS q75, count(DISTINCT term) AS n_distinct FROM leases WHERE term IS NOT NULL")
def agg_length_quantiles(spark, d):
    n = F.length("term")
    return _t(spark, d, "leases").filter("term IS NOT NULL").agg(F.percentile(n, 0.25).alias("q25"), F.median(n).alias("q50"), F.percentile(n, 0.75).alias("q75"), F.countDistinct("term").alias("n_distinct"))


@add("agg_subset_share", f"WITH {_EXT} SELECT count(*) FILTER (apc LIKE 'QA1 %') AS n_subset, round(100.0 * count(*) FILTER (apc LIKE 'QA1 %' AND exp < DATE '2100-01-01') / nullif(count(exp) FILTER (apc LIKE 'QA1 %'), 0), 6) AS subset_percent, round(100.0 * count(*) FILTER (exp < DATE '2100-01-01') / count(exp), 6) AS whole_percent FROM ext")
def agg_subset_share(spark, d):
    inside, soon = F.coalesce(F.col("apc").startswith("QA1 "), F.lit(False)), F.col("exp") < F.lit("2100-01-01").cast("date")
    percent = lambda a, b: F.round(F.try_divide(F.count_if(a) * 100.0, F.count_if(b)), 6)
    return _ext(spark, d).agg(F.count_if(inside).alias("n_subset"), percent(inside & soon, inside & F.col("exp").isNotNull()).alias("subset_percent"), percent(soon, F.col("exp").isNotNull()).alias("whole_percent"))


@add("agg_sample", "SELECT DISTINCT _id FROM leases ORDER BY md5(_id), _id LIMIT 100")
def agg_sample(spark, d):
    return analytics.hashed_sample(_t(spark, d, "leases").select("_id").distinct(), "_id", 100)


@add("win_first_of_title", "SELECT uid, min(_id) AS first_id, count(DISTINCT _id) AS n FROM leases GROUP BY 1")
def win_first_of_title(spark, d):
    return _t(spark, d, "leases").groupBy("uid").agg(F.min("_id").alias("first_id"), F.countDistinct("_id").alias("n"))


@add("sort_nulls_last", f"WITH {_EXT} SELECT _id, exp FROM ext ORDER BY exp NULLS LAST, _id LIMIT 50")
def sort_nulls_last(spark, d):
    return _ext(spark, d).select("_id", "exp").orderBy(F.asc_nulls_last("exp"), "_id").limit(50)


# ---------------------------------------------------------------- set operations and change files

_FIRST = "f AS (SELECT DISTINCT ON (version, row_no) * FROM leasechanges ORDER BY version, row_no, received_at, change_id)"


def _deletes(spark, d):
    first = _t(spark, d, "leasechanges").withColumn("k", F.row_number().over(Window.partitionBy("version", "row_no").orderBy("received_at", "change_id"))).filter("k = 1").drop("k")
    return first


@add("dml_delete_candidates", f"WITH {_FIRST}, x AS (SELECT change_id AS delete_id, coalesce(trim(unique_identifier), '') AS uid, coalesce(trim(reg_order), '') AS ro, coalesce(trim(associated_property_description_id), '') AS apid FROM f WHERE upper(trim(change_indicator)) = 'D'), l AS (SELECT DISTINCT _id, uid, coalesce(CAST(ro AS VARCHAR), '') AS ro, coalesce(CAST(apid AS VARCHAR), '') AS apid FROM leases) SELECT delete_id, count(DISTINCT _id) AS n FROM x LEFT JOIN l USING (uid, ro, apid) GROUP BY 1")
def dml_delete_candidates(spark, d):
    x = delta.split_changes(_deletes(spark, d))[0].select(F.col("change_id").alias("delete_id"), text.text_value(F.col("unique_identifier")).alias("uid"), text.text_value(F.col("reg_order")).alias("ro"), text.text_value(F.col("associated_property_description_id")).alias("apid"))
    l = _t(spark, d, "leases").select("_id", "uid", text.text_value(F.col("ro")).alias("ro"), text.text_value(F.col("apid")).alias("apid")).distinct()
    return x.join(l, ["uid", "ro", "apid"], "left").groupBy("delete_id").agg(F.countDistinct("_id").alias("n"))


def _decisions(spark, d):
    x = delta.split_changes(_deletes(spark, d))[0]
    x = x.select(F.col("change_id").alias("delete_id"), "version", *[F.col(c).alias(k) for c, k in text.FIELDS.items()])
    return x, delta.delete_decisions(x, _leases(spark, d).select("_id", *delta.KEYS))


def _differences(a: str, b: str) -> str:
    return f"CASE WHEN {a} = {b} THEN 0 ELSE len(list_filter(range(1, greatest(length({a}), length({b})) + 1), lambda i: substr({a}, i, 1) <> substr({b}, i, 1))) END"


_LADDER = f"""
WITH {_FIRST}, {LEASES_CTE},
x AS (SELECT change_id AS delete_id, version, {", ".join(f"coalesce(trim({c}), '') AS {k}" for c, k in text.FIELDS.items())} FROM f WHERE upper(trim(change_indicator)) = 'D'),
l AS (SELECT _id AS lease_id, {", ".join(f"coalesce(trim(CAST({k} AS VARCHAR)), '') AS {k}" for k in text.FIELDS.values())} FROM lease),
pair AS (SELECT delete_id, lease_id, {" + ".join(_differences(f"x.{k}", f"l.{k}") for k in text.FIELDS.values())} AS distance FROM x JOIN l ON x.uid = l.uid AND x.ro = l.ro AND x.apid = l.apid),
seen AS (SELECT delete_id, count(DISTINCT lease_id) AS n, min(distance) AS nearest FROM pair GROUP BY 1),
told AS (SELECT x.delete_id, version, CASE WHEN n IS NULL THEN 'unknown' WHEN n = 1 THEN 'single' WHEN nearest = 0 THEN 'exact' WHEN nearest = 1 THEN 'near' ELSE 'ambiguous' END AS decision FROM x LEFT JOIN seen USING (delete_id)),
gone AS (SELECT DISTINCT delete_id, version, lease_id, decision FROM told LEFT JOIN pair USING (delete_id) WHERE decision = 'single' OR decision = 'exact' AND distance = 0 OR decision = 'near' AND distance = 1
  UNION ALL SELECT delete_id, version, NULL, decision FROM told WHERE decision IN ('unknown', 'ambiguous'))
"""


@add("dml_delete_ladder", _LADDER + "SELECT delete_id, lease_id, decision FROM gone")
def dml_delete_ladder(spark, d):
    """The decision of every deletion."""
    return _decisions(spark, d)[1]


@add(
    "dml_update_log",
    _LADDER + """, per AS (SELECT version, count(*) FILTER (upper(trim(change_indicator)) = 'A') AS added, count(*) FILTER (coalesce(upper(trim(change_indicator)), '') NOT IN ('A', 'D')) AS skipped FROM f GROUP BY 1)
SELECT version, added, skipped, coalesce(deleted, 0) AS deleted, coalesce(unknown, 0) AS unknown, coalesce(manual_review, 0) AS manual_review FROM per LEFT JOIN (
  SELECT version, count(DISTINCT lease_id) AS deleted, count(*) FILTER (decision = 'unknown') AS unknown, count(*) FILTER (decision = 'ambiguous') AS manual_review FROM gone GROUP BY 1) USING (version)""",
)
def dml_update_log(spark, d):
    x, told = _decisions(spark, d)
    return delta.update_log(_deletes(spark, d), told.join(x.select("delete_id", "version"), "delete_id"))


@add("dml_cascade_dry_run", "SELECT count(*) AS n_cascade FROM leasesext WHERE lid IN (SELECT lease_id FROM deletedids)")
def dml_cascade_dry_run(spark, d):
    return delta.cascade_delete(_t(spark, d, "leasesext"), _t(spark, d, "deletedids"))


@add("dml_cascade_apply", "SELECT _id, lid FROM leasesext WHERE lid IS NULL OR lid NOT IN (SELECT lease_id FROM deletedids)")
def dml_cascade_apply(spark, d):
    return delta.cascade_delete(_t(spark, d, "leasesext"), _t(spark, d, "deletedids"), dry_run=False).select("_id", "lid")


@add("dml_merge", "WITH b AS (SELECT _id, min(uid) AS uid FROM leases WHERE loaded_at < TIMESTAMP '2025-07-01' GROUP BY 1), i AS (SELECT _id, max(uid) AS uid FROM leases WHERE loaded_at >= TIMESTAMP '2025-06-01' GROUP BY 1) SELECT _id, uid FROM i UNION ALL SELECT _id, uid FROM b WHERE _id NOT IN (SELECT _id FROM i)")
def dml_merge(spark, d):
    l = _t(spark, d, "leases")
    base = l.filter("loaded_at < TIMESTAMP_NTZ '2025-07-01'").groupBy("_id").agg(F.min("uid").alias("uid"))
    new = l.filter("loaded_at >= TIMESTAMP_NTZ '2025-06-01'").groupBy("_id").agg(F.max("uid").alias("uid"))
    return delta.merge_on(base, new, "_id")


@add("dml_two_phase_ids", f"WITH {_EXT} SELECT DISTINCT _id AS ext_id, lid AS lease_id FROM ext WHERE ty < 21")
def dml_two_phase_ids(spark, d):
    return delta.short_term_ids(_ext(spark, d))


@add("dml_residential_wins", f"WITH {_EXT} SELECT uid, bool_and(coalesce(substr(upper(cl), 1, 1) IN ('R', 'X', 'P'), false)) AS kept, count(*) AS n FROM ext GROUP BY 1")
def dml_residential_wins(spark, d):
    """A title with any record that is not residential is deleted, whatever the order."""
    return _ext(spark, d).groupBy("uid").agg(F.bool_and(text.is_residential(F.col("cl"))).alias("kept"), F.count("*").alias("n"))


@add("dml_insert_ids", f"WITH {_FIRST} SELECT substr(sha1(concat_ws('|', version, CAST(row_no AS VARCHAR), nullif(trim(unique_identifier), ''))), 1, 24) AS _id, version, row_no FROM f WHERE upper(trim(change_indicator)) = 'A'")
def dml_insert_ids(spark, d):
    adds = text.mapped_rows(delta.split_changes(_deletes(spark, d))[1])
    return delta.inserted_ids(adds).select("_id", "version", "row_no")


@add("dml_trackers", "SELECT upper(trim(unique_identifier)) AS uid, max(version) AS last_updated FROM leasechanges WHERE upper(trim(change_indicator)) IN ('A', 'D') GROUP BY 1")
def dml_trackers(spark, d):
    deletes, adds = delta.split_changes(_t(spark, d, "leasechanges"))
    return deletes.unionAll(adds).groupBy(F.upper(F.trim("unique_identifier")).alias("uid")).agg(F.max("version").alias("last_updated"))


@add("set_uncached_postcodes", "SELECT DISTINCT upper(replace(trim(pc), ' ', '')) AS k FROM leases WHERE pc IS NOT NULL EXCEPT SELECT upper(replace(trim(postcode), ' ', '')) FROM ab_plus WHERE last_update_date < DATE '2010-01-01'")
def set_uncached_postcodes(spark, d):
    """Postcodes of leases that a cache of the gazetteer as it was at the end of 2009 lacks."""
    keys = lambda df, c: df.filter(F.col(c).isNotNull()).select(text.cache_key(F.col(c)).alias("k")).distinct()
    cached = _t(spark, d, "ab_plus").filter("last_update_date < DATE '2010-01-01'")
    return keys(_t(spark, d, "leases"), "pc").join(keys(cached, "postcode"), "k", "left_anti")
