"""Queries of lease terms, each with the SQL it is checked against.

The SQL reads a term in its own way: what stands for dates and numbers is cut out of the text, and the
skeleton that is left is looked up in a table of the forms that the test tables hold. The forms they do not
hold are checked by a table of cases, at least one per rule, with results worked out by hand.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demesne.common import table
from demesne.functions.term import with_parsed_term
from demesne.functions.validate import findings, is_valid
from demesne.operators import analytics
from demesne.operators.model_hook import with_model
from demesne.plans.records import REFERENCE, ext, ref, EXT_CTE
from demesne.plans.registry import Registry
from demesne.plans.term_cases import CASES

REGISTRY = Registry()
add = REGISTRY.add

_FORMS = {
    "# years from D": "3a", "#years from D": "3a", "# years from and including D": "3a", "# years commencing on D": "3a", "# years (less # days) from D": "3a less",
    "from D to D": "2a", "beginning on and including D and ending on and including D": "2a", "from and including D for a term of years expiring on D": "2d",
    "# from D": "5b", "# years from and including D to and including D": "1", "# years expiring on D": "4d", "commencing on D for a term of # years": "4b", "# years from the date hereof": "6a",
}
_MONTHS = "january february march april may june july august september october november december".split()
_DATE = r"(\d{1,2})[ ./]+([a-z]+|\d{1,2})[ ./]+(\d{4})"
_DOL = r"^(\d{1,2})([-/.])(\d{1,2})([-/.])(\d{4})$"


def _day(text: str) -> str:
    """A date written d month year; a 31st of a month of thirty days, if the month has no leading zero, is the 30th."""
    d, m, y = (f"regexp_extract({text}, '{_DATE}', {k})" for k in (1, 2, 3))
    return f"(SELECT try_cast({y} || '-' || mm.k || '-' || CASE WHEN {d} = '31' AND mm.k IN (4, 6, 9, 11) AND {m} NOT LIKE '0%' THEN '30' ELSE {d} END AS DATE) FROM months mm WHERE mm.m = {m})"


#: t(term, dol, start, expiry, tenure, pattern, status): one row per distinct pair that says something.
PARSED_CTE = rf"""
months AS (SELECT unnest([{", ".join(f"'{m}'" for m in _MONTHS)}]) AS m, unnest(range(1, 13)) AS k
  UNION ALL SELECT unnest([{", ".join(f"'{m[:3]}'" for m in _MONTHS if m != "may")}]), unnest([{", ".join(str(k) for k, m in enumerate(_MONTHS, 1) if m != "may")}])
  UNION ALL SELECT * FROM (VALUES ('januaryu', 1), ('jnuary', 1), ('feburary', 2), ('febuary', 2), ('septmber', 9), ('novmber', 11), ('decmber', 12)) typos(m, k)
  UNION ALL SELECT CAST(k AS VARCHAR), k FROM range(1, 13) r(k) UNION ALL SELECT '0' || k, k FROM range(1, 10) r(k)),
forms AS (SELECT * FROM (VALUES {", ".join(f"('{a}', '{b}')" for a, b in _FORMS.items())}) f(form, rule)),
t0 AS (SELECT DISTINCT term, dol FROM leases WHERE term IS NOT NULL),
t1 AS (SELECT term, dol, regexp_replace(replace(lower(trim(regexp_replace(term, '\s+', ' ', 'g'))), ',', ''), '\b(\d{{1,2}})(st|nd|rd|th)\b', '\1', 'g') AS n FROM t0),
t2 AS (SELECT *, regexp_extract_all(n, '{_DATE}') AS ds, regexp_replace(n, '{_DATE}', 'D', 'g') AS cutout,
  try_cast(regexp_extract(trim(dol), '{_DOL}', 5) || '-' || regexp_extract(trim(dol), '{_DOL}', 3) || '-' || regexp_extract(trim(dol), '{_DOL}', 1) AS DATE) AS dol_day FROM t1),
t3 AS (SELECT *, regexp_replace(cutout, '\d+', '#', 'g') AS form, regexp_extract_all(cutout, '\d+') AS ns FROM t2),
t4 AS (SELECT term, dol, rule, CASE WHEN rule = '6a' THEN dol_day ELSE {_day("ds[1]")} END AS d1, {_day("ds[2]")} AS d2, CAST(ns[1] AS INTEGER) AS n1, coalesce(CAST(ns[2] AS INTEGER), 0) AS n2 FROM t3 JOIN forms USING (form)),
t5 AS (SELECT *, CASE WHEN rule = '1' AND d2 IS NULL THEN '3a' WHEN rule = '3a less' THEN '3a' ELSE rule END AS pattern FROM t4 WHERE d1 IS NOT NULL AND (d2 IS NOT NULL OR rule NOT IN ('2a', '2d'))),
t6 AS (SELECT term, dol, pattern, n1,
  CASE WHEN pattern = '4d' THEN CAST(d1 - to_years(n1) AS DATE) ELSE d1 END AS s,
  CASE WHEN pattern IN ('1', '2a', '2d') THEN d2 WHEN pattern = '4d' THEN d1 WHEN pattern = '3a' THEN CAST(d1 + to_years(n1) - to_days(n2) AS DATE) ELSE CAST(d1 + to_years(n1) - to_days(1) AS DATE) END AS e FROM t5),
t7 AS (SELECT *, year(e) > 9999 OR year(s) < 1 AS over,
  CASE WHEN pattern IN ('2a', '2d') THEN CAST(greatest(date_sub('year', s, CAST(e + INTERVAL 30 DAY AS DATE)), date_sub('year', s, e)) AS DOUBLE) ELSE CAST(n1 AS DOUBLE) END AS years FROM t6 WHERE pattern IN ('2a', '2d') OR n1 > 0),
t AS (SELECT term, dol, CASE WHEN NOT over THEN s END AS start, CASE WHEN NOT over THEN e END AS expiry, CASE WHEN NOT over THEN years END AS tenure, pattern, CASE WHEN over THEN 'overflow' ELSE 'parsed' END AS status FROM t7)
"""


def codes_sql(start: str, expiry: str, tenure: str) -> str:
    """The findings about a term, joined by commas; a tenure beyond what a date can hold is compared as a million years."""
    years = f"CAST(floor(greatest(least({tenure}, 1000000), -1000000)) AS INTEGER)"
    return f"""CASE WHEN {start} IS NULL AND {expiry} IS NULL AND {tenure} IS NULL THEN 'NULL_DATA' WHEN {start} IS NULL OR {expiry} IS NULL OR {tenure} IS NULL THEN 'INVALID_TYPE'
  ELSE concat_ws(',', CASE WHEN {start} >= {expiry} THEN 'INVALID_DATE_ORDER' END, CASE WHEN {tenure} <= 0 THEN 'INVALID_TENURE' END,
  CASE WHEN abs(date_diff('day', CAST({start} + to_years({years}) AS DATE), {expiry})) > 10 THEN 'TENURE_MISMATCH' END, CASE WHEN {start} > DATE '{REFERENCE}' THEN 'FUTURE_START_DATE' END,
  CASE WHEN {start} < DATE '1800-01-01' THEN 'UNREASONABLE_START_DATE' END, CASE WHEN {tenure} > 1000 THEN 'EXCESSIVE_TENURE' END, CASE WHEN {expiry} < DATE '{REFERENCE}' THEN 'LEASE_EXPIRED' END) END"""


_ALL = f"""WITH {PARSED_CTE},
p AS (SELECT l._id, t.start, t.expiry, t.tenure, t.pattern, t.status, {codes_sql("t.start", "t.expiry", "t.tenure")} AS codes FROM leases l LEFT JOIN t ON l.term = t.term AND l.dol IS NOT DISTINCT FROM t.dol),
q AS (SELECT *, codes NOT SIMILAR TO '.*(NULL_DATA|INVALID_TYPE|INVALID_DATE_ORDER|INVALID_TENURE).*' AS valid FROM p)
"""


@add("term_parsed", _ALL + "SELECT _id, start, expiry, tenure, pattern, status, valid, codes FROM q")
def term_parsed(spark: SparkSession, d: str) -> DataFrame:
    """Every lease's term with its dates, the rule that read it, and what validation finds."""
    p = with_parsed_term(table(spark, d, "leases").select("_id", "term", "dol"))
    p = p.withColumn("findings", findings(F.col("parsed.start"), F.col("parsed.expiry"), F.col("parsed.tenure"), ref()))
    return p.select("_id", "parsed.*", is_valid(F.col("findings")).alias("valid"), F.array_join("findings.code", ",").alias("codes"))


def _by_rule(rule: str):
    def query(spark: SparkSession, d: str) -> DataFrame:
        pairs = table(spark, d, "leases").select("term", "dol").distinct()
        return with_parsed_term(pairs).filter(F.col("parsed.pattern") == rule).select("term", "dol", "parsed.start", "parsed.expiry", "parsed.tenure", "parsed.status")

    return query


for _name, _rule in {"term_years_from_date": "3a", "term_commencing": "4b", "term_expiring": "4d", "term_date_range": "2a", "term_stated": "1", "term_years_expiring": "2d", "term_bare_number": "5b", "term_from_date_of_lease": "6a"}.items():
    add(_name, f"WITH {PARSED_CTE} SELECT term, dol, start, expiry, tenure, status FROM t WHERE pattern = '{_rule}'")(_by_rule(_rule))


def _literal(x: object) -> str:
    return "NULL" if x is None else "'" + str(x).replace("'", "''") + "'"


@add("term_cases", "SELECT term, dol, pattern, CAST(start AS DATE) AS start, CAST(expiry AS DATE) AS expiry, CAST(tenure AS DOUBLE) AS tenure FROM (VALUES " + ", ".join(f"({', '.join(map(_literal, c))})" for c in CASES) + ") c(term, dol, pattern, start, expiry, tenure)")
def term_cases(spark: SparkSession, d: str) -> DataFrame:
    """The table of cases, read by the cascade; the SQL holds the results worked out by hand."""
    df = spark.createDataFrame([c[:2] for c in CASES], "term string, dol string")
    return with_parsed_term(df).select("term", "dol", "parsed.pattern", "parsed.start", "parsed.expiry", "parsed.tenure")


@add("term_run_statistics", _ALL + "SELECT outcome, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM q), 4) AS percent FROM (SELECT CASE WHEN status = 'overflow' THEN 'error' WHEN valid THEN 'valid' ELSE 'invalid' END AS outcome FROM q) GROUP BY 1")
def term_run_statistics(spark: SparkSession, d: str) -> DataFrame:
    p = term_parsed(spark, d).select(F.when(F.col("status") == "overflow", "error").when(F.col("valid"), "valid").otherwise("invalid").alias("outcome"))
    n = p.groupBy("outcome").agg(F.count("*").alias("n"))  # three rows
    total = n.agg(F.sum("n").alias("total"))
    return n.crossJoin(F.broadcast(total)).select("outcome", "n", F.round(analytics.share(F.col("n"), F.col("total")), 4).alias("percent"))


def _first_years(prompts: list[str]) -> list[str]:
    """Stands in for a model: the first number of years and the first year it sees."""
    out = []
    for x in prompts:
        years, dated = re.findall(r"(\d{2,3})\s*y", x), re.search(r"(\d{4})", x)
        out.append(f"01/01/{dated.group(1)} {years[0]} years" if dated and years else "Not specified")
    return out


@add("term_model_residue")
def term_model_residue(spark: SparkSession, d: str) -> DataFrame:
    """Terms the rules leave open, through the model hook with a stand-in (its output is checked in the tests)."""
    p = with_parsed_term(table(spark, d, "leases").select("_id", "term", "dol")).filter("parsed IS NULL AND trim(term) <> ''")
    return with_model(p.select("_id", "term"), "term", _first_years, ref()).select("_id", "model.*")


@add(
    "agg_field_accuracy",
    _ALL + f", {EXT_CTE}, one AS (SELECT l._id AS lid, t.* FROM (SELECT _id, arg_min(term, (loaded_at, coalesce(term, ''), coalesce(dol, ''))) AS term, arg_min(dol, (loaded_at, coalesce(term, ''), coalesce(dol, ''))) AS dol FROM leases GROUP BY 1) l JOIN t ON l.term = t.term AND l.dol IS NOT DISTINCT FROM t.dol)"
    " SELECT count(*) AS n, round(avg(CAST(st = start AS INTEGER)), 6) AS start_accuracy, round(avg(CAST(exp = expiry AS INTEGER)), 6) AS expiry_accuracy, round(avg(CAST(ty = tenure AS INTEGER)), 6) AS tenure_accuracy FROM ext JOIN one USING (lid)",
)
def agg_field_accuracy(spark: SparkSession, d: str) -> DataFrame:
    """How often the term read from a lease equals the enriched record's dates and tenure."""
    first = F.struct("loaded_at", F.coalesce("term", F.lit("")), F.coalesce("dol", F.lit("")))
    one = table(spark, d, "leases").groupBy(F.col("_id").alias("lid")).agg(F.min_by(F.struct("term", "dol"), first).alias("x")).select("lid", "x.term", "x.dol")
    p = with_parsed_term(one).filter("parsed IS NOT NULL").select("lid", "parsed")
    j = ext(spark, d).join(p, "lid")
    return j.agg(F.count("*").alias("n"), *[F.round(F.avg((F.col(a) == F.col(f"parsed.{b}")).cast("double")), 6).alias(f"{b}_accuracy") for a, b in (("st", "start"), ("exp", "expiry"), ("ty", "tenure"))])
