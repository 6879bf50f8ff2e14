"""Terms with their dates, the rule that reads them, and arithmetic against an independent reading of the rules."""

import datetime as dt
import random

import pytest
from dateutil.relativedelta import relativedelta

from demesne.functions.term import RULES, day_of, number_of, tenure_between, whole_years, with_parsed_term
from demesne.plans.term_cases import CASES



def test_every_rule_has_a_case():
    assert {c[2] for c in CASES} == {r.name for r in RULES}


def test_fixed_terms(spark):
    df = spark.createDataFrame([(t, d, r, s, e, float(y)) for t, d, r, s, e, y in CASES], "term string, dol string, rule string, s string, e string, y double")
    for x in with_parsed_term(df).collect():
        p = x["parsed"]
        assert (p["pattern"], str(p["start"]), str(p["expiry"]), p["tenure"]) == (x["rule"], x["s"], x["e"], x["y"]), x["term"]


def test_nothing_and_overflow(spark):
    df = spark.createDataFrame([("This is not a lease term", None), ("", None), (None, None), ("999 years", None), ("99 years from 31 February 1990", None)], "term string, dol string")
    assert all(x["parsed"] is None for x in with_parsed_term(df).collect())
    over = with_parsed_term(spark.createDataFrame([("10,000 years from 25 March 1926", None)], "term string, dol string")).first()["parsed"]
    assert over["status"] == "overflow" and over["expiry"] is None


def test_day_convention(spark):
    df = spark.createDataFrame([("999 from 27 April 2006", None)], "term string, dol string")
    assert str(with_parsed_term(df, day_convention="exclusive").first()["parsed"]["expiry"]) == "3005-04-27"


def test_extra_columns_with_clashing_names_stay(spark):
    df = spark.createDataFrame([("99 years from 24 June 1862", None, 7, "x")], "term string, dol string, start int, pattern string")
    row = with_parsed_term(df).first()
    assert row["start"] == 7 and row["pattern"] == "x" and row["parsed"]["tenure"] == 99


def _years(start, end):
    r = relativedelta(end, start)
    up = r.years + (1 if r.months == 11 and r.days >= 1 else 0)
    return max(up, relativedelta(end + dt.timedelta(days=30), start).years)


def test_tenure_against_plain_python(spark):
    rnd = random.Random(5)
    rows = []
    for _ in range(2000):
        a = dt.date(1800, 1, 1) + dt.timedelta(days=rnd.randrange(90_000))
        rows.append((a, a + dt.timedelta(days=rnd.randrange(1, 400_000))))
    rows += [(dt.date(2000, 2, 29), dt.date(2099, 2, 28)), (dt.date(2000, 1, 31), dt.date(2001, 2, 28)), (dt.date(2000, 1, 31), dt.date(2262, 12, 31))]
    df = spark.createDataFrame(rows, "a date, b date")
    from pyspark.sql import functions as F

    for x in df.select("a", "b", tenure_between(F.col("a"), F.col("b")).alias("y")).collect():
        assert x["y"] == _years(x["a"], x["b"]), x
    triple = lambda x: (x.year, x.month, x.day)
    for a, b in rows:
        assert whole_years(triple(a), triple(b)) == _years(a, b), (a, b)
        assert number_of(triple(a)) == (a - dt.date(1970, 1, 1)).days and day_of(number_of(triple(b))) == triple(b)


@pytest.mark.parametrize("text", ["5 1/0 years from 1 January 2000"])
def test_zero_denominator_runs_digits_together(spark, text):
    p = with_parsed_term(spark.createDataFrame([(text, None)], "term string, dol string")).first()["parsed"]
    assert p["tenure"] == 510
