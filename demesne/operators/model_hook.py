"""A pluggable text model for terms that the rules leave open.

The model is given as predict(list of prompts) -> list of outputs and runs once per Arrow batch; what it
says is parsed by expressions and accepted only if the result is valid. No weights come with this package.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demesne.functions.term import FEASTS, feast_date, repaired
from demesne.functions.validate import findings, is_valid

PROMPT = "parse lease: "


def parse_output(text: Column) -> Column:
    """struct(start, expiry, tenure): the first two dd/MM/yyyy, years from the rest; a missing third is derived."""
    dates = F.regexp_extract_all(text, F.lit(r"(\d{2}/\d{2}/\d{4})"))
    day = lambda i: F.try_to_date(F.try_element_at(dates, F.lit(i)), "dd/MM/yyyy")
    rest = F.regexp_replace(text, r"\d{2}/\d{2}/\d{4}", " ")
    years = F.regexp_extract(rest, r"(\d+)\s*years?", 1).try_cast("int")
    names = "|".join(FEASTS)
    feast = feast_date(F.regexp_extract(rest, rf"(?i)({names})", 1), F.regexp_extract(rest, rf"(?i)(?:{names})(?:\s+day)?\s+(\d{{4}})", 1))
    a, b = F.coalesce(day(1), feast), day(2)
    expiry = F.coalesce(b, F.add_months(a, years * 12))
    gap = F.months_between(expiry, a)
    tenure = F.coalesce(years, F.floor(gap / 12).cast("int") + F.when(F.floor(gap) % 12 >= 6, 1).otherwise(0))
    start = F.coalesce(a, F.add_months(expiry, -years * 12))
    return F.struct(start.alias("start"), expiry.alias("expiry"), tenure.cast("double").alias("tenure"))


def with_model(df: DataFrame, term: str, predict: Callable[[list[str]], list[str]], reference: Column, out: str = "model") -> DataFrame:
    """df with `out`: struct(start, expiry, tenure, valid) by the model."""
    keep = df.columns

    @F.pandas_udf("string")
    def answer(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for terms in batches:
            yield pd.Series(predict([PROMPT + repaired(t or "") for t in terms]), dtype=object)

    said = df.withColumn("_said", parse_output(answer(F.col(term))))
    ok = is_valid(findings(F.col("_said.start"), F.col("_said.expiry"), F.col("_said.tenure"), reference))
    return said.withColumn(out, F.struct("_said.start", "_said.expiry", "_said.tenure", ok.alias("valid"))).select(*keep, out)


@lru_cache(4)
def single(load: Callable[[], Callable[[list[str]], list[str]]]) -> Callable[[str], str]:
    """A reader of one term at a time: the model is loaded once, at the first; the term goes in as it is, without repairs."""
    predict = load()
    return lambda term: predict([PROMPT + term])[0] if term and term.strip() else ""
