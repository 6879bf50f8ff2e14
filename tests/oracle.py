"""Runs a query and its SQL over the same tables and compares them without order."""

import glob
import math
import os

import duckdb


def _norm(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def text(v):
        if v is None or (isinstance(v, float) and math.isnan(v)):
            return "-"
        return repr(round(float(v), 9)) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)

    return [columns[i] for i in order], sorted(tuple(text(r[i]) for i in order) for r in rows)


def compare(spark, sf, query, sql):
    con = duckdb.connect()
    for f in glob.glob(f"{sf}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    df = query(spark, sf)
    told = con.execute(sql)
    columns = [c[0] for c in told.description]
    assert _norm(df.columns, [tuple(r) for r in df.collect()]) == _norm(columns, told.fetchall())
