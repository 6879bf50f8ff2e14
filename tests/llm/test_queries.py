"""The registered corpus queries hold what they must, over the whole smallest tables."""

import math

from pyspark.sql import functions as F

from demesne.llm.queries import REGISTRY

QUERIES = REGISTRY.queries


def test_every_query_is_checked_here():
    assert set(QUERIES) == {"p3_found", "p6_packed", "p6_fill_report", "p7_found", "p7_leak_report", "p8_found", "p8_identified"}


def test_links_are_of_leases_without_reference_to_known_premises(spark, sf):
    got = QUERIES["p3_found"](spark, sf)
    leases = spark.read.parquet(f"{sf}/leases.parquet").filter("uprn IS NULL")
    rows = got.collect()
    assert len(rows) == len(set(rows)) > 0
    assert got.join(leases, got["lease_id"] == leases["_id"], "left_anti").count() == 0
    assert got.join(spark.read.parquet(f"{sf}/ab_plus.parquet"), "uprn", "left_anti").count() == 0


def test_every_text_is_packed_whole(spark, sf):
    packed = QUERIES["p6_packed"](spark, sf)
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", F.coalesce(F.length("text"), F.lit(0)).alias("n"))
    pieces = packed.groupBy("doc_id").agg(F.sum(F.col("char_to") - F.col("char_from")).alias("n"))
    assert sorted(map(tuple, pieces.collect())) == sorted(map(tuple, docs.collect()))
    used = packed.groupBy("container").agg(F.sum("n_tokens").alias("used"), F.first("filled").alias("filled")).collect()
    assert all(r["used"] == r["filled"] <= 2048 for r in used)
    report, tokens = QUERIES["p6_fill_report"](spark, sf).first(), sum(r["used"] for r in used)
    assert report["n_containers"] == len(used) and report["n_tokens"] == tokens and report["least_containers"] == math.ceil(tokens / 2048)
    assert len(used) <= report["least_containers"] + 1 and report["attended_share"] < 1


def test_leak_report_counts_what_was_found(spark, sf):
    found = {}
    for r in QUERIES["p7_found"](spark, sf).collect():
        found.setdefault(r["item_id"], set()).add(r["doc_id"])
    assert {r["item_id"]: r["n_docs"] for r in QUERIES["p7_leak_report"](spark, sf).collect()} == {k: len(v) for k, v in found.items()}


def test_corrections_are_of_identified_segments(spark, sf):
    told = {(r["doc_id"], r["seg_no"]): r for r in QUERIES["p8_identified"](spark, sf).collect()}
    got = QUERIES["p8_found"](spark, sf).collect()
    assert got and all(told[r["doc_id"], r["seg_no"]]["lang"] == r["lang"] for r in got)
    for r in got:
        if r["seg_no"] > 1:
            assert told[r["doc_id"], r["seg_no"] - 1]["lang"] != r["lang"]  # runs change language
