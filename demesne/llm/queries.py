"""Queries of the corpus problems."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demesne.common import table
from demesne.llm import addresses, contamination, language, packing
from demesne.plans.registry import Registry

REGISTRY = Registry()


@REGISTRY.add("p7_found")
def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination.leaked_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "evalitems"))
    return found.select("item_id", "doc_id").distinct()


@REGISTRY.add("p7_leak_report")
def p7_leak_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per item the number of documents that hold it and how well."""
    found = contamination.leaked_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "evalitems"))
    return found.groupBy("item_id").agg(F.countDistinct("doc_id").alias("n_docs"), F.round(F.max("covered"), 6).alias("most_covered"))


@REGISTRY.add("p8_found")
def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.corrections(language.identify(table(spark, sf_dir, "documents")))


@REGISTRY.add("p8_identified")
def p8_identified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and segment with its language and confidence."""
    return language.identify(table(spark, sf_dir, "documents")).withColumn("confidence", F.round("confidence", 6))


@REGISTRY.add("p6_packed")
def p6_packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"))


@REGISTRY.add("p6_fill_report")
def p6_fill_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.fill_report(packing.packed(table(spark, sf_dir, "documents")), 2048)


@REGISTRY.add("p3_found")
def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    leases = table(spark, sf_dir, "leases").filter("uprn IS NULL")
    return addresses.link(leases, table(spark, sf_dir, "ab_plus")).select("lease_id", "uprn").distinct()
