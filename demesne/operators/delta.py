"""Applying a change file to the register: the delete ladder, cascades, upserts, audit."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demesne.functions.text import FIELDS, char_difference, text_value

KEYS = tuple(FIELDS.values())


def split_changes(changes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(deletions, additions) by the trimmed indicator in either case; other rows are dropped."""
    kind = F.upper(F.trim("change_indicator"))
    return changes.filter(kind == "D"), changes.filter(kind == "A")


def delete_decisions(deletes: DataFrame, leases: DataFrame, as_coded: bool = False) -> DataFrame:
    """(delete_id, lease_id, decision) for every deletion and each record it would delete; lease_id is NULL where none is.

    The ladder per deletion: no record of its title with equal reg order and property id (unknown); exactly
    one (single); records equal in all twelve fields (exact); records at character distance one (near,
    or, as_coded, only if all records' distances sum to one); else ambiguous.
    deletes: delete_id and the short keys; leases: _id and the short keys.
    """
    d = deletes.select("delete_id", *[text_value(F.col(k)).alias(k) for k in KEYS])
    r = leases.select(F.col("_id").alias("lease_id"), *[text_value(F.col(k)).alias(f"r_{k}") for k in KEYS])
    pairs = d.join(r, (F.col("uid") == F.col("r_uid")) & (F.col("ro") == F.col("r_ro")) & (F.col("apid") == F.col("r_apid")))
    distance = reduce(lambda a, b: a + b, [char_difference(F.col(k), F.col(f"r_{k}")) for k in KEYS])
    pairs = pairs.select("delete_id", "lease_id", distance.alias("distance"))
    seen = pairs.groupBy("delete_id").agg(F.countDistinct("lease_id").alias("n"), F.min("distance").alias("nearest"), F.sum("distance").alias("total"))
    near = (F.col("total") == 1) if as_coded else (F.col("nearest") == 1)
    decision = F.when(F.col("n").isNull(), "unknown").when(F.col("n") == 1, "single").when(F.col("nearest") == 0, "exact").when(near, "near").otherwise("ambiguous")
    told = d.select("delete_id").join(seen, "delete_id", "left").withColumn("decision", decision)
    hit = F.when(F.col("decision") == "exact", F.col("distance") == 0).when(F.col("decision") == "near", F.col("distance") == 1).otherwise(F.col("decision") == "single")
    gone = told.join(pairs, "delete_id").filter(hit).select("delete_id", "lease_id", "decision")
    return gone.unionAll(told.filter(F.col("decision").isin("unknown", "ambiguous")).select("delete_id", F.lit(None).cast("string").alias("lease_id"), "decision")).distinct()


def cascade_delete(ext: DataFrame, lease_ids: DataFrame, dry_run: bool = True) -> DataFrame:
    """Enriched records left after deleting those of the leases; on a dry run one row with their number."""
    ids = lease_ids.select(F.col("lease_id").alias("lid")).distinct()
    return ext.join(ids, "lid", "left_semi").agg(F.count("*").alias("n_cascade")) if dry_run else ext.join(ids, "lid", "left_anti")


def merge_on(base: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Replace by key, insert if new."""
    return base.join(incoming.select(key), key, "left_anti").unionByName(incoming)


def keep_long_terms(ext: DataFrame, least: int = 21) -> DataFrame:
    """Without terms under `least` years; an unknown term stays."""
    return ext.filter(F.col("ty").isNull() | (F.col("ty") >= least))


def short_term_ids(ext: DataFrame, least: int = 21) -> DataFrame:
    """The pairs (ext_id, lease_id) of the first phase of a two-phase delete."""
    return ext.filter(F.col("ty") < least).select(F.col("_id").alias("ext_id"), F.col("lid").alias("lease_id")).distinct()


def inserted_ids(adds: DataFrame, version: str = "version", row: str = "row_no") -> DataFrame:
    """Additions with ids derived from their business key, so that a retry makes the same ids."""
    made = F.substring(F.sha1(F.concat_ws("|", F.col(version), F.col(row).cast("string"), "uid")), 1, 24)
    return adds.withColumn("_id", made)


def update_log(changes: DataFrame, decisions: DataFrame) -> DataFrame:
    """One audit row per version: additions, distinct records deleted, unknown and ambiguous deletions."""
    kind = F.upper(F.trim("change_indicator"))
    per = changes.groupBy("version").agg(F.count_if(kind == "A").alias("added"), F.count_if(~F.coalesce(kind, F.lit("")).isin("A", "D")).alias("skipped"))
    of = decisions.groupBy("version").agg(F.countDistinct(F.when(F.col("decision").isin("single", "exact", "near"), F.col("lease_id"))).alias("deleted"), F.count_if(F.col("decision") == "unknown").alias("unknown"), F.count_if(F.col("decision") == "ambiguous").alias("manual_review"))
    return per.join(of, "version", "left").na.fill(0, ["deleted", "unknown", "manual_review"])


def encoded_pairs(pairs: DataFrame) -> DataFrame:
    """The id pairs as one JSON text a row, for a log that people read."""
    return pairs.select(F.to_json(F.struct("ext_id", "lease_id"), {"ignoreNullFields": "false"}).alias("pair"))


def decoded_pairs(lines: DataFrame) -> DataFrame:
    return lines.select(F.from_json("pair", "ext_id string, lease_id string").alias("p")).select("p.*")


def _done(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def resumable_delete(ext: DataFrame, leases: DataFrame, pairs: DataFrame, folder: str) -> dict[str, str]:
    """Delete the records of the pairs, enriched ones before leases, in steps that a second run does not repeat.

    The steps are tables in `folder`, which all executors share: the pairs, the enriched records left, the leases left.
    A step is done once its table is complete; a run that was cut off goes on with the first that is not, from
    the pairs as they were first found. Nothing is overwritten: the caller swaps the tables in when all are there.
    """
    spark = ext.sparkSession
    at = {k: f"{folder.rstrip('/')}/{k}" for k in ("pairs", "ext", "leases")}
    if not _done(spark, at["pairs"]):
        encoded_pairs(pairs).write.mode("overwrite").text(at["pairs"])
    ids = decoded_pairs(spark.read.text(at["pairs"]).withColumnRenamed("value", "pair"))
    for k, df, mine, theirs in (("ext", ext, "_id", "ext_id"), ("leases", leases, "_id", "lease_id")):
        if not _done(spark, at[k]):
            df.join(ids.select(F.col(theirs).alias(mine)).distinct(), mine, "left_anti").write.mode("overwrite").parquet(at[k])
    return at
