"""Gazetteer matching: property reference, then postcode, then town, each with ranked house-number rules."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demesne.functions.text import base_number


def expanded(gazetteer: DataFrame, id_column: str = "id") -> DataFrame:
    """The gazetteer with a row per number of a building range, and one with ST for ST. in the road; `origin` tells which."""
    base = gazetteer.withColumn("origin", F.lit("base"))
    low, high = (F.split_part("building_name", F.lit("-"), F.lit(k)).try_cast("int") for k in (1, 2))
    ranged = gazetteer.filter(F.col("building_name").rlike("^[0-9]+-[0-9]+$") & (low <= high))
    numbers = ranged.withColumn("building_number", F.explode(F.sequence(low, high))).withColumn("building_number", F.col("building_number").cast("string")).withColumn("building_name", F.lit(None).cast("string")).withColumn("origin", F.lit("range"))
    plain = gazetteer.filter(F.col("thoroughfare").contains("ST.")).withColumn("thoroughfare", F.replace("thoroughfare", F.lit("ST."), F.lit("ST"))).withColumn("origin", F.lit("st"))
    return reduce(DataFrame.unionByName, [base, numbers.select(base.columns), plain.select(base.columns)])


def unique_uprn(gazetteer: DataFrame) -> DataFrame:
    """One entry per uprn, the later one (with the highest id)."""
    g = gazetteer.filter("uprn IS NOT NULL")
    rest = [c for c in g.columns if c not in ("uprn", "id")]
    if not rest:
        return g.groupBy("uprn").agg(F.max("id").alias("id"))
    return g.groupBy("uprn").agg(F.max_by(F.struct(*g.columns), "id").alias("_g")).select("_g.*")


def route(uprn: Column, pc: Column, city: Column) -> Column:
    """The key by which a request is looked up first."""
    return F.when(uprn.isNotNull(), "uprn").when(pc.isNotNull(), "pc").when(city.isNotNull(), "city").otherwise("none")


def match_priority(number: Column, base: Column, g_number: Column, g_name: Column) -> Column:
    """1 exact number, 2 exact name, 3 number by base or prefix, 4 name by base or prefix; NULL is no match."""
    n, b, gn, gb = (F.upper(c) for c in (number, base, g_number, g_name))
    return F.when(gn == n, 1).when(gb == n, 2).when(gn.startswith(b), 3).when(gb.startswith(b), 4)


def matches(requests: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """(request_id, stage, gazetteer_id, uprn): the best entry of every request that finds one.

    requests: request_id, uprn, house_number, road, postcode, city. All three stages run in one pass:
    their candidates are united with the stage as rank, and one window takes the best. The joins are
    equi-joins on (road, postcode) and (road, town) with the number rules as residual condition.
    """
    g = gazetteer.select(F.col("id").alias("gazetteer_id"), F.col("uprn").alias("g_uprn"), "building_number", "building_name", F.upper("thoroughfare").alias("g_road"), F.upper("postcode").alias("g_pc"), F.upper("post_town").alias("g_town"))
    r = requests.select("request_id", "uprn", "house_number", base_number(F.col("house_number")).alias("base"), F.upper("road").alias("road"), F.upper("postcode").alias("pc"), F.upper("city").alias("city"))
    by_uprn = r.join(unique_uprn(gazetteer.select("uprn", "id")).select("uprn", F.col("id").alias("gazetteer_id")), "uprn").select("request_id", F.lit(1).alias("stage"), "gazetteer_id", F.col("uprn").alias("g_uprn"), F.lit(1).alias("priority"))
    rank = match_priority(F.col("house_number"), F.col("base"), F.col("building_number"), F.col("building_name"))

    def stage(number: int, mine: str, theirs: str) -> DataFrame:
        pairs = r.join(g, (F.col("road") == F.col("g_road")) & (F.col(mine) == F.col(theirs)) & rank.isNotNull())
        return pairs.select("request_id", F.lit(number).alias("stage"), "gazetteer_id", "g_uprn", rank.alias("priority"))

    found = by_uprn.unionAll(stage(2, "pc", "g_pc")).unionAll(stage(3, "city", "g_town"))
    best = F.row_number().over(Window.partitionBy("request_id").orderBy("stage", "priority", "gazetteer_id"))
    return found.withColumn("k", best).filter("k = 1").select("request_id", "stage", "gazetteer_id", F.col("g_uprn").alias("uprn"))


def propagated(requests: DataFrame, found: DataFrame) -> DataFrame:
    """(request_id, gazetteer_id, how): own matches, and for rows without one the first match of their title."""
    own = requests.join(found, "request_id").select("uid", "request_id", "gazetteer_id", F.lit("own").alias("how"))
    first = own.groupBy("uid").agg(F.min_by("gazetteer_id", "request_id").alias("gazetteer_id"))
    lacking = requests.join(found, "request_id", "left_anti").join(first, "uid").select("uid", "request_id", "gazetteer_id", F.lit("title").alias("how"))
    return own.unionAll(lacking).select("request_id", "gazetteer_id", "how")


def updated(df: DataFrame, updates: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """df with the non-null new values of its key laid over the old ones."""
    new = updates.select(key, *[F.col(c).alias(f"_new_{c}") for c in columns])
    return df.join(new, key, "left").select(*[F.coalesce(f"_new_{c}", c).alias(c) if c in columns else F.col(c) for c in df.columns])
