"""References to records that do not exist.

Parents (live and deleted keys) and the distinct referenced keys are range-partitioned together on
(field, key). Inside each range the parents form one sorted array; the references come after them in
Arrow batches and are probed by vectorised binary search. Only misses leave the probe; they are then
joined back to the referencing records.

Scale. Both sides are reduced to distinct keys with map-side combine before the one range shuffle, so
a key that holds a third of all references is one row in it. A range holds a bounded share of the
distinct keys, because Spark cuts the ranges from a sample of them. When misses are joined back, keys
with `hot_refs` references or more are handled by a broadcast whose size is bounded by
rows / hot_refs; all others by a shuffle join that no longer holds a hot key.

Defined results. Null and blank references are no cases. Rows whose record id is null form one record
with a null id. A record whose time is null everywhere has a null period and is never late; a parent
whose time is null everywhere counts as present from the start. If repeated deliveries of one record
carry several failing keys for a field, the worst kind is given (missing, deleted, late). Empty tables
give no rows (or, for empty parents, every reference as missing). Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demesne.common import BLANK, cut, micros, parallelism

KINDS = ("ok", "late", "deleted", "missing")


def reference_key(c: Column | str) -> Column:
    """The bare id: lower case, no white space, without the notation it is wrapped in; blank gives NULL."""
    c = F.col(c) if isinstance(c, str) else c
    bare = F.lower(F.regexp_replace(c, f"{BLANK}+", ""))
    bare = F.regexp_replace(bare, r"^[^0-9a-z]*(?:(?:new)?(?:objectid|oid)[^0-9a-z]+)?", "")
    return F.nullif(F.regexp_replace(bare, r"[^0-9a-z]+$", ""), F.lit(""))


def _long(df: DataFrame, keep: list[str], fields: dict[str, str]) -> DataFrame:
    """One row per field and non-null key; fields maps the field's name to its column."""
    pairs = F.array(*[F.struct(F.lit(f).alias("ref_field"), F.col(c).alias("key")) for f, c in fields.items()])
    return df.select(*keep, F.inline(pairs)).filter(F.col("key").isNotNull())


def _probe(hot_refs: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        field, keys, firsts, lives = None, [], [], []
        arrays = None
        for batch in batches:
            for (f, is_ref), part in batch.groupby(["ref_field", "is_ref"], sort=False):
                if f != field:
                    field, keys, firsts, lives, arrays = f, [], [], [], None
                if not is_ref:
                    keys.append(part["key"].to_numpy(dtype=object))
                    firsts.append(part["at"].to_numpy(dtype=float))
                    lives.append(part["live"].to_numpy(dtype=bool))
                    arrays = None
                    continue
                if arrays is None:
                    arrays = tuple(np.concatenate(x) if x else np.empty(0, t) for x, t in ((keys, object), (firsts, float), (lives, bool)))
                key = part["key"].to_numpy(dtype=object)
                at = part["at"].to_numpy(dtype=float)
                spot = np.searchsorted(arrays[0], key) if len(arrays[0]) else np.zeros(len(key), int)
                inside = np.minimum(spot, max(len(arrays[0]) - 1, 0))
                found = (spot < len(arrays[0])) & (arrays[0][inside] == key) if len(arrays[0]) else np.zeros(len(key), bool)
                first = np.where(found, arrays[1][inside], np.nan) if len(arrays[0]) else np.full(len(key), np.nan)
                live = found & arrays[2][inside] if len(arrays[0]) else found
                kind = np.where(~found, 3, np.where(~live, 2, np.where(first > at, 1, 0)))
                out = (kind > 0) | (part["n_refs"].to_numpy() >= hot_refs)
                yield pd.DataFrame({"ref_field": f, "key": key[out], "kind_no": kind[out], "parent_at": pd.array(first[out], dtype="Float64").astype("Int64"), "n_refs": part["n_refs"].to_numpy()[out]})

    return run


def orphan_references(
    references: DataFrame,
    parents: dict[str, list[tuple[DataFrame, str]]],
    deleted: dict[str, list[tuple[DataFrame, str]]],
    id_column: str = "_id",
    time_column: str = "loaded_at",
    ranges: int | None = None,
    hot_refs: int = 100_000,
    most_hot: int = 20_000,
) -> DataFrame:
    """(record_id, ref_field, kind, first_at) for every record and failing field.

    parents and deleted give, for each reference field of `references`, the tables and columns that
    hold its live and its deleted keys; live tables have time_column. A key with `hot_refs` references or more,
    or so many more that there can be no more than `most_hot` such keys, is joined by broadcast.
    """
    spark = references.sparkSession
    hot_refs = max(hot_refs, references.count() * len(parents) // most_hot)
    fields = list(parents)
    narrow = references.select(F.col(id_column).alias("record_id"), micros(time_column).alias("at"), *[reference_key(f).alias(f"k_{i}") for i, f in enumerate(fields)])
    keyed = narrow.groupBy("record_id", *[f"k_{i}" for i in range(len(fields))]).agg(F.min("at").alias("at"))
    keyed = keyed.withColumn("first_at", F.min("at").over(Window.partitionBy("record_id")))
    refs = _long(keyed, ["record_id", "first_at"], {f: f"k_{i}" for i, f in enumerate(fields)}).dropDuplicates(["record_id", "ref_field", "key"])

    sides = []
    for live, groups in ((True, parents), (False, deleted)):
        for f, sources in groups.items():
            for df, column in sources:
                sides.append(df.select(F.lit(f).alias("ref_field"), reference_key(column).alias("key"), (micros(time_column) if live else F.lit(None).cast("long")).alias("at"), F.lit(live).alias("live")))
    held = sides[0]
    for side in sides[1:]:
        held = held.unionAll(side)
    held = held.filter(F.col("key").isNotNull()).groupBy("ref_field", "key").agg(F.min("at").alias("at"), F.max("live").alias("live"))
    held = held.select("ref_field", "key", F.lit(False).alias("is_ref"), "at", "live", F.lit(0).cast("long").alias("n_refs"))
    asked = refs.groupBy("ref_field", "key").agg(F.min("first_at").alias("at"), F.count("*").alias("n_refs"))
    asked = asked.select("ref_field", "key", F.lit(True).alias("is_ref"), "at", F.lit(False).alias("live"), "n_refs")

    ranged = held.unionAll(asked).repartitionByRange(ranges or parallelism(spark), "ref_field", "key").sortWithinPartitions("ref_field", "is_ref", "key")
    missed = cut(ranged.mapInPandas(_probe(hot_refs), "ref_field string, key string, kind_no int, parent_at long, n_refs long"))

    hot, cold = missed.filter(F.col("n_refs") >= hot_refs), missed.filter(F.col("n_refs") < hot_refs)
    tagged = refs.join(F.broadcast(hot), ["ref_field", "key"], "left")
    of_hot = tagged.filter(F.col("n_refs").isNotNull()).select("record_id", "first_at", "ref_field", "kind_no", "parent_at")
    of_cold = tagged.filter(F.col("n_refs").isNull()).select("record_id", "first_at", "ref_field", "key").join(cold, ["ref_field", "key"]).select("record_id", "first_at", "ref_field", "kind_no", "parent_at")
    failing = of_hot.unionAll(of_cold).filter((F.col("kind_no") > 1) | ((F.col("kind_no") == 1) & (F.col("parent_at") > F.col("first_at"))))
    worst = failing.groupBy("record_id", "ref_field").agg(F.max("kind_no").alias("kind_no"), F.min("first_at").alias("first_at"))
    return worst.select("record_id", "ref_field", F.element_at(F.array(*map(F.lit, KINDS)), F.col("kind_no") + 1).alias("kind"), F.timestamp_micros("first_at").alias("first_at"))


def orphan_report(found: DataFrame) -> DataFrame:
    """Failing references per field, kind and month."""
    return found.groupBy("ref_field", "kind", "period").agg(F.count("*").alias("n_records"))
