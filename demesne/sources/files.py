"""File sources and sinks: change files, archives, headerless gazetteers, boundaries, exports."""

from __future__ import annotations

import re
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Header of a change file and the names used here (fixed values).
CHANGE_HEADER = {
    "Change Indicator": "change_indicator", "Unique Identifier": "unique_identifier", "Register Property Description": "register_property_description", "County": "county", "Region": "region",
    "Associated Property Description ID": "associated_property_description_id", "Associated Property Description": "associated_property_description", "OS UPRN": "os_uprn", "Price Paid": "price_paid",
    "Reg Order": "reg_order", "Date of Lease": "date_of_lease", "Term": "term", "Alienation Clause Indicator": "alienation_clause_indicator",
}
#: Column order of the headerless gazetteer with its types (fixed values).
GAZETTEER_SCHEMA = (
    "uprn bigint, os_address_toid string, udprn int, organisation_name string, department_name string, po_box_number string, sub_building_name string, building_name string, building_number string, "
    "dependent_thoroughfare string, thoroughfare string, post_town string, double_dependent_locality string, dependent_locality string, postcode string, postcode_type string, x_coordinate double, y_coordinate double, "
    "latitude double, longitude double, rpc int, country string, change_type string, la_start_date date, rm_start_date date, last_update_date date, class string"
)
_ROW_COUNT = re.compile(r'^"?Row Count:?"?,"?\d+"?', re.I)


def read_changes(spark: SparkSession, path: str) -> DataFrame:
    """A change file, all text, under snake-case names; the trailing row count and blank lines are dropped."""
    schema = ", ".join(f"`{c}` string" for c in CHANGE_HEADER)
    df = spark.read.csv(path, header=True, schema=schema, encoding="ISO-8859-1", quote='"', escape='"', multiLine=True)
    df = df.withColumnsRenamed(CHANGE_HEADER)
    return df.filter(~F.coalesce(F.col("change_indicator"), F.lit("")).rlike(r"(?i)^Row Count")).na.drop("all")


def clean_lines(lines: list[str]) -> list[str]:
    """The lines before a row count, without blank ones at the end."""
    kept = next((lines[:i] for i, line in enumerate(lines) if _ROW_COUNT.match(line)), list(lines))
    while kept and not kept[-1].strip():
        kept.pop()
    return kept


def unzip_changes(archive: str, folder: str) -> str:
    """The first CSV of an archive, as UTF-8 without its row count, in the folder."""
    with zipfile.ZipFile(archive) as z:
        name = next(n for n in z.namelist() if n.lower().endswith(".csv"))
        lines = z.read(name).decode("latin-1").splitlines()
    out = Path(folder, Path(name).name)
    out.write_text("\n".join(clean_lines(lines)) + "\n", encoding="utf-8")
    return str(out)


def find_update(listing: Callable[[], list[str]], applied: DataFrame) -> str | None:
    """The newest change-only file of an injected listing whose version was not applied yet."""
    found = sorted((m.group(0)[1:-4].replace("_", "-"), n) for n in listing() if (m := re.search(r"_\d{4}_\d{2}\.zip$", n)))
    if not found or applied.filter(F.col("version") == found[-1][0]).limit(1).count():
        return None
    return found[-1][1]


def read_gazetteer(spark: SparkSession, folder: str) -> DataFrame:
    """Headerless gazetteer files of a folder; an empty field is NULL."""
    return spark.read.schema(GAZETTEER_SCHEMA).csv(folder, header=False, nullValue="", dateFormat="yyyy-MM-dd", pathGlobFilter="*.csv")


def detect_keys(properties: list[str]) -> tuple[str | None, str | None]:
    """(code, name) property of a boundary file: LAD…CD and LAD…NM, else any that ends so."""

    def pick(end: str) -> str | None:
        return next((p for p in properties if re.match(rf"(?i)^lad\d*{end}$", p)), next((p for p in properties if p.lower().endswith(end)), None))

    return pick("cd"), pick("nm")


def read_boundaries(spark: SparkSession, path: str) -> DataFrame:
    """(code, name, geometry) of a GeoJSON feature collection; geometry is GeoJSON text."""
    features = spark.read.option("multiLine", True).json(path).select(F.explode("features").alias("f"))
    code, name = detect_keys(features.select("f.properties.*").columns)
    return features.select(F.col(f"f.properties.{code}").alias("code"), F.col(f"f.properties.{name}").alias("name"), F.to_json("f.geometry").alias("geometry"))


def export_csv(df: DataFrame, path: str, first: str = "uid") -> None:
    """One CSV with the first column in front, the others by name; nested values as JSON."""
    nested = {f.name for f in df.schema.fields if f.dataType.typeName() in ("struct", "array", "map")}
    order = [first, *sorted(c for c in df.columns if c != first)]
    df.select(*[F.to_json(c).alias(c) if c in nested else F.col(c) for c in order]).coalesce(1).write.mode("overwrite").csv(path, header=True)


def write_matches(found: DataFrame, missed: DataFrame, folder: str) -> None:
    """Append matches and misses to their CSV folders; every part has its header, so a folder reads as one table."""
    for df, name in ((found, "found"), (missed, "not_found")):
        df.write.mode("append").csv(f"{folder}/{name}", header=True)


def export_features(df: DataFrame, path: str, geometry: str = "geometry") -> None:
    """One GeoJSON feature a line: the geometry and every other column as a property."""
    properties = F.to_json(F.struct(*[c for c in df.columns if c != geometry]), {"ignoreNullFields": "false"})
    line = F.concat(F.lit('{"type":"Feature","properties":'), properties, F.lit(',"geometry":'), F.coalesce(geometry, F.lit("null")), F.lit("}"))
    df.select(line.alias("value")).write.mode("overwrite").text(path)


def find(df: DataFrame, condition: str = "true", limit: int | None = None) -> DataFrame:
    """Rows that meet a condition, at most `limit`; with 1 a sample document."""
    got = df.filter(condition)
    return got if limit is None else got.limit(limit)


def replace_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)
