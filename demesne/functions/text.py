"""Scalar text functions of the register: field mapping, postcodes, house numbers, addresses, differences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Long column of a change file, short key (fixed values).
FIELDS = {
    "unique_identifier": "uid", "register_property_description": "rpd", "county": "cty", "region": "rgn", "associated_property_description_id": "apid",
    "associated_property_description": "apd", "os_uprn": "uprn", "price_paid": "ppd", "reg_order": "ro", "date_of_lease": "dol", "term": "term", "alienation_clause_indicator": "aci",
}
NUMERIC_FIELDS = ("uprn", "ro", "ppd", "apid")
#: Words that end a building's name within a road, in order of precedence (fixed values).
BUILDING_WORDS = ("COURT", "LODGE", "HOUSE", "HALL", "MANOR", "TOWER", "TOWERS", "PLACE", "BUILDING", "BUILDINGS", "MANSION", "MANSIONS", "CHAMBERS", "ARCADE", "CENTRE", "CENTER", "PARK")
POSTCODE = r"(?i)\b[A-Z]{1,2}\d{1,2}[A-Z]?\s?\d[A-Z]{2}\b"
RESIDENTIAL = ("R", "X", "P")


def filled(c: Column) -> Column:
    """Trimmed; blank is NULL."""
    return F.nullif(F.trim(c), F.lit(""))


def digits_to_long(c: Column) -> Column:
    """A number if the text is all digits, else NULL (the raw text is kept beside it)."""
    return F.when(c.rlike("^[0-9]+$"), c.try_cast("bigint"))


def postcode(*parts: Column) -> Column:
    """First postcode of the parts, upper case, inner blanks single; none gives NULL."""
    found = F.regexp_extract(F.concat_ws(" ", *parts), POSTCODE, 0)
    return F.nullif(F.upper(F.regexp_replace(F.trim(found), r"\s+", " ")), F.lit(""))


def mapped_rows(changes: DataFrame) -> DataFrame:
    """Change rows under short keys: blanks NULL, all-digit ids as numbers beside their text, postcode derived."""
    out = changes.select(*[c for c in changes.columns if c not in FIELDS], *[filled(F.col(c)).alias(k) for c, k in FIELDS.items()])
    out = out.withColumns({f"{k}_n": digits_to_long(F.col(k)) for k in NUMERIC_FIELDS})
    return out.withColumn("pc", postcode(F.col("rpd"), F.col("apd")))


def house_number_start(c: Column) -> Column:
    """The number before a dash: 153-157 gives 153."""
    return F.trim(F.split_part(c, F.lit("-"), F.lit(1)))


def base_number(c: Column) -> Column:
    """Leading digits of the number before a dash, else that text whole."""
    head = house_number_start(c)
    return F.coalesce(F.nullif(F.regexp_extract(head, r"^(\d+)", 1), F.lit("")), head)


def short_address(c: Column) -> Column:
    """With two or more commas the first part is dropped."""
    parts = F.split(c, ",")
    return F.when(F.size(parts) > 2, F.array_join(F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(1))), lambda p: F.trim(p)), ", ")).otherwise(c)


def split_road(road: Column, house_number: Column) -> Column:
    """struct(house, road): a building's name at the head of a road, by the first building word that fits."""
    up = F.upper(road)
    found = F.lit(None).cast("struct<b:string,r:string>")
    for word in reversed(BUILDING_WORDS):
        pattern = rf"^(.+?\s+{word})\s+(.+)$"
        found = F.when(up.rlike(pattern), F.struct(F.trim(F.regexp_extract(up, pattern, 1)).alias("b"), F.trim(F.regexp_extract(up, pattern, 2)).alias("r"))).otherwise(found)
    house = F.when(found.isNotNull(), F.concat_ws(" ", house_number, found["b"]))
    return F.struct(house.alias("house"), F.coalesce(found["r"], up).alias("road"))


def address_parts(address: Column) -> Column:
    """struct(house_number, road, city, postcode) by rules: the postcode anywhere, the last part the town, the number heads the road.

    The statistical parser that such pipelines use is not available; this covers the ordinary shapes.
    """
    code = postcode(address)
    bare = F.regexp_replace(F.regexp_replace(F.upper(address), POSTCODE, ""), r"[()]", " ")
    parts = F.filter(F.transform(F.split(bare, ","), lambda p: F.trim(F.regexp_replace(p, r"\s+", " "))), lambda p: p != "")
    numbered = F.filter(parts, lambda p: p.rlike(r"^\d+[A-Z]?(-\d+[A-Z]?)?\s+\S"))
    road = F.try_element_at(numbered, F.lit(-1))
    number = F.nullif(F.regexp_extract(road, r"^(\d+[A-Z]?(?:-\d+[A-Z]?)?)\s", 1), F.lit(""))
    name = F.nullif(F.regexp_replace(road, r"^\d+[A-Z]?(?:-\d+[A-Z]?)?\s+", ""), F.lit(""))
    last = F.try_element_at(parts, F.lit(-1))
    city = F.when((F.size(parts) > 1) & ~last.rlike(r"^\d"), last)
    return F.struct(number.alias("house_number"), F.coalesce(name, F.try_element_at(parts, F.lit(1))).alias("road"), city.alias("city"), code.alias("postcode"))


def text_value(c: Column) -> Column:
    """Trimmed text of any value; NULL is ''."""
    return F.coalesce(F.trim(c.cast("string")), F.lit(""))


def char_difference(a: Column, b: Column) -> Column:
    """Positions at which two texts differ, the longer one's tail included."""
    n = F.greatest(F.length(a), F.length(b))
    return F.when(a == b, 0).otherwise(F.aggregate(F.sequence(F.lit(1), n), F.lit(0), lambda s, i: s + F.when(F.substr(a, i, F.lit(1)) != F.substr(b, i, F.lit(1)), 1).otherwise(0)))


def cache_key(c: Column) -> Column:
    """Postcode as a lookup key: no blanks, upper case."""
    return F.upper(F.regexp_replace(F.trim(c), " ", ""))


def is_residential(class_code: Column, exact: bool = False) -> Column:
    """R, X or P by the first letter of the class (or, exact, the whole class); no class is not residential."""
    c = F.upper(F.trim(class_code))
    return F.coalesce((c if exact else F.substring(c, 1, 1)).isin(*RESIDENTIAL), F.lit(False))


def version_of(name: Column) -> Column:
    """YYYY-MM from a file name that holds YYYY_MM."""
    hit = F.regexp_extract(name, r"(\d{4})_(\d{2})", 0)
    return F.when(hit != "", F.regexp_replace(hit, "_", "-"))
