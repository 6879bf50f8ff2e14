"""Points near other points, and the region that holds a point.

Positions get a cell identifier on a space-filling curve (Morton order over the whole globe, 26 bits per
axis). A disc or a region is covered by cells; each cell is one contiguous range of codes. Points and
ranges are cut at the same code boundaries (quantiles of the point codes), so that one task holds a run
of sorted codes and the ranges that touch it; candidates come from binary search of the range ends in
the sorted codes and are then refined exactly (haversine, or ray casting with holes).

Scale. Both sides shuffle once, on the boundary they fall in; nothing is broadcast. Distinct positions
are joined, not records: a position shared by a third of all records is one point, and its records come
back only when the found pairs are expanded. A disc meets few boundaries (usually none). Covers of
regions are made from the region's own edges, one region per task row, and travel as ranges; a range
over inner cells needs no exact test. Candidates are expanded in slices, so that memory stays bounded
in dense places.

Defined results. A position is the pair in `loc` if usable, else (lon, lat) if usable, else none, in
which case the record takes no part. NaN is not usable. Records with a null id are left out. A record
with several positions is near if any of them is. Boundary points: a point on an edge counts as inside
or outside as the even-odd rule gives it. Empty tables give no rows; extra columns are ignored.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demesne.common import cut, parallelism

EARTH_M = 6_371_008.8
BITS = 26
#: Runs of codes per shuffle partition, so that hashing spreads them evenly.
PARTS_PER_TASK = 4
METRES_PER_DEGREE = math.pi * EARTH_M / 180


# ---------------------------------------------------------------- positions and codes


def usable_pair(a: Column, b: Column) -> Column:
    """struct(lon, lat) if one value is a longitude in -8..2 and the other a latitude in 49..61, else NULL."""
    lon, lat = (lambda x: x.between(-8, 2)), (lambda x: x.between(49, 61))
    pair = lambda x, y: F.struct((x + F.lit(0.0)).alias("lon"), (y + F.lit(0.0)).alias("lat"))  # noqa: E731  (-0.0 + 0.0 is 0.0)
    return F.when(lon(a) & lat(b), pair(a, b)).when(lon(b) & lat(a), pair(b, a))


def position(loc: str = "loc", lat: str = "lat", lon: str = "lon") -> Column:
    xy = F.col(f"{loc}.coordinates")
    return F.coalesce(F.when(F.size(xy) == 2, usable_pair(xy[0], xy[1])), usable_pair(F.col(lon), F.col(lat)))


def _spread(v: np.ndarray) -> np.ndarray:
    v = v.astype(np.uint64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        v = (v | (v << np.uint64(shift))) & np.uint64(mask)
    return v


def _grid(lon: np.ndarray, lat: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    n = 1 << bits
    x = np.clip(np.floor((lon + 180.0) / 360.0 * n), 0, n - 1).astype(np.int64)
    y = np.clip(np.floor((lat + 90.0) / 180.0 * n), 0, n - 1).astype(np.int64)
    return x, y


def _interleave(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return (_spread(x) | (_spread(y) << np.uint64(1))).astype(np.int64)


def morton(lon: np.ndarray, lat: np.ndarray) -> np.ndarray:
    return _interleave(*_grid(lon, lat))


def morton_code(lon: Column | str, lat: Column | str) -> Column:
    """The same code as an expression, so that coding points stays in the JVM."""
    n = 1 << BITS

    def spread(c: Column) -> Column:
        for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
            c = c.bitwiseOR(F.shiftleft(c, shift)).bitwiseAND(F.lit(mask))
        return c

    x = F.floor((F.col(lon) + 180.0) / 360.0 * n)
    y = F.floor((F.col(lat) + 90.0) / 180.0 * n)
    x, y = (F.greatest(F.lit(0), F.least(F.lit(n - 1), v)).cast("long") for v in (x, y))
    return spread(x).bitwiseOR(F.shiftleft(spread(y), 1))


def haversine_m(lon1, lat1, lon2, lat2):
    lon1, lat1, lon2, lat2 = (np.radians(v) for v in (lon1, lat1, lon2, lat2))
    h = np.sin((lat2 - lat1) / 2) ** 2 + np.cos(lat1) * np.cos(lat2) * np.sin((lon2 - lon1) / 2) ** 2
    return 2 * EARTH_M * np.arcsin(np.sqrt(np.minimum(h, 1.0)))


# ---------------------------------------------------------------- covers


def disc_cover(lon: np.ndarray, lat: np.ndarray, radius_m: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, lo, hi): the cells of at least twice the radius that each disc's bounding box meets, at most four."""
    high = np.minimum(np.abs(lat) + radius_m / METRES_PER_DEGREE, 89.9)
    dy = np.full(len(lat), radius_m / METRES_PER_DEGREE) * (1 + 1e-9)
    dx = dy / np.cos(np.radians(high))
    worst = max(float(dx.max()) / 360 if len(dx) else 1e-9, float(dy.max()) / 180 if len(dy) else 1e-9)
    level = max(0, min(BITS, int(math.floor(-math.log2(max(2 * worst, 2.0**-BITS))))))
    x0, y0 = _grid(lon - dx, lat - dy, level)
    x1, y1 = _grid(lon + dx, lat + dy, level)
    rows, los = [], []
    for i in (0, 1):
        for j in (0, 1):
            keep = (x0 + i <= x1) & (y0 + j <= y1)
            rows.append(np.flatnonzero(keep))
            los.append(_interleave((x0 + i)[keep], (y0 + j)[keep]) << (2 * (BITS - level)))
    row, lo = np.concatenate(rows), np.concatenate(los)
    return row, lo, lo + (1 << (2 * (BITS - level))) - 1


def rings_of(geometry: str | None) -> list[np.ndarray]:
    """All rings, outer and holes alike, of a GeoJSON Polygon or MultiPolygon; [] if it is neither."""
    try:
        g = json.loads(geometry)
        polygons = {"Polygon": lambda c: [c], "MultiPolygon": lambda c: c}[g["type"]](g["coordinates"])
        rings = [np.asarray(r, float)[:, :2] for p in polygons for r in p if len(r) >= 3]
    except (TypeError, ValueError, KeyError, IndexError):
        return []
    return [np.vstack([r, r[:1]]) if (r[0] != r[-1]).any() else r for r in rings]


def edges_of(rings: list[np.ndarray]) -> np.ndarray:
    return np.vstack([np.hstack([r[:-1], r[1:]]) for r in rings]) if rings else np.empty((0, 4))


def inside(lon: np.ndarray, lat: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Even-odd rule over all rings, so holes are excepted."""
    out = np.zeros(len(lon), bool)
    for k in range(0, len(lon), 20_000):
        x, y = lon[k : k + 20_000, None], lat[k : k + 20_000, None]
        x1, y1, x2, y2 = edges.T[:, None, :]
        spans = (y1 > y) != (y2 > y)
        with np.errstate(divide="ignore", invalid="ignore"):
            at = x1 + (y - y1) * (x2 - x1) / (y2 - y1)
        out[k : k + 20_000] = (spans & (x < at)).sum(axis=1) % 2 == 1
    return out


def region_cover(edges: np.ndarray, finest: int) -> list[tuple[int, int, bool, np.ndarray]]:
    """(lo, hi, is inner, edges of the cell's latitude band): quadtree descent from the region's bounding box.

    A cell that no edge meets is inner or outer as its centre is; a cell met by an edge is divided down
    to the finest level and then kept for exact tests.
    """
    if not len(edges):
        return []
    box = (edges[:, [0, 2]].min(), edges[:, [1, 3]].min(), edges[:, [0, 2]].max(), edges[:, [1, 3]].max())
    level = max(0, min(finest, int(math.floor(-math.log2(max((box[2] - box[0]) / 360, (box[3] - box[1]) / 180, 2.0**-finest))))))
    (x0, x1), (y0, y1) = _grid(np.array([box[0], box[2]]), np.array([box[1], box[3]]), level)
    todo = [(level, x, y, edges) for x in range(x0, x1 + 1) for y in range(y0, y1 + 1)]
    found = []
    lo_x, hi_x = np.minimum(edges[:, 0], edges[:, 2]), np.maximum(edges[:, 0], edges[:, 2])
    lo_y, hi_y = np.minimum(edges[:, 1], edges[:, 3]), np.maximum(edges[:, 1], edges[:, 3])
    while todo:
        level, x, y, _ = todo.pop()
        w, h = 360 / (1 << level), 180 / (1 << level)
        left, low = x * w - 180, y * h - 90
        slack = 1e-9
        meets = (lo_x <= left + w + slack) & (hi_x >= left - slack) & (lo_y <= low + h + slack) & (hi_y >= low - slack)
        shift = 2 * (BITS - level)
        if not meets.any():
            if inside(np.array([left + w / 2]), np.array([low + h / 2]), edges)[0]:
                lo = int(_interleave(np.array([x]), np.array([y]))[0]) << shift
                found.append((lo, lo + (1 << shift) - 1, True, np.empty((0, 4))))
        elif level >= finest:
            lo = int(_interleave(np.array([x]), np.array([y]))[0]) << shift
            band = (lo_y <= low + h + slack) & (hi_y >= low - slack)
            found.append((lo, lo + (1 << shift) - 1, False, edges[band]))
        else:
            todo += [(level + 1, 2 * x + i, 2 * y + j, None) for i in (0, 1) for j in (0, 1)]
    found.sort(key=lambda f: f[0])
    merged: list[tuple[int, int, bool, np.ndarray]] = []
    for f in found:
        if merged and f[2] and merged[-1][2] and merged[-1][1] + 1 == f[0]:
            merged[-1] = (merged[-1][0], f[1], True, f[3])
        else:
            merged.append(f)
    return merged


# ---------------------------------------------------------------- range join on sorted codes


def code_boundaries(points: DataFrame, parts: int) -> np.ndarray:
    """parts - 1 quantiles of the codes; the same boundaries cut points and ranges."""
    if parts < 2:
        return np.empty(0, np.int64)
    cuts = points.agg(F.percentile_approx("code", [i / parts for i in range(1, parts)], 100_000).alias("q")).first()["q"]
    return np.unique(np.asarray(cuts or [], np.int64))


def _candidates(codes: np.ndarray, lo: np.ndarray, hi: np.ndarray, slice_rows: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(range index, point index) of every code within its range, in slices of about slice_rows."""
    first, last = np.searchsorted(codes, lo, "left"), np.searchsorted(codes, hi, "right")
    n = np.maximum(last - first, 0)
    ends = np.cumsum(n)
    start = 0
    while start < len(n):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + slice_rows, "right")))
        m = n[start:stop]
        if m.sum():
            which = np.repeat(np.arange(start, stop), m)
            offset = np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
            yield which, first[which] + offset
        start = stop


def _near(radius_m: float, slice_rows: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, held, pts = None, [], None
        for batch in batches:
            for (p, is_range), rows in batch.groupby(["part", "is_range"], sort=False):
                if p != part:
                    part, held, pts = p, [], None
                if not is_range:
                    held.append((rows["lo"].to_numpy(np.int64), rows["lon"].to_numpy(float), rows["lat"].to_numpy(float)))
                    pts = None
                    continue
                if not held:
                    continue
                if pts is None:
                    pts = tuple(np.concatenate([h[i] for h in held]) for i in range(3))
                code, lon, lat = pts
                lo, hi, x, y = (rows[c].to_numpy() for c in ("lo", "hi", "lon", "lat"))
                for r, q in _candidates(code, lo, hi, slice_rows):
                    ok = ((x[r] < lon[q]) | ((x[r] == lon[q]) & (y[r] < lat[q])))
                    r, q = r[ok], q[ok]
                    ok = haversine_m(x[r], y[r], lon[q], lat[q]) <= radius_m
                    r, q = r[ok], q[ok]
                    if len(r):
                        yield pd.DataFrame({"lon_a": x[r], "lat_a": y[r], "lon_b": lon[q], "lat_b": lat[q]})

    return run


def _sorted_parts(df: DataFrame) -> DataFrame:
    """The rows of a part in one task, sorted; hashing the part numbers needs no sampling pass over the covers."""
    return df.repartition(parallelism(df.sparkSession), "part").sortWithinPartitions("part", "is_range", "lo")


def _parts_of(cuts: np.ndarray, parts: int):
    @F.pandas_udf("array<int>")
    def of(lo: pd.Series, hi: pd.Series) -> pd.Series:
        a, b = np.searchsorted(cuts, lo.to_numpy(np.int64), "right"), np.searchsorted(cuts, hi.to_numpy(np.int64), "right")
        return pd.Series([np.arange(i, j + 1, dtype=np.int32) for i, j in zip(a, b, strict=True)])

    return of


def coded_positions(records: DataFrame, where: Column | None = None, id_column: str = "_id") -> DataFrame:
    """(id, lon, lat), distinct, of the records that have a usable position."""
    p = records.select(F.col(id_column).alias("id"), (where if where is not None else position()).alias("p"))
    return p.filter(F.col("id").isNotNull() & F.col("p").isNotNull()).select("id", "p.lon", "p.lat").distinct()


def near_positions(places: DataFrame, radius_m: float, parts: int | None = None, slice_rows: int = 500_000) -> DataFrame:
    """(lon_a, lat_a, lon_b, lat_b): distinct positions at most radius_m apart, each pair once."""
    parts = parts or PARTS_PER_TASK * parallelism(places.sparkSession)
    coded = places.withColumn("code", morton_code("lon", "lat"))
    cuts = code_boundaries(coded, parts)

    def cover(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            row, lo, hi = disc_cover(b["lon"].to_numpy(float), b["lat"].to_numpy(float), radius_m)
            first, last = np.searchsorted(cuts, lo, "right"), np.searchsorted(cuts, hi, "right")
            n = last - first + 1
            which = np.repeat(np.arange(len(row)), n)
            part = first[which] + np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
            at = row[which]
            yield pd.DataFrame({"part": part.astype(np.int32), "is_range": True, "lo": lo[which], "hi": hi[which], "lon": b["lon"].to_numpy(float)[at], "lat": b["lat"].to_numpy(float)[at]})
            code = b["code"].to_numpy(np.int64)
            yield pd.DataFrame({"part": np.searchsorted(cuts, code, "right").astype(np.int32), "is_range": False, "lo": code, "hi": code, "lon": b["lon"].to_numpy(float), "lat": b["lat"].to_numpy(float)})

    both = coded.mapInPandas(cover, "part int, is_range boolean, lo long, hi long, lon double, lat double")
    return _sorted_parts(both).mapInPandas(_near(radius_m, slice_rows), "lon_a double, lat_a double, lon_b double, lat_b double")


def near_places(records: DataFrame, radius_m: float, id_column: str = "_id", where: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """The class form of nearness: (id, lon, lat) of each record, and (lon_a, lat_a, lon_b, lat_b) of each two positions near each other, once.

    Records at one position are a class; no pair of records is made, however many share a position.
    """
    members = coded_positions(records, where, id_column)
    places = cut(members.groupBy("lon", "lat").agg(F.count("*").alias("n")))
    return members.select("id", "lon", "lat"), near_positions(places.select("lon", "lat"), radius_m)


def near_pairs(records: DataFrame, radius_m: float, id_column: str = "_id", where: Column | None = None, block: int = 2_000, most_hot: int = 100_000) -> DataFrame:
    """(id_a, id_b), distinct, id_a < id_b: records at most radius_m apart.

    Records at a position with more than `block` are dealt into blocks, and blocks are paired with blocks: no task
    expands more than block x block pairs of one position at once.
    """
    members = coded_positions(records, where, id_column)
    places = cut(members.groupBy("lon", "lat").agg(F.count("*").alias("n")))
    found = near_positions(places.select("lon", "lat"), radius_m)
    same = places.select(F.col("lon").alias("lon_a"), F.col("lat").alias("lat_a"), F.col("lon").alias("lon_b"), F.col("lat").alias("lat_b"))
    pairs = same.unionAll(found)
    keyed = members.select("id", "lon", "lat")
    hot = places.filter(F.col("n") > block).select("lon", "lat", F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    n_hot = hot.limit(most_hot + 1).count()
    on_a, on_b = ["lon_a", "lat_a"], ["lon_b", "lat_b"]
    if n_hot:
        hot = F.broadcast(hot) if n_hot <= most_hot else hot
        blocks = F.coalesce("blocks", F.lit(1))
        keyed = keyed.join(hot, ["lon", "lat"], "left").select("id", "lon", "lat", F.pmod(F.xxhash64("id"), blocks).alias("block"))
        for x, on in (("a", on_a), ("b", on_b)):
            pairs = pairs.join(hot.select(F.col("lon").alias(on[0]), F.col("lat").alias(on[1]), "blocks"), on, "left")
            pairs = pairs.withColumn(f"block_{x}", F.explode(F.sequence(F.lit(0).cast("long"), (blocks - 1).cast("long")))).drop("blocks")
        on_a, on_b = [*on_a, "block_a"], [*on_b, "block_b"]
    a = keyed.select(F.col("id").alias("a"), *[F.col(c[:-2]).alias(c) for c in on_a])
    b = keyed.select(F.col("id").alias("b"), *[F.col(c[:-2]).alias(c) for c in on_b])
    joined = pairs.join(a, on_a).join(b, on_b)
    own = (F.col("lon_a") == F.col("lon_b")) & (F.col("lat_a") == F.col("lat_b"))
    kept = joined.filter((F.col("a") != F.col("b")) & (~own | (F.col("a") < F.col("b"))))
    return kept.select(F.least("a", "b").alias("id_a"), F.greatest("a", "b").alias("id_b")).distinct()


def containing_regions(records: DataFrame, regions: DataFrame, region_id: str, geometry: str = "geometry", finest: int = 14, id_column: str = "_id", where: Column | None = None, slice_rows: int = 200_000) -> DataFrame:
    """(id, region), distinct: the regions whose area, holes excepted, holds a position of the record."""
    members = coded_positions(records, where, id_column)
    places = cut(members.select("lon", "lat").distinct().withColumn("code", morton_code("lon", "lat")))
    parts = PARTS_PER_TASK * parallelism(records.sparkSession)
    cuts = code_boundaries(places, parts)

    def cover(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for name, shape in zip(b["region"], b["shape"], strict=True):
                rows = []
                for lo, hi, inner, edges in region_cover(edges_of(rings_of(shape)), finest):
                    for p in range(int(np.searchsorted(cuts, lo, "right")), int(np.searchsorted(cuts, hi, "right")) + 1):
                        rows.append((p, True, lo, hi, None, None, name, None if inner else edges.ravel().tolist()))
                if rows:
                    yield pd.DataFrame(rows, columns=["part", "is_range", "lo", "hi", "lon", "lat", "region", "edges"])

    schema = "part int, is_range boolean, lo long, hi long, lon double, lat double, region string, edges array<double>"
    ranges = regions.select(F.col(region_id).cast("string").alias("region"), F.col(geometry).alias("shape")).filter("region IS NOT NULL AND shape IS NOT NULL").repartition(parallelism(records.sparkSession), "region").mapInPandas(cover, schema)
    part = _parts_of(cuts, parts)("code", "code")[0]
    points = places.select(part.alias("part"), F.lit(False).alias("is_range"), F.col("code").alias("lo"), F.col("code").alias("hi"), "lon", "lat", F.lit(None).cast("string").alias("region"), F.lit(None).cast("array<double>").alias("edges"))

    def refine(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, held, pts = None, [], None
        for batch in batches:
            for (p, is_range), rows in batch.groupby(["part", "is_range"], sort=False):
                if p != part:
                    part, held, pts = p, [], None
                if not is_range:
                    held.append((rows["lo"].to_numpy(np.int64), rows["lon"].to_numpy(float), rows["lat"].to_numpy(float)))
                    pts = None
                    continue
                if not held:
                    continue
                if pts is None:
                    pts = tuple(np.concatenate([h[i] for h in held]) for i in range(3))
                code, lon, lat = pts
                names, edges = rows["region"].to_numpy(object), rows["edges"].to_numpy(object)
                for r, q in _candidates(code, rows["lo"].to_numpy(np.int64), rows["hi"].to_numpy(np.int64), slice_rows):
                    ok = np.ones(len(r), bool)
                    for i in np.unique(r):
                        if edges[i] is not None:
                            m = r == i
                            ok[m] = inside(lon[q[m]], lat[q[m]], np.asarray(edges[i], float).reshape(-1, 4))
                    if ok.any():
                        yield pd.DataFrame({"lon": lon[q[ok]], "lat": lat[q[ok]], "region": names[r[ok]]})

    held = _sorted_parts(points.unionAll(ranges)).mapInPandas(refine, "lon double, lat double, region string")
    return members.join(held, ["lon", "lat"]).select("id", "region").distinct()
