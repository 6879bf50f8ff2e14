"""Regions of districts: which larger polygon a polygon belongs to.

A district belongs to the region that holds its representative point (one that lies inside it for certain), else to
the one that holds its centroid, else to the nearest one. Both layers are administrative: the larger one
goes to every task, and its size is checked first; a larger layer is an error, for which `containing_regions`
on the representative points is the way.

Defined results. Polygons without area have the mean of their corners as centroid and representative point; a geometry
that cannot be read has none, and no region. Of several regions the first by id counts. Distances are planar
in degrees, longitude shrunk by the cosine of the latitude. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demesne.operators.spatial import edges_of, inside, rings_of


def centroid(rings: list[np.ndarray]) -> tuple[float, float] | None:
    """Of the area, holes excepted. Outer rings count with their area, rings inside an odd number of others against it."""
    if not rings:
        return None
    area = x = y = 0.0
    for i, r in enumerate(rings):
        # relative to a corner, so that small shapes far from 0 keep their digits
        ox, oy = r[0]
        a, b, c, d = r[:-1, 0] - ox, r[:-1, 1] - oy, r[1:, 0] - ox, r[1:, 1] - oy
        cross = a * d - c * b
        own = cross.sum() / 2
        if own == 0:
            continue
        # a hole lies in the outer ring before it; its first edge's middle tells
        mid = (r[0] + r[1]) / 2
        around = sum(bool(inside(mid[:1], mid[1:], edges_of([o]))[0]) for j, o in enumerate(rings) if j != i)
        sign = (1 if around % 2 == 0 else -1) * (1 if own > 0 else -1)
        area += sign * own
        x += sign * (((a + c) * cross).sum() / 6 + ox * own)
        y += sign * (((b + d) * cross).sum() / 6 + oy * own)
    if area == 0:
        corners = np.vstack(rings)
        return float(corners[:, 0].mean()), float(corners[:, 1].mean())
    return float(x / area), float(y / area)


def representative_point(rings: list[np.ndarray]) -> tuple[float, float] | None:
    """A point inside: the middle of the widest stretch of a level line half-way up, or of one between two corners' levels."""
    if not rings:
        return None
    edges = edges_of(rings)
    levels = np.unique(edges[:, [1, 3]])
    if len(levels) < 2:
        return centroid(rings)
    half = (levels[0] + levels[-1]) / 2
    k = min(max(int(np.searchsorted(levels, half)), 1), len(levels) - 1)
    for y in [(levels[k - 1] + levels[k]) / 2, *((levels[:-1] + levels[1:]) / 2)]:
        x1, y1, x2, y2 = edges[(edges[:, 1] > y) != (edges[:, 3] > y)].T
        at = np.sort(x1 + (y - y1) * (x2 - x1) / (y2 - y1))
        if len(at) >= 2:
            width = at[1::2] - at[::2]
            if width.max() > 0:
                i = int(width.argmax())
                return float((at[2 * i] + at[2 * i + 1]) / 2), float(y)
    return centroid(rings)


def distance(point: tuple[float, float], edges: np.ndarray) -> float:
    """From a point to the nearest edge, 0 inside."""
    if inside(np.array([point[0]]), np.array([point[1]]), edges)[0]:
        return 0.0
    shrink = math.cos(math.radians(point[1]))
    p = (edges[:, :2] - point) * (shrink, 1)
    q = (edges[:, 2:] - point) * (shrink, 1)
    d = q - p
    t = np.clip(-(p * d).sum(axis=1) / np.maximum((d * d).sum(axis=1), 1e-300), 0, 1)
    return float(np.sqrt(((p + t[:, None] * d) ** 2).sum(axis=1).min()))


def with_points(districts: DataFrame, code: str, geometry: str = "geometry") -> DataFrame:
    """(code, inner_lon, inner_lat, centre_lon, centre_lat) of each polygon."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for c, g in zip(b["code"], b["shape"], strict=True):
                rings = rings_of(g)
                rows.append((c, *(representative_point(rings) or (None, None)), *(centroid(rings) or (None, None))))
            yield pd.DataFrame(rows, columns=["code", "inner_lon", "inner_lat", "centre_lon", "centre_lat"]).astype({c: "float64" for c in ("inner_lon", "inner_lat", "centre_lon", "centre_lat")})

    return districts.select(F.col(code).cast("string").alias("code"), F.col(geometry).alias("shape")).mapInPandas(run, "code string, inner_lon double, inner_lat double, centre_lon double, centre_lat double")


def regions_of(districts: DataFrame, regions: DataFrame, code: str, region: str, geometry: str = "geometry", most_regions: int = 5_000) -> DataFrame:
    """(code, region, how, apart): how is inner, centre or nearest; apart is the distance of the last."""
    larger = regions.select(F.col(region).cast("string").alias("region"), F.col(geometry).alias("shape")).filter("region IS NOT NULL").limit(most_regions + 1).toPandas().sort_values("region")
    if len(larger) > most_regions:
        raise ValueError(f"more than {most_regions} regions: find the region of the representative points with containing_regions")
    shapes = [(r, e) for r, g in zip(larger["region"], larger["shape"], strict=True) if len(e := edges_of(rings_of(g)))]

    def holder(x: float, y: float) -> str | None:
        return next((r for r, e in shapes if inside(np.array([x]), np.array([y]), e)[0]), None)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for c, ix, iy, cx, cy in b.itertuples(index=False):
                if pd.isna(ix) or not shapes:
                    rows.append((c, None, None, None))
                elif r := holder(ix, iy):
                    rows.append((c, r, "inner", 0.0))
                elif r := holder(cx, cy):
                    rows.append((c, r, "centre", 0.0))
                else:
                    apart, r = min((distance((ix, iy), e), r) for r, e in shapes)
                    rows.append((c, r, "nearest", apart))
            yield pd.DataFrame(rows, columns=["code", "region", "how", "apart"]).astype({"apart": "float64"})

    return with_points(districts, code, geometry).mapInPandas(run, "code string, region string, how string, apart double")
