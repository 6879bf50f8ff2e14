"""Points, polygons and the British National Grid."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def geojson_point(lon: Column, lat: Column, zero_is_missing: bool = True) -> Column:
    """struct(type, coordinates), longitude first; NULL if a part is missing (or zero)."""
    there = lon.isNotNull() & lat.isNotNull() & ~F.isnan(lon) & ~F.isnan(lat)
    if zero_is_missing:
        there &= (lon != 0) & (lat != 0)
    return F.when(there, F.struct(F.lit("Point").alias("type"), F.array(lon, lat).alias("coordinates")))


def in_ring(lon: Column, lat: Column, edges: Column) -> Column:
    """Even-odd rule over an array of edge structs (x1, y1, x2, y2)."""

    def crosses(e: Column) -> Column:
        spans = (e["y1"] > lat) != (e["y2"] > lat)
        return spans & (lon < e["x1"] + (lat - e["y1"]) * (e["x2"] - e["x1"]) / F.nullif(e["y2"] - e["y1"], F.lit(0.0)))

    return F.size(F.filter(edges, crosses)) % 2 == 1


def to_grid_free(easting: float, northing: float) -> tuple[float, float]:
    """(lon, lat) in WGS84 of a British National Grid point: inverse transverse Mercator, then a seven-parameter shift; good to metres."""
    a, b, f0 = 6377563.396, 6356256.909, 0.9996012717
    lat0, lon0, n0, e0 = math.radians(49), math.radians(-2), -100000.0, 400000.0
    e2, n = 1 - (b * b) / (a * a), (a - b) / (a + b)

    def arc(lat: float) -> float:
        d, s = lat - lat0, lat + lat0
        return b * f0 * ((1 + n + 1.25 * n**2 + 1.25 * n**3) * d - (3 * n + 3 * n**2 + 2.625 * n**3) * math.sin(d) * math.cos(s) + (1.875 * n**2 + 1.875 * n**3) * math.sin(2 * d) * math.cos(2 * s) - (35 / 24) * n**3 * math.sin(3 * d) * math.cos(3 * s))

    lat = lat0
    for _ in range(20):
        step = (northing - n0 - arc(lat)) / (a * f0)
        lat += step
        if abs(step) < 1e-12:
            break
    s2 = math.sin(lat) ** 2
    nu, rho = a * f0 / math.sqrt(1 - e2 * s2), a * f0 * (1 - e2) / (1 - e2 * s2) ** 1.5
    eta2, t, x = nu / rho - 1, math.tan(lat), easting - e0
    phi = lat - t / (2 * rho * nu) * x**2 + t / (24 * rho * nu**3) * (5 + 3 * t**2 + eta2 - 9 * t**2 * eta2) * x**4 - t / (720 * rho * nu**5) * (61 + 90 * t**2 + 45 * t**4) * x**6
    sec = 1 / math.cos(lat)
    lam = lon0 + sec / nu * x - sec / (6 * nu**3) * (nu / rho + 2 * t**2) * x**3 + sec / (120 * nu**5) * (5 + 28 * t**2 + 24 * t**4) * x**5
    v = a / math.sqrt(1 - e2 * math.sin(phi) ** 2)
    p = (v * math.cos(phi) * math.cos(lam), v * math.cos(phi) * math.sin(lam), (1 - e2) * v * math.sin(phi))
    tx, ty, tz, scale = 446.448, -125.157, 542.060, 1 - 20.4894e-6
    rx, ry, rz = (math.radians(r / 3600) for r in (0.1502, 0.2470, 0.8421))
    x2 = tx + scale * p[0] - rz * p[1] + ry * p[2]
    y2 = ty + rz * p[0] + scale * p[1] - rx * p[2]
    z2 = tz - ry * p[0] + rx * p[1] + scale * p[2]
    aw, bw = 6378137.0, 6356752.314245
    ew, r = 1 - (bw * bw) / (aw * aw), math.hypot(x2, y2)
    phi = math.atan2(z2, r * (1 - ew))
    for _ in range(10):
        v = aw / math.sqrt(1 - ew * math.sin(phi) ** 2)
        phi = math.atan2(z2 + ew * v * math.sin(phi), r)
    return math.degrees(math.atan2(y2, x2)), math.degrees(phi)
