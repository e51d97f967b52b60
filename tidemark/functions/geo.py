"""Coordinates: keys, text and one map projection."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed values of EPSG:2193: GRS80 ellipsoid, central meridian, scale, false easting and northing.
A, FLATTENING, MERIDIAN, SCALE, EAST, NORTH = 6378137.0, 1 / 298.257222101, 173.0, 0.9996, 1_600_000.0, 10_000_000.0


def axis_key(lon: Column) -> Column:
    """Longitude in 0 to 360 to three places."""
    return F.round(F.pmod(lon, F.lit(360.0)), 3)


def square_wkt(lon: Column, lat: Column, size: float) -> Column:
    h = size / 2
    corners = [(-h, -h), (h, -h), (h, h), (-h, h), (-h, -h)]
    text = ", ".join(["%.6f %.6f"] * 5)
    return F.format_string(f"POLYGON(({text}))", *[c for x, y in corners for c in (lon + x, lat + y)])


def with_nztm(df: DataFrame, lon: str, lat: str, east: str, north: str) -> DataFrame:
    """df with easting and northing in metres, by the transverse Mercator series in the third flattening, to fourth order.

    Each intermediate value is a column of its own, so that it is computed once a row.
    """
    n = FLATTENING / (2 - FLATTENING)
    series = (
        n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16 + 41 * n**4 / 180, 13 * n**2 / 48 - 3 * n**3 / 5 + 557 * n**4 / 1440,
        61 * n**3 / 240 - 103 * n**4 / 140, 49561 * n**4 / 161280,
    )
    radius = A / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    c = 2 * math.sqrt(n) / (1 + n)
    s, w, t, xi, eta = (F.col(f"_{x}") for x in ("s", "w", "t", "xi", "eta"))
    df = df.withColumns({"_s": F.sin(F.radians(lat)), "_w": F.radians(F.col(lon) - MERIDIAN)})
    df = df.withColumn("_t", F.sinh(F.atanh(s) - c * F.atanh(c * s)))
    df = df.withColumns({"_xi": F.atan2(t, F.cos(w)), "_eta": F.atanh(F.sin(w) / F.sqrt(1 + t * t))})
    e, m = eta, xi
    for i, a in enumerate(series):
        k = 2 * (i + 1)
        e = e + a * F.cos(k * xi) * F.sinh(k * eta)
        m = m + a * F.sin(k * xi) * F.cosh(k * eta)
    out = df.withColumns({"_e": EAST + SCALE * radius * e, "_n": NORTH + SCALE * radius * m}).drop("_s", "_w", "_t", "_xi", "_eta")
    return out.withColumns({east: F.col("_e"), north: F.col("_n")}).drop("_e", "_n")
