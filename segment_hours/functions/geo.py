"""Distances and the conversion from the OSGB36 national grid to WGS84."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

# Airy 1830 and GRS80 semi-axes, national grid projection, seven-parameter shift.
_AIRY_A, _AIRY_B = 6377563.396, 6356256.909
_WGS_A, _WGS_B = 6378137.0, 6356752.3141
_SCALE, _LAT0, _LON0 = 0.9996012717, 49.0, -2.0
_E0, _N0 = 400000.0, -100000.0
_SHIFT_M = (446.448, -125.157, 542.060)
_SHIFT_PPM = -20.4894
_ROTATION_ARCSEC = (0.1502, 0.2470, 0.8421)

_EARTH_RADIUS_KM = 6371.0088


def segment_direction(x1, y1, x2, y2):
    """Vector (ux, uy) whose product with an offset from the first end is the share along the segment."""
    dx, dy = x2 - x1, y2 - y1
    length2 = F.nullif(dx * dx + dy * dy, F.lit(0.0))
    return F.coalesce(dx / length2, F.lit(0.0)), F.coalesce(dy / length2, F.lit(0.0))


def segment_distance(x, y, x1, y1, x2, y2, ux, uy):
    """Distance of a point to one straight line segment of that direction; exact at its end points."""
    along = F.greatest((x - x1) * ux + (y - y1) * uy, F.lit(0.0))
    nearest_x = F.when(along < 1, x1 + along * (x2 - x1)).otherwise(x2)
    nearest_y = F.when(along < 1, y1 + along * (y2 - y1)).otherwise(y2)
    return F.sqrt(F.pow(x - nearest_x, 2) + F.pow(y - nearest_y, 2))


def unit_vector(lat, lon):
    """Point of the unit sphere: struct (x, y, z)."""
    lat, lon = F.radians(lat), F.radians(lon)
    return F.struct(
        (F.cos(lat) * F.cos(lon)).alias("x"), (F.cos(lat) * F.sin(lon)).alias("y"), F.sin(lat).alias("z")
    )


def chord_km(chord):
    """Great-circle kilometres of a chord of the unit sphere."""
    return 2 * _EARTH_RADIUS_KM * F.asin(F.least(F.lit(1.0), chord / 2))


def _meridian_series():
    """Coefficients of the series from rectifying to geodetic latitude, by multiple of the angle."""
    n = (_AIRY_A - _AIRY_B) / (_AIRY_A + _AIRY_B)
    return {
        2: 3 * n / 2 - 27 * n**3 / 32,
        4: 21 * n**2 / 16 - 55 * n**4 / 32,
        6: 151 * n**3 / 96,
        8: 1097 * n**4 / 512,
    }


def _meridian_radius():
    n = (_AIRY_A - _AIRY_B) / (_AIRY_A + _AIRY_B)
    return _AIRY_A / (1 + n) * (1 + n**2 / 4 + n**4 / 64)


def _meridian_arc0():
    """Meridian arc from the equator to the true origin, by numerical quadrature of the ellipse."""
    e2 = 1 - (_AIRY_B / _AIRY_A) ** 2
    steps = 2000
    h = math.radians(_LAT0) / steps

    def curvature(phi):
        return _AIRY_A * (1 - e2) / (1 - e2 * math.sin(phi) ** 2) ** 1.5

    inner = sum((4 if i % 2 else 2) * curvature(i * h) for i in range(1, steps))
    return h / 3 * (curvature(0.0) + inner + curvature(steps * h))


def osgb_to_wgs84(df, easting, northing, lat="Latitude", lon="Longitude"):
    """Adds WGS84 degrees of national grid coordinates; no iteration, about 5 m accuracy.

    Each step is a projection of its own, so that Catalyst does not repeat the nested expressions.
    """
    e2 = 1 - (_AIRY_B / _AIRY_A) ** 2
    step = df.withColumns(
        {
            "_mu": (F.col(northing) - _N0 + _SCALE * _meridian_arc0()) / (_SCALE * _meridian_radius()),
            "_x": (F.col(easting) - _E0) / _SCALE,
        }
    )
    phi1 = F.col("_mu")
    for multiple, coefficient in _meridian_series().items():
        phi1 = phi1 + coefficient * F.sin(multiple * F.col("_mu"))
    step = step.withColumn("_p1", phi1)
    step = step.withColumns(
        {
            "_nu": _AIRY_A / F.sqrt(1 - e2 * F.pow(F.sin("_p1"), 2)),
            "_t": F.pow(F.tan("_p1"), 2),
            "_c": e2 / (1 - e2) * F.pow(F.cos("_p1"), 2),
        }
    )
    step = step.withColumns(
        {
            "_rho": F.col("_nu") * (1 - e2) / (1 - e2 * F.pow(F.sin("_p1"), 2)),
            "_d": F.col("_x") / F.col("_nu"),
        }
    )
    t, c, d, ep2 = F.col("_t"), F.col("_c"), F.col("_d"), e2 / (1 - e2)
    lat_terms = (
        F.pow(d, 2) / 2
        - (5 + 3 * t + 10 * c - 4 * c * c - 9 * ep2) * F.pow(d, 4) / 24
        + (61 + 90 * t + 298 * c + 45 * t * t - 252 * ep2 - 3 * c * c) * F.pow(d, 6) / 720
    )
    lon_terms = (
        d
        - (1 + 2 * t + c) * F.pow(d, 3) / 6
        + (5 - 2 * c + 28 * t - 3 * c * c + 8 * ep2 + 24 * t * t) * F.pow(d, 5) / 120
    )
    step = step.withColumns(
        {
            "_phi": F.col("_p1") - F.col("_nu") * F.tan("_p1") / F.col("_rho") * lat_terms,
            "_lam": math.radians(_LON0) + lon_terms / F.cos("_p1"),
        }
    )
    step = step.withColumn("_nu", _AIRY_A / F.sqrt(1 - e2 * F.pow(F.sin("_phi"), 2)))
    step = step.withColumns(
        {
            "_gx": F.col("_nu") * F.cos("_phi") * F.cos("_lam"),
            "_gy": F.col("_nu") * F.cos("_phi") * F.sin("_lam"),
            "_gz": F.col("_nu") * (1 - e2) * F.sin("_phi"),
        }
    )
    rx, ry, rz = (math.radians(angle / 3600) for angle in _ROTATION_ARCSEC)
    scale, (tx, ty, tz) = 1 + _SHIFT_PPM * 1e-6, _SHIFT_M
    gx, gy, gz = F.col("_gx"), F.col("_gy"), F.col("_gz")
    step = step.withColumns(
        {
            "_wx": tx + scale * gx - rz * gy + ry * gz,
            "_wy": ty + rz * gx + scale * gy - rx * gz,
            "_wz": tz - ry * gx + rx * gy + scale * gz,
        }
    )
    w2 = 1 - (_WGS_B / _WGS_A) ** 2
    step = step.withColumn("_r", F.sqrt(F.pow("_wx", 2) + F.pow("_wy", 2)))
    step = step.withColumn("_beta", F.atan2(F.col("_wz") * _WGS_A, F.col("_r") * _WGS_B))
    latitude = F.atan2(
        F.col("_wz") + w2 / (1 - w2) * _WGS_B * F.pow(F.sin("_beta"), 3),
        F.col("_r") - w2 * _WGS_A * F.pow(F.cos("_beta"), 3),
    )
    return step.withColumns(
        {lat: F.degrees(latitude), lon: F.degrees(F.atan2("_wy", "_wx"))}
    ).drop(
        "_mu", "_x", "_p1", "_nu", "_t", "_c", "_rho", "_d", "_phi", "_lam",
        "_gx", "_gy", "_gz", "_wx", "_wy", "_wz", "_r", "_beta",
    )
