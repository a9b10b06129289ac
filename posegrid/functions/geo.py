"""Geodesy and viewer-orientation expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from posegrid.functions import linalg as L

# WGS84 and UTM constants (fixed values)
EARTH_A = 6378137.0
EARTH_F = 1 / 298.257223563
EARTH_E2 = EARTH_F * (2 - EARTH_F)
UTM_A = 6378137.0
UTM_E2 = 0.00669438
UTM_K0 = 0.9996
FALSE_EASTING = 500000.0
FALSE_NORTHING = 10000000.0
#: camera height in metres when a track carries none
DEFAULT_HEIGHT = 1.8


def sfm_to_utm(v) -> Column:
    """(x east, y down, z north) to (x east, y north, z up)."""
    x, y, z = L.xyz(v)
    return L.vec(x, z, -y)


def utm_to_sfm(v) -> Column:
    x, y, z = L.xyz(v)
    return L.vec(x, -z, y)


# ------------------------------------------------------------------ UTM

def utm_zone(lon: Column, lat: Column) -> Column:
    """Zone number, with the widened zones of south-west Norway and Svalbard."""
    svalbard = (lat >= 72) & (lat <= 84) & (lon >= 0)
    plain = F.pmod(F.floor((lon + 180) / 6), F.lit(60)) + 1
    return (F.when((lat >= 56) & (lat < 64) & (lon >= 3) & (lon < 12), F.lit(32))
            .when(svalbard & (lon < 9), F.lit(31)).when(svalbard & (lon < 21), F.lit(33))
            .when(svalbard & (lon < 33), F.lit(35)).when(svalbard & (lon < 42), F.lit(37))
            .otherwise(plain).cast("int"))


def _meridian(zone: Column) -> Column:
    return F.radians((zone - 1) * 6 - 180 + 3)


def _meridian_arc(phi: Column) -> Column:
    e2, e4, e6 = UTM_E2, UTM_E2 ** 2, UTM_E2 ** 3
    return UTM_A * ((1 - e2 / 4 - 3 * e4 / 64 - 5 * e6 / 256) * phi
                    - (3 * e2 / 8 + 3 * e4 / 32 + 45 * e6 / 1024) * F.sin(2 * phi)
                    + (15 * e4 / 256 + 45 * e6 / 1024) * F.sin(4 * phi)
                    - (35 * e6 / 3072) * F.sin(6 * phi))


def to_utm(lon, lat, alt, zone: Column | None = None, south: Column | None = None) -> Column:
    """``struct<x, y, z, zone, south>``: transverse Mercator series of the UTM grid.

    ``zone`` and ``south`` put points on one grid: beyond a border of the zone eastings run on, and
    beyond the equator northings do."""
    lon, lat, alt = L._c(lon), L._c(lat), L._c(alt)
    zone = utm_zone(lon, lat) if zone is None else zone
    phi = F.radians(lat)
    ep2 = UTM_E2 / (1 - UTM_E2)
    nu = UTM_A / F.sqrt(1 - UTM_E2 * F.pow(F.sin(phi), 2))
    t = F.pow(F.tan(phi), 2)
    c = ep2 * F.pow(F.cos(phi), 2)
    turn = 2 * math.pi
    dlon = F.pmod(F.radians(lon) - _meridian(zone) + math.pi, F.lit(turn)) - math.pi
    a = F.cos(phi) * dlon
    east = UTM_K0 * nu * (a + (1 - t + c) * F.pow(a, 3) / 6
                          + (5 - 18 * t + t * t + 72 * c - 58 * ep2) * F.pow(a, 5) / 120)
    north = UTM_K0 * (_meridian_arc(phi) + nu * F.tan(phi) * (
        F.pow(a, 2) / 2 + (5 - t + 9 * c + 4 * c * c) * F.pow(a, 4) / 24
        + (61 - 58 * t + t * t + 600 * c - 330 * ep2) * F.pow(a, 6) / 720))
    south = lat < 0 if south is None else south
    return F.struct((east + FALSE_EASTING).alias("x"),
                    F.when(south, north + FALSE_NORTHING).otherwise(north).alias("y"),
                    alt.alias("z"), zone.alias("zone"), south.alias("south"))


def from_utm(x, y, z, zone, south) -> Column:
    """``struct<lon, lat, elev>`` of a point in a given zone and hemisphere."""
    x, y, z, zone, south = L._c(x), L._c(y), L._c(z), L._c(zone), L._c(south)
    e2 = UTM_E2
    ep2 = e2 / (1 - e2)
    root = math.sqrt(1 - e2)
    e1 = (1 - root) / (1 + root)
    north = F.when(south, y - FALSE_NORTHING).otherwise(y)
    mu = north / UTM_K0 / (UTM_A * (1 - e2 / 4 - 3 * e2 ** 2 / 64 - 5 * e2 ** 3 / 256))
    phi1 = (mu + (3 * e1 / 2 - 27 * e1 ** 3 / 32 + 269 * e1 ** 5 / 512) * F.sin(2 * mu)
            + (21 * e1 ** 2 / 16 - 55 * e1 ** 4 / 32) * F.sin(4 * mu)
            + (151 * e1 ** 3 / 96 - 417 * e1 ** 5 / 128) * F.sin(6 * mu)
            + (1097 * e1 ** 4 / 512) * F.sin(8 * mu))
    s2 = 1 - e2 * F.pow(F.sin(phi1), 2)
    nu = UTM_A / F.sqrt(s2)
    rho = (1 - e2) / s2
    t = F.pow(F.tan(phi1), 2)
    c = ep2 * F.pow(F.cos(phi1), 2)
    d = (x - FALSE_EASTING) / (nu * UTM_K0)
    lat = phi1 - (F.tan(phi1) / rho) * (
        F.pow(d, 2) / 2 - (5 + 3 * t + 10 * c - 4 * c * c - 9 * ep2) * F.pow(d, 4) / 24
        + (61 + 90 * t + 298 * c + 45 * t * t - 252 * ep2 - 3 * c * c) * F.pow(d, 6) / 720)
    lon = (d - (1 + 2 * t + c) * F.pow(d, 3) / 6
           + (5 - 2 * c + 28 * t - 3 * c * c + 8 * ep2 + 24 * t * t) * F.pow(d, 5) / 120) \
        / F.cos(phi1)
    turn = 2 * math.pi
    wrapped = F.pmod(lon + _meridian(zone) + math.pi, F.lit(turn)) - math.pi
    return F.struct(F.degrees(wrapped).alias("lon"), F.degrees(lat).alias("lat"), z.alias("elev"))


# ------------------------------------------------------------------ earth-centred

def to_ecef(lon, lat, alt) -> Column:
    lon, lat, alt = F.radians(L._c(lon)), F.radians(L._c(lat)), L._c(alt)
    n = EARTH_A / F.sqrt(1 - EARTH_E2 * F.pow(F.sin(lat), 2))
    return L.vec((n + alt) * F.cos(lat) * F.cos(lon), (n + alt) * F.cos(lat) * F.sin(lon),
                 (n * (1 - EARTH_E2) + alt) * F.sin(lat))


def from_ecef(x, y, z, rounds: int = 3) -> Column:
    """Inverse by Bowring's iteration on the parametric latitude."""
    x, y, z = L._c(x), L._c(y), L._c(z)
    b = EARTH_A * (1 - EARTH_F)
    ep2 = EARTH_E2 / (1 - EARTH_E2)
    p = F.sqrt(x * x + y * y)
    beta = F.atan2(z * EARTH_A, p * b)
    lat = None
    for _ in range(rounds):
        lat = F.atan2(z + ep2 * b * F.pow(F.sin(beta), 3),
                      p - EARTH_E2 * EARTH_A * F.pow(F.cos(beta), 3))
        beta = F.atan2((1 - EARTH_F) * F.sin(lat), F.cos(lat))
    n = EARTH_A / F.sqrt(1 - EARTH_E2 * F.pow(F.sin(lat), 2))
    alt = p * F.cos(lat) + z * F.sin(lat) - EARTH_A * EARTH_A / n
    return F.struct(F.degrees(F.atan2(y, x)).alias("lon"), F.degrees(lat).alias("lat"),
                    alt.alias("elev"))


# ------------------------------------------------------------------ orientation and entries

def viewer_angles(rotation) -> Column:
    """Viewer orientation ``struct<alpha, beta, gamma>`` in radians.

    Mirror the y axis, transpose, and read extrinsic y-x-z angles; alpha turns about x, beta about
    y, gamma about z.
    """
    sgn = (1.0, -1.0, 1.0)
    m = lambda i, j: L.entry(rotation, j, i) * F.lit(sgn[i] * sgn[j])
    # extrinsic y, x, z: M = Rz(g) Rx(a) Ry(b)
    alpha = F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), m(2, 1))))
    locked = F.abs(m(2, 1)) > 1 - 1e-12
    beta = F.when(locked, F.atan2(m(0, 2), m(0, 0))).otherwise(F.atan2(-m(2, 0), m(2, 2)))
    gamma = F.when(locked, F.lit(0.0)).otherwise(F.atan2(-m(0, 1), m(1, 1)))
    return F.struct(alpha.alias("alpha"), beta.alias("beta"), gamma.alias("gamma"))


def camera_height(position, footprint) -> Column:
    return F.coalesce(L.dist(position, footprint), F.lit(DEFAULT_HEIGHT))


def manual_transform(position, rotation, footprint, scale: float, yaw_deg: float,
                     north_east: tuple[float, float]) -> tuple[Column, Column, Column]:
    """Yaw, scale and shift a frame by hand; ``north_east`` moves z and x."""
    r = L.rotation_y(F.radians(F.lit(float(yaw_deg))))
    shift = L.vec(north_east[1], 0, north_east[0])
    move = lambda v: L.add(L.times(L.matvec(r, v), scale), shift)
    return move(position), L.matmul(rotation, L.transpose(r)), move(footprint)


def with_local_geo(df: DataFrame, position: str, lon0: float, lat0: float, elev0: float,
                   out: str) -> DataFrame:
    """Add lon, lat, elevation of local metres (x east, y down, z north) around a known origin."""
    o = to_utm(F.lit(lon0), F.lit(lat0), F.lit(elev0))
    x, y, z = L.xyz(position)
    staged = df.withColumn("_o", o).withColumns({
        "_e": F.col("_o.x") + x, "_n": F.col("_o.y") + z, "_z": F.col("_o.z") - y,
        "_zone": F.col("_o.zone"), "_south": F.col("_o.south")})
    return staged.withColumn(out, from_utm("_e", "_n", "_z", "_zone", "_south")) \
        .drop("_o", "_e", "_n", "_z", "_zone", "_south")


def geo_entry(geo, ms, height, angles) -> Column:
    """``[lon, lat, elev, utc_ms, height, alpha, beta, gamma]``."""
    geo, angles = L._c(geo), L._c(angles)
    return F.array(geo["lon"], geo["lat"], geo["elev"], L._c(ms).cast("double"), L._c(height),
                   angles["alpha"], angles["beta"], angles["gamma"])
