"""Web Mercator and UTM as closed-form column arithmetic."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridcensus.functions.grid import MERCATOR_HALF

# WGS84 radius, eccentricity and the third-order Krueger series (Karney 2011).
EARTH_RADIUS = 6378137.0
ECCENTRICITY = 0.0818191908426215
UTM_SCALE = 0.9996
RECTIFYING_RADIUS = 6367449.145823415
KRUEGER = (8.377318206244698e-4, 7.608527773572307e-7, 1.197645503329453e-9)
FALSE_EASTING = 500000.0
FALSE_NORTHING_SOUTH = 10000000.0


def mercator_x(lon: Column) -> Column:
    return F.lit(MERCATOR_HALF) * lon / F.lit(180.0)


def mercator_y(lat: Column) -> Column:
    return F.lit(EARTH_RADIUS) * F.ln(F.tan(F.lit(math.pi / 4) + F.radians(lat) / F.lit(2.0)))


def mercator_lon(x: Column) -> Column:
    return x * F.lit(180.0) / F.lit(MERCATOR_HALF)


def mercator_lat(y: Column) -> Column:
    angle = F.lit(2.0) * F.atan(F.exp(y / F.lit(EARTH_RADIUS))) - F.lit(math.pi / 2)
    return F.degrees(angle)


def utm_zone(lon: Column) -> Column:
    """Plain six-degree zone, 1 to 60."""
    zone = F.floor((lon + F.lit(180.0)) / F.lit(6.0)).cast("int") + 1
    return F.greatest(F.lit(1), F.least(F.lit(60), zone))


def utm_central_meridian(zone: Column) -> Column:
    return zone * F.lit(6.0) - F.lit(183.0)


def utm_plane(lon: Column, lat: Column, central_meridian: Column) -> tuple[Column, Column]:
    """Transverse Mercator easting and northing without the false origin."""
    sin_lat = F.sin(F.radians(lat))
    delta = F.radians(lon - central_meridian)
    e = F.lit(ECCENTRICITY)
    one, half = F.lit(1.0), F.lit(0.5)
    psi = half * F.ln((one + sin_lat) / (one - sin_lat)) - e * half * F.ln(
        (one + e * sin_lat) / (one - e * sin_lat)
    )
    t = F.sinh(psi)
    xi = F.atan2(t, F.cos(delta))
    eta = F.atanh(F.sin(delta) / F.sqrt(one + t * t))
    easting, northing = eta, xi
    for j, a in enumerate(KRUEGER, start=1):
        k = F.lit(2.0 * j)
        easting = easting + F.lit(a) * F.cos(k * xi) * F.sinh(k * eta)
        northing = northing + F.lit(a) * F.sin(k * xi) * F.cosh(k * eta)
    scale = F.lit(UTM_SCALE * RECTIFYING_RADIUS)
    return scale * easting, scale * northing


def utm_coordinates(lon: Column, lat: Column, zone: Column, south: Column) -> tuple[Column, Column]:
    """UTM easting and northing with the usual false origin."""
    easting, northing = utm_plane(lon, lat, utm_central_meridian(zone))
    shift = F.when(south, F.lit(FALSE_NORTHING_SOUTH)).otherwise(F.lit(0.0))
    return easting + F.lit(FALSE_EASTING), northing + shift
