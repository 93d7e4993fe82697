"""Map projections as Catalyst expressions on the WGS 84 ellipsoid.

Polar stereographic north (3413) and south (3031), UTM (326zz, 327zz) and plain degrees (4326).  The formulas are the
published closed forms (variant B polar stereographic, Krüger series to n⁶ for transverse Mercator), so projecting is
a JVM-side projection that Spark can code-generate: no CRS library, no Python worker.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

# The WGS 84 ellipsoid.
SEMI_MAJOR = 6378137.0
FLATTENING = 1 / 298.257223563
E2 = FLATTENING * (2 - FLATTENING)
ECC = math.sqrt(E2)


class PolarSystem(NamedTuple):
    """Polar stereographic system: latitude of true scale, straight-down meridian, +1 north or -1 south."""

    lat_ts: float
    lon0: float
    side: int


# The polar systems by EPSG code.
POLAR_SYSTEMS = {3413: PolarSystem(70.0, -45.0, 1), 3031: PolarSystem(-71.0, 0.0, -1)}
GEOGRAPHIC = 4326

# UTM scale, false origin, and the Krüger coefficients in the third flattening n.
UTM_SCALE = 0.9996
UTM_EASTING = 500000.0
UTM_SOUTH_NORTHING = 10000000.0
_N = FLATTENING / (2 - FLATTENING)
RECTIFYING_RADIUS = SEMI_MAJOR / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
ALPHA = (
    _N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16 + 41 * _N**4 / 180 - 127 * _N**5 / 288 + 7891 * _N**6 / 37800,
    13 * _N**2 / 48 - 3 * _N**3 / 5 + 557 * _N**4 / 1440 + 281 * _N**5 / 630 - 1983433 * _N**6 / 1935360,
    61 * _N**3 / 240 - 103 * _N**4 / 140 + 15061 * _N**5 / 26880 + 167603 * _N**6 / 181440,
    49561 * _N**4 / 161280 - 179 * _N**5 / 168 + 6601661 * _N**6 / 7257600,
    34729 * _N**5 / 80640 - 3418889 * _N**6 / 1995840,
    212378941 * _N**6 / 319334400,
)
BETA = (
    _N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96 - _N**4 / 360 - 81 * _N**5 / 512 + 96199 * _N**6 / 604800,
    _N**2 / 48 + _N**3 / 15 - 437 * _N**4 / 1440 + 46 * _N**5 / 105 - 1118711 * _N**6 / 3870720,
    17 * _N**3 / 480 - 37 * _N**4 / 840 - 209 * _N**5 / 4480 + 5569 * _N**6 / 90720,
    4397 * _N**4 / 161280 - 11 * _N**5 / 504 - 830251 * _N**6 / 7257600,
    4583 * _N**5 / 161280 - 108847 * _N**6 / 3991680,
    20648693 * _N**6 / 638668800,
)
# Fixed value: the easting, in radii of the rectifying sphere, up to which a point has a place; the series have no sum far beyond.
UTM_REACH = 2.623395162778
# Series from conformal to geodetic latitude, coefficients of sin 2χ, 4χ, 6χ, 8χ, 10χ; to n⁵, as the fourth
# power alone leaves 1e-11 degrees.
DELTA = (
    2 * _N - 2 * _N**2 / 3 - 2 * _N**3 + 116 * _N**4 / 45 + 26 * _N**5 / 45,
    7 * _N**2 / 3 - 8 * _N**3 / 5 - 227 * _N**4 / 45 + 2704 * _N**5 / 315,
    56 * _N**3 / 15 - 136 * _N**4 / 35 - 1262 * _N**5 / 105,
    4279 * _N**4 / 630 - 332 * _N**5 / 35,
    4174 * _N**5 / 315,
)


def polar_scale(lat_ts: float) -> float:
    """Metres of radius per unit of isometric co-latitude."""
    phi = math.radians(abs(lat_ts))
    m = math.cos(phi) / math.sqrt(1 - E2 * math.sin(phi) ** 2)
    es = ECC * math.sin(phi)
    t = math.tan(math.pi / 4 - phi / 2) / ((1 - es) / (1 + es)) ** (ECC / 2)
    return SEMI_MAJOR * m / t


def _wrapped(degrees: Column) -> Column:
    return F.when(degrees > 180, degrees - 360).when(degrees < -180, degrees + 360).otherwise(degrees)


def _inline(value: Column, body):
    return body(value)


def _bound(value: Column, body):
    """``body`` of a value computed once: a one-element array keeps the optimizer from copying the value's expression."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _pair(a: Column, b: Column) -> Column:
    return F.struct(a.alias("a"), b.alias("b"))


def polar_xy(lon: Column, lat: Column, system: PolarSystem, let=_inline) -> tuple[Column, Column]:
    """Projected metres in a polar stereographic system."""

    def rho(phi: Column) -> Column:
        es = ECC * F.sin(phi)
        return F.tan(math.pi / 4 - phi / 2) / F.pow((1 - es) / (1 + es), F.lit(ECC / 2)) * polar_scale(system.lat_ts)

    radius = let(F.radians(lat * system.side), rho)
    dlon = F.radians(lon - system.lon0)
    return radius * F.sin(dlon), radius * F.cos(dlon) * (-system.side)


def polar_lonlat(x: Column, y: Column, system: PolarSystem, let=_inline) -> tuple[Column, Column]:
    """Degrees of a point in a polar stereographic system."""
    chi = math.pi / 2 - 2 * F.atan(F.hypot(x, y) / polar_scale(system.lat_ts))
    lat = F.degrees(let(chi, lambda c: c + _sine_series(DELTA, c))) * system.side
    lon = system.lon0 + F.degrees(F.atan2(x, y * (-system.side)))
    return let(lon, _wrapped), lat


def _sine_series(coefficients: tuple[float, ...], angle: Column) -> Column:
    """Sum of c_j·sin(2j·angle)."""
    terms = [c * F.sin(2 * j * angle) for j, c in enumerate(coefficients, start=1)]
    return reduce(lambda a, b: a + b, terms)


def _transverse_series(coefficients: tuple[float, ...], xi: Column, eta: Column) -> tuple[Column, Column]:
    """Real and imaginary part of the sum of c_j·sin(2j·(ξ + iη))."""
    pairs = [(c, 2 * j * xi, 2 * j * eta) for j, c in enumerate(coefficients, start=1)]
    real = reduce(lambda a, b: a + b, [c * F.sin(u) * F.cosh(w) for c, u, w in pairs])
    imaginary = reduce(lambda a, b: a + b, [c * F.cos(u) * F.sinh(w) for c, u, w in pairs])
    return real, imaginary


def utm_xy(lon: Column, lat: Column, zone: Column, south: Column, let=_inline) -> tuple[Column, Column]:
    """Easting and northing in a UTM zone."""
    q = 2 * math.sqrt(_N) / (1 + _N)
    t = let(F.sin(F.radians(lat)), lambda s: F.sinh(F.atanh(s) - q * F.atanh(q * s)))
    on_sphere = let(
        _pair(t, F.radians(lon - (zone * 6 - 183))),
        lambda p: _pair(F.atan2(p["a"], F.cos(p["b"])), F.atanh(F.sin(p["b"]) / F.sqrt(1 + p["a"] * p["a"]))),
    )

    def stretched(p: Column) -> Column:
        real, imaginary = _transverse_series(ALPHA, p["a"], p["b"])
        return _pair(p["a"] + real, p["b"] + imaginary)

    flat = let(on_sphere, stretched)
    k = UTM_SCALE * RECTIFYING_RADIUS
    return UTM_EASTING + k * flat["b"], F.when(south, UTM_SOUTH_NORTHING).otherwise(0.0) + k * flat["a"]


def utm_lonlat(x: Column, y: Column, zone: Column, south: Column, let=_inline) -> tuple[Column, Column]:
    """Degrees of a point in a UTM zone; NULL for eastings beyond ``UTM_REACH``, where there is no place."""
    k = UTM_SCALE * RECTIFYING_RADIUS
    held = F.when(F.abs(x - UTM_EASTING) <= UTM_REACH * k, x)
    flat = _pair((y - F.when(south, UTM_SOUTH_NORTHING).otherwise(0.0)) / k, (held - UTM_EASTING) / k)

    def shrunk(p: Column) -> Column:
        real, imaginary = _transverse_series(BETA, p["a"], p["b"])
        return _pair(p["a"] - real, p["b"] - imaginary)

    on_sphere = let(flat, shrunk)
    chi = let(on_sphere, lambda p: F.asin(F.sin(p["a"]) / F.cosh(p["b"])))
    turn = let(on_sphere, lambda p: F.atan2(F.sinh(p["b"]), F.cos(p["a"])))
    return zone * 6 - 183 + F.degrees(turn), F.degrees(let(chi, lambda c: c + _sine_series(DELTA, c)))


def _is_utm(epsg: int) -> bool:
    return 32601 <= epsg <= 32660 or 32701 <= epsg <= 32760


# Up to this many systems are told apart by a flat CASE; more of them by one dispatch with bound values.
FLAT_SYSTEMS = 3


def _in_system(a: Column, b: Column, epsg: int, polar, utm) -> tuple[Column, Column]:
    if epsg == GEOGRAPHIC:
        return a, b
    if epsg in POLAR_SYSTEMS:
        return polar(a, b, POLAR_SYSTEMS[epsg])
    if _is_utm(epsg):
        return utm(a, b, F.lit(epsg % 100), F.lit(epsg // 100 == 327))
    raise ValueError(f"EPSG:{epsg} is not one of the systems known here")


def _by_system(a: Column, b: Column, epsg: int | Column, polar, utm, systems: Sequence[int] | None) -> tuple[Column, Column]:
    if isinstance(epsg, int):
        return _in_system(a, b, epsg, polar, utm)
    # Whatever the form, a code that is missing, unknown or not in the list gives NULL.
    listed = None if systems is None else [s for s in systems if s == GEOGRAPHIC or s in POLAR_SYSTEMS or _is_utm(s)]
    if listed and all(_is_utm(s) for s in listed):
        x, y = utm(a, b, F.pmod(epsg, F.lit(100)), epsg > 32700)
        held = epsg.isin(listed)
        return F.when(held, x), F.when(held, y)
    if listed and len(listed) <= FLAT_SYSTEMS:
        known = [(epsg == s, _in_system(a, b, s, polar, utm)) for s in listed]
        x, y = (F.when(known[0][0], known[0][1][i]) for i in (0, 1))
        for test, (px, py) in known[1:]:
            x, y = x.when(test, px), y.when(test, py)
        return x, y

    # Branches are outside common-subexpression elimination, so inside them values are bound instead of repeated.
    def chosen(p: Column) -> Column:
        u, v, code = p["a"], p["b"], p["code"]
        out = F.when(code == GEOGRAPHIC, _pair(u, v))
        for known, system in POLAR_SYSTEMS.items():
            out = out.when(code == known, _pair(*polar(u, v, system, _bound)))
        zonal = utm(u, v, F.pmod(code, F.lit(100)), code > 32700, _bound)
        return out.when(code.between(32601, 32660) | code.between(32701, 32760), _pair(*zonal))

    given = F.struct(a.cast("double").alias("a"), b.cast("double").alias("b"), epsg.cast("int").alias("code"))
    pair = _bound(given, chosen)
    return pair["a"], pair["b"]


def project(
    lon: Column, lat: Column, epsg: int | Column, systems: Sequence[int] | None = None
) -> tuple[Column, Column]:
    """Degrees to the coordinates of a system given as a number or, row by row, as a column (NULL if unknown).

    ``systems`` lists the codes the column can hold, if that is known: the expression then covers only those.
    """
    return _by_system(lon, lat, epsg, polar_xy, utm_xy, systems)


def unproject(x: Column, y: Column, epsg: int | Column, systems: Sequence[int] | None = None) -> tuple[Column, Column]:
    """Coordinates of a system back to degrees."""
    return _by_system(x, y, epsg, polar_lonlat, utm_lonlat, systems)


def utm_zone(lon: Column, lat: Column) -> Column:
    """UTM zone number with the exceptions for south-west Norway and Svalbard."""
    # The zone exceptions of the UTM grid (56-64N 3-12E is 32; 72-84N uses 31, 33, 35, 37).
    plain = F.floor((lon + 180) / 6).cast("int") % 60 + 1
    svalbard = lat.between(72, 84) & (lon >= 0) & (lon < 42)
    return (
        F.when((lat >= 56) & (lat < 64) & (lon >= 3) & (lon < 12), 32)
        .when(svalbard & (lon < 9), 31)
        .when(svalbard & (lon < 21), 33)
        .when(svalbard & (lon < 33), 35)
        .when(svalbard, 37)
        .otherwise(plain)
    )


def working_epsg(lon: Column, lat: Column) -> Column:
    """System for even spacing near a place: polar beyond 65 degrees, else the UTM zone."""
    zone = utm_zone(lon, lat)
    return F.when(lat < -65, 3031).when(lat > 65, 3413).when(lat >= 0, zone + 32600).otherwise(zone + 32700)


def offset_metres(dx: Column, dy: Column) -> Column:
    """Distance from the place asked for to the cell returned."""
    return F.sqrt(dx * dx + dy * dy)
