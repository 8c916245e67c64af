"""Australian Albers (EPSG:3577) and the transverse Mercator zones, on columns or on arrays.

Conic equal-area formulas and Krueger's series on the GRS80 ellipsoid; degrees
to metres and back.  The datums GDA94, GDA2020 and WGS84 are taken for one.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass
from types import SimpleNamespace
from typing import Any

import numpy as np
from pyspark.sql import Column, functions as F

# Fixed values of the public EPSG:3577 definition.
SEMI_MAJOR = 6378137.0
INVERSE_FLATTENING = 298.257222101
PARALLEL_1 = -18.0
PARALLEL_2 = -36.0
LATITUDE_0 = 0.0
LONGITUDE_0 = 132.0

_F = 1.0 / INVERSE_FLATTENING
_E2 = 2.0 * _F - _F * _F
_E = math.sqrt(_E2)


def _q_number(lat: float) -> float:
    s = math.sin(lat)
    return (1 - _E2) * (s / (1 - _E2 * s * s) - math.log((1 - _E * s) / (1 + _E * s)) / (2 * _E))


def _m_number(lat: float) -> float:
    return math.cos(lat) / math.sqrt(1 - _E2 * math.sin(lat) ** 2)


_P1, _P2 = math.radians(PARALLEL_1), math.radians(PARALLEL_2)
CONE = (_m_number(_P1) ** 2 - _m_number(_P2) ** 2) / (_q_number(_P2) - _q_number(_P1))
SCALE = _m_number(_P1) ** 2 + CONE * _q_number(_P1)
RHO_0 = SEMI_MAJOR * math.sqrt(SCALE - CONE * _q_number(math.radians(LATITUDE_0))) / CONE
Q_POLE = _q_number(math.pi / 2)


def _q(sin_lat: Column) -> Column:
    s = sin_lat
    return F.lit(1 - _E2) * (
        s / (F.lit(1.0) - F.lit(_E2) * s * s)
        - F.log((F.lit(1.0) - F.lit(_E) * s) / (F.lit(1.0) + F.lit(_E) * s)) / F.lit(2 * _E)
    )


def albers_forward(lon: Column, lat: Column) -> tuple[Column, Column]:
    rho = F.lit(SEMI_MAJOR / CONE) * F.sqrt(F.lit(SCALE) - F.lit(CONE) * _q(F.sin(F.radians(lat))))
    theta = F.radians(lon - F.lit(LONGITUDE_0)) * F.lit(CONE)
    return rho * F.sin(theta), F.lit(RHO_0) - rho * F.cos(theta)


def albers_inverse(x: Column, y: Column, iterations: int = 3) -> tuple[Column, Column]:
    # The cone constant is negative in the south, so both legs change sign.
    sign = math.copysign(1.0, CONE)
    dx, dy = x * F.lit(sign), (F.lit(RHO_0) - y) * F.lit(sign)
    rho2 = (dx * dx + dy * dy) * F.lit((CONE / SEMI_MAJOR) ** 2)
    q = (F.lit(SCALE) - rho2) / F.lit(CONE)

    def refine(lat: Column, q: Column) -> Column:
        s = F.sin(lat)
        one = F.lit(1.0) - F.lit(_E2) * s * s
        return lat + one * one / (F.lit(2.0) * F.cos(lat)) * (
            q / F.lit(1 - _E2)
            - s / one
            + F.log((F.lit(1.0) - F.lit(_E) * s) / (F.lit(1.0) + F.lit(_E) * s)) / F.lit(2 * _E)
        )

    # A fold names each intermediate latitude, so the expression stays small.
    lat = F.aggregate(F.array_repeat(q, iterations), F.asin(q / F.lit(2.0)), refine)
    lon = F.lit(LONGITUDE_0) + F.degrees(F.atan2(dx, dy) / F.lit(CONE))
    return lon, F.degrees(lat)


def albers_inverse_arrays(x: np.ndarray, y: np.ndarray, iterations: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """`albers_inverse` on arrays."""
    sign = math.copysign(1.0, CONE)
    dx, dy = x * sign, (RHO_0 - y) * sign
    q = (SCALE - (dx * dx + dy * dy) * (CONE / SEMI_MAJOR) ** 2) / CONE
    lat = np.arcsin(q / 2.0)
    for _ in range(iterations):
        s = np.sin(lat)
        one = 1.0 - _E2 * s * s
        lat = lat + one * one / (2.0 * np.cos(lat)) * (
            q / (1 - _E2) - s / one + np.log((1.0 - _E * s) / (1.0 + _E * s)) / (2 * _E)
        )
    return LONGITUDE_0 + np.degrees(np.arctan2(dx, dy) / CONE), np.degrees(lat)


# ---- transverse Mercator -----------------------------------------------------------------------

# Fixed values of the public zone definitions: scale on the meridian, false easting, false northing in the south.
SCALE_0 = 0.9996
FALSE_EASTING = 500_000.0
FALSE_NORTHING = 10_000_000.0

_N = _F / (2.0 - _F)
# Radius of the sphere with the meridian's length.
RECTIFYING = SEMI_MAJOR / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
# The public series in the third flattening, for the way there, the way back, and the latitude.
ALPHA = (
    _N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16 + 41 * _N**4 / 180 - 127 * _N**5 / 288,
    13 * _N**2 / 48 - 3 * _N**3 / 5 + 557 * _N**4 / 1440 + 281 * _N**5 / 630,
    61 * _N**3 / 240 - 103 * _N**4 / 140 + 15061 * _N**5 / 26880,
    49561 * _N**4 / 161280 - 179 * _N**5 / 168,
    34729 * _N**5 / 80640,
)
BETA = (
    _N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96 - _N**4 / 360 - 81 * _N**5 / 512,
    _N**2 / 48 + _N**3 / 15 - 437 * _N**4 / 1440 + 46 * _N**5 / 105,
    17 * _N**3 / 480 - 37 * _N**4 / 840 - 209 * _N**5 / 4480,
    4397 * _N**4 / 161280 - 11 * _N**5 / 504,
    4583 * _N**5 / 161280,
)
DELTA = (
    2 * _N - 2 * _N**2 / 3 - 2 * _N**3 + 116 * _N**4 / 45 + 26 * _N**5 / 45,
    7 * _N**2 / 3 - 8 * _N**3 / 5 - 227 * _N**4 / 45 + 2704 * _N**5 / 315,
    56 * _N**3 / 15 - 136 * _N**4 / 35 - 1262 * _N**5 / 105,
    4279 * _N**4 / 630 - 332 * _N**5 / 35,
    4174 * _N**5 / 315,
)

_COLUMNS = SimpleNamespace(
    sin=F.sin, cos=F.cos, sinh=F.sinh, cosh=F.cosh, asin=F.asin, atan2=F.atan2, asinh=F.asinh, atanh=F.atanh, sqrt=F.sqrt,
    radians=F.radians, degrees=F.degrees, number=F.lit,
)
_ARRAYS = SimpleNamespace(
    sin=np.sin, cos=np.cos, sinh=np.sinh, cosh=np.cosh, asin=np.arcsin, atan2=np.arctan2, asinh=np.arcsinh, atanh=np.arctanh, sqrt=np.sqrt,
    radians=np.radians, degrees=np.degrees, number=float,
)


@dataclass(frozen=True)
class Zone:
    """A transverse Mercator zone: meridian in degrees, and whether northings count from the far south."""

    meridian: float
    south: bool

    def _of(self, value: Any) -> SimpleNamespace:
        return _COLUMNS if isinstance(value, Column) else _ARRAYS

    def forward(self, lon: Any, lat: Any) -> tuple[Any, Any]:
        """Degrees to (easting, northing); columns or arrays."""
        m = self._of(lon)
        s, along = m.sin(m.radians(lat)), m.radians(lon - m.number(self.meridian))
        t = m.sinh(m.atanh(s) - m.atanh(s * m.number(_E)) * m.number(_E))
        c = m.cos(along)
        xi, eta = m.atan2(t, c), m.asinh(m.sin(along) / m.sqrt(t * t + c * c))
        x, y = eta, xi
        for j, a in enumerate(ALPHA, 1):
            k = m.number(2.0 * j)
            x = x + m.cos(xi * k) * m.sinh(eta * k) * m.number(a)
            y = y + m.sin(xi * k) * m.cosh(eta * k) * m.number(a)
        radius = m.number(SCALE_0 * RECTIFYING)
        return x * radius + m.number(FALSE_EASTING), y * radius + m.number(FALSE_NORTHING if self.south else 0.0)

    def inverse(self, x: Any, y: Any) -> tuple[Any, Any]:
        """(easting, northing) to degrees."""
        m = self._of(x)
        radius = m.number(SCALE_0 * RECTIFYING)
        eta0, xi0 = (x - m.number(FALSE_EASTING)) / radius, (y - m.number(FALSE_NORTHING if self.south else 0.0)) / radius
        xi, eta = xi0, eta0
        for j, b in enumerate(BETA, 1):
            k = m.number(2.0 * j)
            xi = xi - m.sin(xi0 * k) * m.cosh(eta0 * k) * m.number(b)
            eta = eta - m.cos(xi0 * k) * m.sinh(eta0 * k) * m.number(b)
        conformal = m.asin(m.sin(xi) / m.cosh(eta))
        lat = conformal
        for j, d in enumerate(DELTA, 1):
            lat = lat + m.sin(conformal * m.number(2.0 * j)) * m.number(d)
        return m.degrees(m.atan2(m.sinh(eta), m.cos(xi))) + m.number(self.meridian), m.degrees(lat)


# Codes in degrees, the projection itself, and the code families of zones as (first code, zones, south).
GEOGRAPHIC = ("EPSG:4326", "EPSG:4283", "EPSG:7844")
PROJECTED = "EPSG:3577"
ZONES = ((32600, range(1, 61), False), (32700, range(1, 61), True), (28300, range(48, 59), True), (7800, range(46, 60), True))


def zone_of(crs: str) -> Zone | None:
    """The zone of a code such as EPSG:28355, or None if it is not one of the known families."""
    number = re.fullmatch(r"EPSG:(\d+)", crs)
    for first, zones, south in ZONES:
        if number and int(number[1]) - first in zones:
            return Zone(6.0 * (int(number[1]) - first) - 183.0, south)
    return None


def check_crs(crs: str | None) -> str:
    """The code itself, EPSG:3577 for null; an unknown one is an error, for its numbers would be read as metres."""
    if crs is None:
        return PROJECTED
    if crs != PROJECTED and crs not in GEOGRAPHIC and zone_of(crs) is None:
        raise ValueError(f"unknown coordinate system {crs!r}: known are {PROJECTED}, {', '.join(GEOGRAPHIC)} and UTM or MGA zones")
    return crs


def to_albers(x: Column, y: Column, crs: str | None) -> tuple[Column, Column]:
    """Coordinates of a known system as EPSG:3577."""
    crs = check_crs(crs)
    if crs == PROJECTED:
        return x, y
    zone = zone_of(crs)
    return albers_forward(*(zone.inverse(x, y) if zone else (x, y)))


def from_albers(x: Any, y: Any, crs: str | None) -> tuple[Any, Any]:
    """EPSG:3577 as coordinates of a known system; columns or arrays."""
    crs = check_crs(crs)
    if crs == PROJECTED:
        return x, y
    lon, lat = albers_inverse(x, y) if isinstance(x, Column) else albers_inverse_arrays(x, y)
    zone = zone_of(crs)
    return zone.forward(lon, lat) if zone else (lon, lat)
