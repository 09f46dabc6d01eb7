"""Column functions for band maths, masks, thresholds and map projection."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestar.functions.strings import ColumnOrName, _col

# Binarisation threshold of the alteration map.
DEFAULT_THRESHOLD = 0.3
# Vegetation ratio limit (red-edge / red) used by the default mask.
VEGETATION_RATIO_LIMIT = 1.35


def normalized_difference(a: ColumnOrName, b: ColumnOrName) -> Column:
    """``(a - b) / (a + b)``; a zero denominator gives NULL."""
    a, b = _col(a), _col(b)
    return F.try_divide(a - b, a + b)


def argillic_index(b4: ColumnOrName = "b4", b6: ColumnOrName = "b6") -> Column:
    """Default argillic-alteration index: normalized difference of SWIR bands 4 and 6."""
    return normalized_difference(b4, b6)


def vegetation_mask(b3: ColumnOrName = "b3", b2: ColumnOrName = "b2",
                    limit: float = VEGETATION_RATIO_LIMIT) -> Column:
    """True where the pixel is *not* vegetated: ``b3 / b2 <= limit``.

    A zero red band (NULL ratio) counts as masked out.
    """
    return F.coalesce(F.try_divide(_col(b3), _col(b2)) <= F.lit(limit), F.lit(False))


def binary_threshold(v: ColumnOrName, threshold: float = DEFAULT_THRESHOLD) -> Column:
    """1 where ``v >= threshold``, 0 below, NULL for no-data (NULL or NaN)."""
    v = _col(v)
    return (F.when(v.isNull() | F.isnan(v.cast("double")), F.lit(None))
            .when(v >= F.lit(float(threshold)), F.lit(1))
            .otherwise(F.lit(0))).cast("int")


class TransverseMercator:
    """Transverse-Mercator forward projection (Snyder 1987 series) as column arithmetic.

    Accurate within a few degrees of the central meridian (a UTM zone).
    """

    # WGS 84 ellipsoid and UTM zone 38N parameters.
    A = 6378137.0
    F = 1 / 298.257223563
    CENTRAL_MERIDIAN = 45.0
    K0 = 0.9996
    FALSE_EASTING = 500000.0
    FALSE_NORTHING = 0.0

    def __init__(self, central_meridian: float | None = None, k0: float | None = None,
                 false_easting: float | None = None, false_northing: float | None = None,
                 a: float | None = None, f: float | None = None, latitude_of_origin: float = 0.0,
                 unit: float = 1.0, angle: float = 1.0):
        """Parameters in degrees and metres; ``unit`` (metres) is that of the result, ``angle`` (degrees) that of the input."""
        self.a = a if a is not None else self.A
        f = f if f is not None else self.F
        self.lon0 = central_meridian if central_meridian is not None else self.CENTRAL_MERIDIAN
        self.k0 = k0 if k0 is not None else self.K0
        self.fe = false_easting if false_easting is not None else self.FALSE_EASTING
        self.fn = false_northing if false_northing is not None else self.FALSE_NORTHING
        e2 = f * (2 - f)
        self.e2 = e2
        self.ep = e2 / (1 - e2)
        self.deg = math.pi / 180.0
        self.m1 = 1 - e2 / 4 - 3 * e2 ** 2 / 64 - 5 * e2 ** 3 / 256
        self.m2 = 3 * e2 / 8 + 3 * e2 ** 2 / 32 + 45 * e2 ** 3 / 1024
        self.m3 = 15 * e2 ** 2 / 256 + 45 * e2 ** 3 / 1024
        self.m4 = 35 * e2 ** 3 / 3072
        self.unit, self.angle = unit, angle
        ph0 = latitude_of_origin * self.deg
        self.arc0 = self.a * (self.m1 * ph0 - self.m2 * math.sin(2 * ph0) + self.m3 * math.sin(4 * ph0)
                              - self.m4 * math.sin(6 * ph0))

    def constants(self) -> dict[str, float]:
        """The double constants by name."""
        return {"a": self.a, "e2": self.e2, "ep": self.ep, "deg": self.deg, "lon0": self.lon0,
                "k0": self.k0, "fe": self.fe, "fn": self.fn,
                "m1": self.m1, "m2": self.m2, "m3": self.m3, "m4": self.m4}

    def project(self, lon: ColumnOrName, lat: ColumnOrName) -> tuple[Column, Column]:
        """``(easting, northing)`` for longitude/latitude (by default metres and degrees)."""
        L = F.lit
        lon, lat = _col(lon), _col(lat)
        if self.angle != 1.0:
            lon, lat = lon * L(self.angle), lat * L(self.angle)
        ph = lat * L(self.deg)
        dl = (lon - L(self.lon0)) * L(self.deg)
        sp, cp, tp = F.sin(ph), F.cos(ph), F.tan(ph)
        n = L(self.a) / F.sqrt(L(1.0) - L(self.e2) * sp * sp)
        t = tp * tp
        c = L(self.ep) * cp * cp
        aa = dl * cp
        m = L(self.a) * (L(self.m1) * ph - L(self.m2) * F.sin(L(2.0) * ph)
                         + L(self.m3) * F.sin(L(4.0) * ph) - L(self.m4) * F.sin(L(6.0) * ph))
        if self.arc0:
            m = m - L(self.arc0)
        a2 = aa * aa
        a3 = a2 * aa
        a4 = a3 * aa
        a5 = a4 * aa
        a6 = a5 * aa
        east = L(self.fe) + L(self.k0) * n * (
            aa + (L(1.0) - t + c) * a3 / L(6.0)
            + (L(5.0) - L(18.0) * t + t * t + L(72.0) * c - L(58.0) * L(self.ep)) * a5 / L(120.0))
        north = L(self.fn) + L(self.k0) * (m + n * tp * (
            a2 / L(2.0)
            + (L(5.0) - t + L(9.0) * c + L(4.0) * c * c) * a4 / L(24.0)
            + (L(61.0) - L(58.0) * t + t * t + L(600.0) * c - L(330.0) * L(self.ep)) * a6 / L(720.0)))
        return (east, north) if self.unit == 1.0 else (east / L(self.unit), north / L(self.unit))


def project_utm(lon: ColumnOrName, lat: ColumnOrName,
                projection: TransverseMercator | None = None) -> tuple[Column, Column]:
    """Project lon/lat to the configured UTM zone (default: zone 38N on WGS 84)."""
    return (projection or TransverseMercator()).project(lon, lat)
