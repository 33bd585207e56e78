"""Geospatial column expressions: haversine distance and the grid keys
that turn distance joins into equi-joins.

Everything is a native column expression, so it stays inside whole-stage
code generation; no Python worker is involved.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from contrail.constants import EARTH_RADIUS_KM, KM_PER_DEGREE_BOX

ColumnOrName = Column | str


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


def haversine_km(lat1: ColumnOrName, lon1: ColumnOrName, lat2: ColumnOrName,
                 lon2: ColumnOrName, decimals: int | None = None) -> Column:
    """Great-circle distance in km (R = 6371). Null if any input is null.
    With ``decimals`` the result is rounded (half up), as the match and
    proximity rules compare rounded distances."""
    lat1, lon1, lat2, lon2 = _c(lat1), _c(lon1), _c(lat2), _c(lon2)
    half_dphi = F.radians(lat2 - lat1) / 2.0
    half_dlam = F.radians(lon2 - lon1) / 2.0
    s_phi = F.sin(half_dphi)
    s_lam = F.sin(half_dlam)
    a = s_phi * s_phi + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * s_lam * s_lam
    d = F.lit(EARTH_RADIUS_KM) * 2.0 * F.atan2(F.sqrt(a), F.sqrt(1.0 - a))
    return F.round(d, decimals) if decimals is not None else d


def box_margin_deg(radius_km: float) -> float:
    """Bounding-box margin of the reference rule: radius / 111 degrees on
    both axes (no cos(latitude) correction)."""
    return radius_km / KM_PER_DEGREE_BOX


def in_box(lat: ColumnOrName, lon: ColumnOrName, center_lat: ColumnOrName,
           center_lon: ColumnOrName, margin_deg: float) -> Column:
    """Inclusive box test ``lat in [clat - m, clat + m] and lon in [clon - m, clon + m]``."""
    lat, lon, center_lat, center_lon = _c(lat), _c(lon), _c(center_lat), _c(center_lon)
    return (lat.between(center_lat - margin_deg, center_lat + margin_deg)
            & lon.between(center_lon - margin_deg, center_lon + margin_deg))


# ---------------------------------------------------------------------------
# Box grid: square cells of side >= 2 * margin, no wrap (the box test itself
# does not wrap at the antimeridian). A point's cell is unique; a box of
# half-side ``margin`` around a point touches at most 2 x 2 cells.
# ---------------------------------------------------------------------------

def box_cell_size(margin_deg: float) -> float:
    return 2.0 * margin_deg * 1.01


def box_cell(lat: ColumnOrName, lon: ColumnOrName, margin_deg: float) -> Column:
    """The single grid cell of a point, as ``struct(gy, gx)``."""
    size = box_cell_size(margin_deg)
    return F.struct(F.floor(_c(lat) / size).alias("gy"), F.floor(_c(lon) / size).alias("gx"))


def box_cells_touched(lat: ColumnOrName, lon: ColumnOrName, margin_deg: float) -> Column:
    """All cells that a box of half-side ``margin`` around the point touches
    (1, 2 or 4 distinct cells), as ``array<struct(gy, gx)>``. Any point whose
    box contains this point lies in one of them."""
    size = box_cell_size(margin_deg)
    reach = margin_deg * 1.001  # float slack; the exact box test runs afterwards
    lat, lon = _c(lat), _c(lon)
    ys = F.sequence(F.floor((lat - reach) / size), F.floor((lat + reach) / size))
    xs = F.sequence(F.floor((lon - reach) / size), F.floor((lon + reach) / size))
    return F.flatten(F.transform(ys, lambda y: F.transform(
        xs, lambda x: F.struct(y.alias("gy"), x.alias("gx")))))


# ---------------------------------------------------------------------------
# Radius grid: exact cover for "haversine(p, q) <= D".
#
# Latitude bands of width 2 * dlat, with dlat = D / R in degrees, the largest
# latitude difference of two points within D. Each band k has its own
# longitude grid whose cell width is at least 2 * dlon(k), where dlon(k) is
# the largest longitude difference of two points within D whose latitudes
# lie in band k widened by dlat. Longitude cells wrap at the antimeridian
# (cell index modulo the cell count); near the poles a band has one cell.
#
# A probe point p gets its single key (band, cell). A build point q is
# replicated to every key whose neighbourhood it can reach (at most 2 bands
# x 2 cells). Then every pair within D meets in exactly one key.
# ---------------------------------------------------------------------------

def _lat_half_width_deg(radius_km: float) -> float:
    # + small slack so that rounding of the distance and of floats is covered
    return math.degrees((radius_km + 0.01) / EARTH_RADIUS_KM) * 1.001


def radius_band_height(radius_km: float) -> float:
    return 2.0 * _lat_half_width_deg(radius_km)


def _band_lon_cells(band: Column, radius_km: float) -> tuple[Column, Column]:
    """(number of longitude cells, half-width in degrees) for band ``band``."""
    dlat = _lat_half_width_deg(radius_km)
    h = radius_band_height(radius_km)
    lo = band * h - dlat
    hi = (band + 1) * h + dlat
    phi_max = F.least(F.greatest(F.abs(lo), F.abs(hi)), F.lit(90.0))
    s = math.sin((radius_km + 0.01) / (2.0 * EARTH_RADIUS_KM)) * 1.001
    ratio = F.lit(s) / F.cos(F.radians(phi_max))
    # half-width of the reachable longitude range; >= 180 means "all"
    dlon = F.when((ratio >= 1.0) | ratio.isNull(), F.lit(180.0)).otherwise(
        F.degrees(2.0 * F.asin(ratio)) * 1.001)
    n = F.when(dlon >= 60.0, F.lit(1)).otherwise(
        F.greatest(F.lit(1), F.floor(F.lit(360.0) / (2.0 * dlon)).cast("int")))
    return n, dlon


def _lon_cell(lon: Column, n: Column) -> Column:
    width = F.lit(360.0) / n
    return F.pmod(F.floor((lon + 180.0) / width).cast("int"), n)


def radius_key(lat: ColumnOrName, lon: ColumnOrName, radius_km: float) -> Column:
    """Probe-side key of a point: ``struct(gy, gx)``."""
    lat, lon = _c(lat), _c(lon)
    band = F.floor(lat / radius_band_height(radius_km))
    n, _ = _band_lon_cells(band, radius_km)
    return F.struct(band.alias("gy"), _lon_cell(lon, n).cast("long").alias("gx"))


def radius_keys_reached(lat: ColumnOrName, lon: ColumnOrName, radius_km: float) -> Column:
    """Build-side keys of a point: every key whose probe points may lie
    within ``radius_km``, as ``array<struct(gy, gx)>`` without duplicates.
    (Array form, for small inputs; :func:`explode_radius_keys` is the
    generator form used on large inputs.)"""
    lat, lon = _c(lat), _c(lon)
    dlat = _lat_half_width_deg(radius_km)
    h = radius_band_height(radius_km)
    bands = F.sequence(F.floor((lat - dlat) / h), F.floor((lat + dlat) / h))

    def cells_for(band: Column) -> Column:
        n, dlon = _band_lon_cells(band, radius_km)
        first, last = _cell_range(lon, n, dlon)
        cells = F.transform(F.sequence(first, last), lambda c: F.pmod(c, n))
        return F.transform(cells, lambda c: F.struct(band.alias("gy"), c.cast("long").alias("gx")))

    return F.flatten(F.transform(bands, cells_for))


def _cell_range(lon: Column, n: Column, dlon: Column) -> tuple[Column, Column]:
    """Unwrapped cell indexes first..last covering [lon - dlon, lon + dlon].
    The cell width is >= 2 * dlon, so the range spans at most 2 cells, and
    for n >= 2 they stay distinct modulo n; n == 1 is a single cell."""
    width = F.lit(360.0) / n
    first = F.floor((lon - dlon + 180.0) / width).cast("int")
    last = F.floor((lon + dlon + 180.0) / width).cast("int")
    return first, F.when(n == 1, first).otherwise(F.greatest(first, last))


def explode_radius_keys(df, lat: str, lon: str, radius_km: float, gy: str = "gy", gx: str = "gx"):
    """``df`` with one row per build-side key of (lat, lon) in columns
    ``gy`` / ``gx`` (1-4 rows per input row). Two plain generators and
    arithmetic, so everything outside the generators is code-generated."""
    dlat = _lat_half_width_deg(radius_km)
    h = radius_band_height(radius_km)
    la, lo = F.col(lat), F.col(lon)
    with_band = df.withColumn(gy, F.explode(F.sequence(F.floor((la - dlat) / h), F.floor((la + dlat) / h))))
    n, dlon = _band_lon_cells(F.col(gy), radius_km)
    with_n = with_band.withColumns({"_n": n, "_dlon": dlon})
    first, last = _cell_range(lo, F.col("_n"), F.col("_dlon"))
    return (with_n.withColumn(gx, F.explode(F.sequence(first, last)))
                  .withColumn(gx, F.pmod(F.col(gx), F.col("_n")).cast("long"))
                  .drop("_n", "_dlon"))
