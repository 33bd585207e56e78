"""Scalar column rules of the data model (normalisation and labels)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from contrail import constants as K


def blank_to_null(c: Column) -> Column:
    """Trim; a blank result becomes null."""
    return F.nullif(F.trim(c), F.lit(""))


def country_label(c: Column) -> Column:
    """Trim; blank becomes "Unknown"; null stays null."""
    t = F.trim(c)
    return F.when(t == "", F.lit(K.BLANK_COUNTRY_LABEL)).otherwise(t)


def position_source_label(code: Column) -> Column:
    expr = None
    for value, label in K.POSITION_SOURCE_LABELS.items():
        expr = (F.when(code == value, F.lit(label)) if expr is None
                else expr.when(code == value, F.lit(label)))
    return expr.otherwise(F.lit(K.UNKNOWN_LABEL))


def confidence_band(dist_km: Column) -> Column:
    return (F.when(dist_km.isNull(), F.lit(K.CONF_NONE))
            .when(dist_km < K.CONF_HIGH_BELOW_KM, F.lit(K.CONF_HIGH))
            .when(dist_km < K.CONF_MEDIUM_BELOW_KM, F.lit(K.CONF_MEDIUM))
            .otherwise(F.lit(K.CONF_LOW)))


def event_type_of(prev_on_ground: Column, on_ground: Column) -> Column:
    return F.when(prev_on_ground & ~on_ground, F.lit(K.TAKEOFF)).otherwise(F.lit(K.LANDING))


def rel_type_of(event_type: Column) -> Column:
    return (F.when(event_type == K.TAKEOFF, F.lit(K.DEPARTED_FROM))
            .when(event_type == K.LANDING, F.lit(K.ARRIVED_AT)))


def time_string(ts: Column) -> Column:
    """ISO-8601 string with a literal Z; the session time zone is UTC."""
    return F.date_format(ts, K.SNAPSHOT_TIME_FORMAT)


def round_avg(c: Column, decimals: int = 2) -> Column:
    """round(avg(c), d) with exact ties rounded up regardless of float
    summation order (partial aggregates merge in any order)."""
    return F.round(F.avg(c) + F.lit(1e-9), decimals)


def normalize_icao(icao24: str) -> str:
    """Query parameters are lower-cased and trimmed before lookup."""
    return icao24.strip().lower()


def check_limit(limit: int, name: str = "limit") -> int:
    if not isinstance(limit, int) or isinstance(limit, bool):
        raise ValueError(f"{name} must be an integer, got {limit!r}")
    if not K.QUERY_LIMIT_MIN <= limit <= K.QUERY_LIMIT_MAX:
        raise ValueError(f"{name} must be in [{K.QUERY_LIMIT_MIN}, {K.QUERY_LIMIT_MAX}], got {limit}")
    return limit


def check_min_snapshots(n: int) -> int:
    if not isinstance(n, int) or isinstance(n, bool) or n < 1:
        raise ValueError(f"min_snapshots must be an integer >= 1, got {n!r}")
    return n
