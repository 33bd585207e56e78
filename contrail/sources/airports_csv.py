"""PL-2 / SRC-4 / F-9 / P-11: airport catalogue CSV -> airports table.

Consumed CSV columns: ident, type, name, latitude_deg, longitude_deg,
elevation_ft, iso_country, municipality, iata_code (all read as text).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.constants import AIRPORT_IDENT_LENGTH, AIRPORT_TYPES, REGION_BBOX
from contrail.functions.labels import blank_to_null
from contrail.sources.snapshots import in_region


def read_airport_csv(spark: SparkSession, path: str) -> DataFrame:
    """Header CSV, every column as text (no schema inference)."""
    return spark.read.option("header", True).option("mode", "PERMISSIVE").csv(path)


def normalize_airports(csv: DataFrame, types: list[str] | None = None,
                       bbox: tuple[float, float, float, float] | None = REGION_BBOX) -> DataFrame:
    """Keep large/medium airports with a 4-character ident and numeric
    coordinates inside the region box (inclusive; None = world); trim text,
    blank -> null; elevation truncated toward zero, unparsable -> null."""
    types = AIRPORT_TYPES if types is None else types
    ident = F.trim(F.col("ident"))
    lat = F.col("latitude_deg").try_cast("double")
    lon = F.col("longitude_deg").try_cast("double")
    kept = csv.filter(F.col("type").isin(*types) & (F.length(ident) == AIRPORT_IDENT_LENGTH)
                      & lat.isNotNull() & lon.isNotNull())
    if bbox is not None:
        kept = kept.filter(in_region(lat, lon, bbox))
    return kept.select(
        ident.alias("icao_code"),
        blank_to_null(F.col("iata_code")).alias("iata_code"),
        blank_to_null(F.col("name")).alias("name"),
        blank_to_null(F.col("municipality")).alias("city"),
        blank_to_null(F.col("iso_country")).alias("country"),
        lat.alias("latitude"),
        lon.alias("longitude"),
        F.col("elevation_ft").try_cast("double").try_cast("int").alias("altitude_ft"),
        blank_to_null(F.col("type")).alias("type"),
    )


def load_airports(spark: SparkSession, path: str, types: list[str] | None = None,
                  bbox: tuple[float, float, float, float] | None = REGION_BBOX) -> DataFrame:
    return normalize_airports(read_airport_csv(spark, path), types, bbox)
