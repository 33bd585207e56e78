"""SRC-6: synthetic load rows (the load-test generator), built with
``spark.range`` so generation is distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail import constants as K


def synthetic_state_vectors(spark: SparkSession, n: int = K.LOAD_TEST_ROWS, seed: int = 42,
                            at: str | None = None) -> DataFrame:
    """``n`` airborne rows with random worldwide positions; icao24 is
    'stress-' + 6 hex characters, snapshot_time is ``at`` (or now)."""
    ts = F.to_timestamp(F.lit(at)) if at else F.current_timestamp()
    return (spark.range(n).select(
        # 6 hex characters, unique per row (ids beyond 16^6 wrap)
        F.concat(F.lit(K.LOAD_TEST_ICAO_PREFIX),
                 F.lpad(F.lower(F.hex(F.pmod(F.pmod(F.col("id"), F.lit(1 << 24)) * 2654435761 + seed, F.lit(1 << 24)))), 6, "0")
                 ).alias("icao24"),
        ts.alias("snapshot_time"),
        F.lit(K.LOAD_TEST_CALLSIGN).alias("callsign"),
        F.lit(K.LOAD_TEST_COUNTRY).alias("origin_country"),
        (F.rand(seed) * 360.0 - 180.0).alias("longitude"),
        (F.rand(seed + 1) * 180.0 - 90.0).alias("latitude"),
        F.lit(False).alias("on_ground"),
        F.col("id").alias("ingest_seq"),
    ))
