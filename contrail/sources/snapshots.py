"""PL-1 / SRC-2 / SRC-3: landed snapshot JSON -> state vector rows.

A snapshot is ``{"time": epoch seconds, "states": [[...18 positional
values...], ...]}``. Read with the schema ``time BIGINT, states
ARRAY<ARRAY<STRING>>`` (mixed JSON scalars arrive as text, null stays
null), one row per state after ``explode``; a short inner array is padded
with null (``get`` returns null past the end); text is parsed with
``try_cast`` so a bad value becomes null instead of failing the batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.constants import STATE_VECTOR_FIELDS
from contrail.schema import SNAPSHOT_JSON

_TYPES = {
    "icao24": None, "callsign": None, "origin_country": None,
    "time_position": "bigint", "last_contact": "bigint",
    "longitude": "double", "latitude": "double", "baro_altitude": "double",
    "on_ground": "boolean", "velocity": "double", "true_track": "double",
    "vertical_rate": "double", "geo_altitude": "double", "squawk": None,
    "spi": "boolean", "position_source": "int", "category": "int",
}
_DROPPED = {"sensors"}  # parsed by the source but never stored


def read_snapshot_files(spark: SparkSession, path: str) -> DataFrame:
    """Batch read of landed snapshot files (one JSON document per line)."""
    return spark.read.schema(SNAPSHOT_JSON).json(path)


def _field(v: Column, name: str) -> Column:
    raw = F.get(v, STATE_VECTOR_FIELDS.index(name))
    dtype = _TYPES[name]
    return (raw.try_cast(dtype) if dtype else raw).alias(name)


def in_region(lat: Column, lon: Column, bbox: tuple[float, float, float, float] | None) -> Column:
    """SRC-3: inclusive (lat_min, lon_min, lat_max, lon_max) box; None = world."""
    if bbox is None:
        return F.lit(True)
    lat_min, lon_min, lat_max, lon_max = bbox
    return lat.between(lat_min, lat_max) & lon.between(lon_min, lon_max)


def parse_snapshots(snapshots: DataFrame, bbox: tuple[float, float, float, float] | None = None,
                    seq: Column | None = None) -> DataFrame:
    """Snapshot documents -> state_vectors rows. ``snapshot_time`` is the
    document's ``time`` (epoch seconds, UTC). ``seq`` (optional) becomes the
    ``ingest_seq`` column that orders re-deliveries of one key."""
    rows = (snapshots.filter(F.col("time").isNotNull())
                     .select(F.timestamp_seconds("time").alias("snapshot_time"),
                             F.explode("states").alias("_v"),
                             *([seq.alias("ingest_seq")] if seq is not None else [])))
    cols = [_field(F.col("_v"), n) for n in STATE_VECTOR_FIELDS if n not in _DROPPED]
    out = rows.select("snapshot_time", *cols, *(["ingest_seq"] if seq is not None else []))
    ordered = ["icao24", "snapshot_time"] + [c for c in out.columns if c not in ("icao24", "snapshot_time")]
    out = out.select(*ordered)
    return out.filter(in_region(F.col("latitude"), F.col("longitude"), bbox)) if bbox else out


def snapshots_from_state_vectors(sv: DataFrame, chunks: int | None = None) -> DataFrame:
    """The inverse of :func:`parse_snapshots` (used to land test input):
    state vectors as snapshot documents. With ``chunks`` the states of one
    snapshot time are split into that many documents by a hash of icao24;
    by default every state is its own document, so no document grows with
    the data."""
    def txt(c: str) -> Column:
        return F.col(c).cast("string")

    state = F.array(*[F.lit(None).cast("string") if n in _DROPPED else txt(n) for n in STATE_VECTOR_FIELDS])
    rows = sv.select(F.unix_timestamp("snapshot_time").alias("time"), state.alias("_s"),
                     F.pmod(F.xxhash64("icao24"), F.lit(chunks or 1)).alias("_chunk"))
    if chunks is None:
        return rows.select("time", F.array("_s").alias("states"))
    return (rows.groupBy("time", "_chunk").agg(F.collect_list("_s").alias("states"))
                .select("time", "states"))
