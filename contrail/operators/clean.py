"""PL-3 clean_and_enrich and the keyed dedup / latest-row operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contrail.session import in_utc
from contrail.functions.labels import (
    blank_to_null, country_label, position_source_label, time_string,
)

# Column types state vectors are cast to (text from external sources is
# parsed with try_cast: null instead of an error under ANSI mode).
_DOUBLE_COLS = ["latitude", "longitude", "baro_altitude", "geo_altitude", "velocity",
                "true_track", "vertical_rate"]
_INT_COLS = ["position_source", "category"]


def keep_top_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key: the first by ``order``. ``row_number() = 1`` lets
    Spark plan a WindowGroupLimit on the map side, so duplicates of a hot
    key are cut down before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return (df.withColumn("_rn", F.row_number().over(w))
              .filter(F.col("_rn") == 1).drop("_rn"))


def dedup_latest_write(raw: DataFrame, order_col: str = "event_id") -> DataFrame:
    """U-2: one row per (icao24, snapshot_time); the highest ingest order
    wins (the upsert's last write). Rows with a null key are dropped (F-1)."""
    keyed = raw.filter(F.col("icao24").isNotNull() & F.col("snapshot_time").isNotNull())
    return keep_top_per_key(keyed, ["icao24", "snapshot_time"], ingest_order(raw, order_col))


def ingest_order(df: DataFrame, order_col: str = "event_id") -> list[Column]:
    """Newest write first: ``order_col`` if present, else the ingest
    sequence of the stream (micro-batch) and then the newer report."""
    if order_col in df.columns:
        return [F.col(order_col).desc()]
    order = [F.col(c).desc_nulls_last() for c in ("ingest_seq", "last_contact") if c in df.columns]
    return order or [F.col("snapshot_time")]  # no ingest order known: any row of the key


def _try_cast(c: str, dtype: str) -> Column:
    return F.col(c).try_cast(dtype)


@in_utc
def clean_and_enrich(raw: DataFrame, order_col: str = "event_id") -> DataFrame:
    """PL-3: dedup, normalise callsign and country, cast, add km/h, the
    position-source label and the ISO time string."""
    df = dedup_latest_write(raw, order_col)
    casts = {c: _try_cast(c, "double") for c in _DOUBLE_COLS}
    casts.update({c: _try_cast(c, "int") for c in _INT_COLS})
    df = df.withColumns({
        "callsign": blank_to_null(F.col("callsign")),
        "origin_country": country_label(F.col("origin_country")),
        **casts,
    })
    return df.withColumns({
        "velocity_kmh": F.round(F.col("velocity") * 3.6, 2),
        "position_source_label": position_source_label(F.col("position_source")),
        "snapshot_time_str": time_string(F.col("snapshot_time")),
    })


def latest_per_aircraft(clean: DataFrame) -> DataFrame:
    """W-4: the newest snapshot row of each aircraft (attributes taken from
    it even when they are null)."""
    return keep_top_per_key(clean, ["icao24"], [F.col("snapshot_time").desc()])


def latest_state_point_read(clean: DataFrame, icao24: str) -> DataFrame:
    """SRC-5: newest row of one aircraft (parameter trimmed, lower-cased)."""
    key = icao24.strip().lower()
    return clean.filter(F.col("icao24") == key).orderBy(F.col("snapshot_time").desc()).limit(1)
