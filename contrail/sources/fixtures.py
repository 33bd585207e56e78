"""Deterministic derivation of airports and raw state vectors from the
driver's tables (supplier, nation, events), so every query has an oracle.

Both are plain projections / one broadcast-free equi-join; they scale with
the input tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.sources.tables import read_table


def padded(c, width: int):
    """``c`` as a string of at least ``width`` digits; longer values keep
    all their digits."""
    s = c.cast("string")
    return F.lpad(s, F.greatest(F.lit(width), F.length(s)), F.lit("0"))


def airports_from_suppliers(supplier: DataFrame, nation: DataFrame) -> DataFrame:
    """One airport per supplier; airports of suppliers 8 and 9 share a
    position on purpose (equidistant candidates)."""
    k = F.col("s_suppkey")
    k_pos = F.when(k == 9, F.lit(8)).otherwise(k)
    return (
        supplier.join(nation, supplier.s_nationkey == nation.n_nationkey)
        .select(
            F.concat(F.lit("A"), padded(k, 3)).alias("icao_code"),
            F.when(k % 7 == 0, F.lit(None).cast("string"))
             .otherwise(F.concat(F.lit("I"), padded(k, 3))).alias("iata_code"),
            F.col("s_name").alias("name"),
            F.concat(F.lit("City "), (k % 13).cast("string")).alias("city"),
            F.col("n_name").alias("country"),
            (F.lit(34.5) + ((k_pos * 41) % 371).cast("double") / 10.0).alias("latitude"),
            (F.lit(-24.5) + ((k_pos * 53) % 691).cast("double") / 10.0).alias("longitude"),
            F.floor("s_acctbal").cast("int").alias("altitude_ft"),
            F.when(k % 3 == 0, F.lit("large_airport")).otherwise(F.lit("medium_airport")).alias("type"),
        )
    )


def state_vectors_from_events(events: DataFrame) -> DataFrame:
    """Raw state vectors (with key collisions) from the events table.
    ``event_id`` is kept as the ingest order: the highest id of a key wins."""
    eid = F.col("event_id")
    uid = F.col("user_id")
    slot = F.floor(F.hour("ts") / 6.0)
    k = (uid * 7 + (F.dayofmonth("ts") - 1) * 3 + slot) % 12
    ground_types = F.col("event_type").isin("signup", "error")
    return (
        events.select(
            eid.alias("event_id"),
            padded(F.lower(F.hex(uid + 4096)), 6).alias("icao24"),
            F.make_timestamp_ntz(F.lit(2024), F.lit(1), F.dayofmonth("ts"),
                                 (slot * 6).cast("int"), F.lit(0), F.lit(0)).alias("snapshot_time"),
            F.when(eid % 11 == 0, F.lit("   "))
             .otherwise(F.concat(F.lit(" FL"), uid.cast("string"), F.lit(" "))).alias("callsign"),
            F.when(uid % 31 == 0, F.lit(None).cast("string"))
             .when(uid % 29 == 0, F.lit(" "))
             .otherwise(F.concat(F.lit("NATION_"), (uid % 25).cast("string"))).alias("origin_country"),
            (F.lit(1704067200) + eid).alias("time_position"),
            (F.lit(1704067201) + eid).alias("last_contact"),
            F.when(eid % 89 == 0, F.lit(None).cast("double")).otherwise(
                F.lit(-24.5) + ((k * 53) % 691).cast("double") / 10.0
                + (F.floor(eid / 21.0) % 21 - 10).cast("double") * 0.014).alias("longitude"),
            F.when(eid % 89 == 0, F.lit(None).cast("double")).otherwise(
                F.lit(34.5) + ((k * 41) % 371).cast("double") / 10.0
                + (eid % 21 - 10).cast("double") * 0.014).alias("latitude"),
            F.when(ground_types, F.lit(None).cast("double"))
             .otherwise(F.col("value") * 25.0).alias("baro_altitude"),
            F.when(eid % 97 == 0, F.lit(None).cast("boolean")).otherwise(ground_types).alias("on_ground"),
            F.when(eid % 53 == 0, F.lit(None).cast("double")).otherwise(F.col("value")).alias("velocity"),
            (eid % 360).cast("double").alias("true_track"),
            ((eid % 41 - 20).cast("double") * 0.5).alias("vertical_rate"),
            (F.col("value") * 25.0 + 50.0).alias("geo_altitude"),
            F.lpad((eid % 7777).cast("string"), 4, "0").alias("squawk"),
            (eid % 101 == 0).alias("spi"),
            (eid % 6).cast("int").alias("position_source"),
            (eid % 21).cast("int").alias("category"),
        )
    )


def fixture_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(raw state vectors, airports) derived from the tables in ``sf_dir``."""
    raw = state_vectors_from_events(read_table(spark, sf_dir, "events"))
    airports = airports_from_suppliers(read_table(spark, sf_dir, "supplier"),
                                       read_table(spark, sf_dir, "nation"))
    return raw, airports
