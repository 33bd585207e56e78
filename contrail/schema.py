"""Declared schemas of the tables (DDL strings, Spark syntax)."""

from __future__ import annotations

# Raw landed snapshot: {"time": epoch seconds, "states": [[18 positional values], ...]}
SNAPSHOT_JSON = "time BIGINT, states ARRAY<ARRAY<STRING>>"

# state_vectors, key (icao24, snapshot_time). ``ingest_seq`` orders
# re-deliveries of one key: the highest wins.
STATE_VECTORS = (
    "icao24 STRING, snapshot_time TIMESTAMP, callsign STRING, origin_country STRING, "
    "time_position BIGINT, last_contact BIGINT, longitude DOUBLE, latitude DOUBLE, "
    "baro_altitude DOUBLE, on_ground BOOLEAN, velocity DOUBLE, true_track DOUBLE, "
    "vertical_rate DOUBLE, geo_altitude DOUBLE, squawk STRING, spi BOOLEAN, "
    "position_source INT, category INT"
)

STATE_VECTOR_COLUMNS = [c.strip().split(" ")[0] for c in STATE_VECTORS.split(",")]

# airports, key icao_code
AIRPORTS = (
    "icao_code STRING, iata_code STRING, name STRING, city STRING, country STRING, "
    "latitude DOUBLE, longitude DOUBLE, altitude_ft INT, type STRING"
)
AIRPORT_COLUMNS = [c.strip().split(" ")[0] for c in AIRPORTS.split(",")]

# flight_events, key (icao24, event_time, event_type); dist_km kept as an extra column
FLIGHT_EVENTS = (
    "icao24 STRING, event_time TIMESTAMP, event_type STRING, latitude DOUBLE, "
    "longitude DOUBLE, airport_icao STRING, airport_name STRING, confidence STRING, "
    "gap_seconds INT, batch_id STRING, dist_km DOUBLE"
)
FLIGHT_EVENT_COLUMNS = [c.strip().split(" ")[0] for c in FLIGHT_EVENTS.split(",")]

# Columns carried by the SNAPSHOT edge (observation values live on the edge).
SNAPSHOT_EDGE_PROPS = [
    "snapshot_time", "latitude", "longitude", "baro_altitude", "geo_altitude", "velocity",
    "velocity_kmh", "true_track", "vertical_rate", "on_ground", "squawk", "spi",
]

# Aircraft node attributes (from the newest snapshot).
AIRCRAFT_PROPS = ["callsign", "origin_country", "position_source", "position_source_label", "category"]
