"""DuckDB SQL for every registered query: the brute-force definition
(naive distance joins, plain windows) over the driver's tables, used as
the correctness oracle. Common stages are CTEs prefixed ``f_``."""

from __future__ import annotations

from contrail import constants as K

BATCH = "20240101T000000Z"  # same as contrail.plans.pipeline.FIXED_BATCH_ID
GOOD = "('HIGH', 'MEDIUM')"


def hav(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    s_phi = f"sin(radians({lat2} - {lat1}) / 2e0)"
    s_lam = f"sin(radians({lon2} - {lon1}) / 2e0)"
    a = (f"({s_phi} * {s_phi} + cos(radians({lat1})) * cos(radians({lat2})) "
         f"* {s_lam} * {s_lam})")
    return f"(6371e0 * 2e0 * atan2(sqrt({a}), sqrt(1e0 - {a})))"


_LABEL_CASE = "CASE " + " ".join(
    f"WHEN position_source = {k} THEN '{v}'" for k, v in K.POSITION_SOURCE_LABELS.items()
) + " ELSE 'Unknown' END"

_M = "(15e0 / 111e0)"

CTES = {
    "f_airports": """
SELECT concat('A', lpad(CAST(s_suppkey AS VARCHAR), CAST(greatest(3, length(CAST(s_suppkey AS VARCHAR))) AS INT), '0')) AS icao_code,
       CASE WHEN s_suppkey % 7 = 0 THEN NULL
            ELSE concat('I', lpad(CAST(s_suppkey AS VARCHAR), CAST(greatest(3, length(CAST(s_suppkey AS VARCHAR))) AS INT), '0')) END AS iata_code,
       s_name AS name,
       concat('City ', CAST(s_suppkey % 13 AS VARCHAR)) AS city,
       n_name AS country,
       34.5e0 + CAST(((CASE WHEN s_suppkey = 9 THEN 8 ELSE s_suppkey END) * 41) % 371 AS DOUBLE) / 10e0 AS latitude,
       -24.5e0 + CAST(((CASE WHEN s_suppkey = 9 THEN 8 ELSE s_suppkey END) * 53) % 691 AS DOUBLE) / 10e0 AS longitude,
       CAST(floor(s_acctbal) AS INT) AS altitude_ft,
       CASE WHEN s_suppkey % 3 = 0 THEN 'large_airport' ELSE 'medium_airport' END AS type
FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "f_raw": """
SELECT event_id,
       lpad(lower(hex(user_id + 4096)), CAST(greatest(6, length(hex(user_id + 4096))) AS INT), '0') AS icao24,
       CAST(concat('2024-01-', lpad(CAST(day(ts) AS VARCHAR), 2, '0'), ' ',
                   lpad(CAST(CAST(floor(hour(ts) / 6e0) AS INT) * 6 AS VARCHAR), 2, '0'), ':00:00') AS TIMESTAMP) AS snapshot_time,
       CASE WHEN event_id % 11 = 0 THEN '   ' ELSE concat(' FL', CAST(user_id AS VARCHAR), ' ') END AS callsign,
       CASE WHEN user_id % 31 = 0 THEN NULL WHEN user_id % 29 = 0 THEN ' '
            ELSE concat('NATION_', CAST(user_id % 25 AS VARCHAR)) END AS origin_country,
       1704067200 + event_id AS time_position,
       1704067201 + event_id AS last_contact,
       CASE WHEN event_id % 89 = 0 THEN NULL
            ELSE -24.5e0 + CAST((k * 53) % 691 AS DOUBLE) / 10e0
                 + CAST(CAST(floor(event_id / 21e0) AS BIGINT) % 21 - 10 AS DOUBLE) * 0.014e0 END AS longitude,
       CASE WHEN event_id % 89 = 0 THEN NULL
            ELSE 34.5e0 + CAST((k * 41) % 371 AS DOUBLE) / 10e0
                 + CAST(event_id % 21 - 10 AS DOUBLE) * 0.014e0 END AS latitude,
       CASE WHEN event_type IN ('signup', 'error') THEN NULL ELSE value * 25e0 END AS baro_altitude,
       CASE WHEN event_id % 97 = 0 THEN NULL ELSE event_type IN ('signup', 'error') END AS on_ground,
       CASE WHEN event_id % 53 = 0 THEN NULL ELSE value END AS velocity,
       CAST(event_id % 360 AS DOUBLE) AS true_track,
       CAST(event_id % 41 - 20 AS DOUBLE) * 0.5e0 AS vertical_rate,
       value * 25e0 + 50e0 AS geo_altitude,
       lpad(CAST(event_id % 7777 AS VARCHAR), 4, '0') AS squawk,
       event_id % 101 = 0 AS spi,
       CAST(event_id % 6 AS INT) AS position_source,
       CAST(event_id % 21 AS INT) AS category
FROM (SELECT *, (user_id * 7 + (day(ts) - 1) * 3 + CAST(floor(hour(ts) / 6e0) AS BIGINT)) % 12 AS k
      FROM events) e""",
    "f_sv": """
SELECT * FROM f_raw WHERE icao24 IS NOT NULL AND snapshot_time IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY icao24, snapshot_time ORDER BY event_id DESC) = 1""",
    "f_clean": f"""
SELECT event_id, icao24, snapshot_time,
       nullif(trim(callsign), '') AS callsign,
       CASE WHEN trim(origin_country) = '' THEN 'Unknown' ELSE trim(origin_country) END AS origin_country,
       time_position, last_contact, longitude, latitude, baro_altitude, on_ground, velocity,
       true_track, vertical_rate, geo_altitude, squawk, spi, position_source, category,
       round(velocity * 3.6e0, 2) AS velocity_kmh,
       {_LABEL_CASE} AS position_source_label,
       strftime(snapshot_time, '%Y-%m-%dT%H:%M:%SZ') AS snapshot_time_str
FROM f_sv""",
    "f_lagged": """
SELECT icao24, snapshot_time, on_ground, latitude, longitude,
       lag(on_ground) OVER w AS prev_g, lag(snapshot_time) OVER w AS prev_t
FROM f_clean
WHERE on_ground IS NOT NULL AND latitude IS NOT NULL AND longitude IS NOT NULL
WINDOW w AS (PARTITION BY icao24 ORDER BY snapshot_time)""",
    "f_events": f"""
SELECT icao24, snapshot_time AS event_time,
       CASE WHEN prev_g AND NOT on_ground THEN 'TAKEOFF' ELSE 'LANDING' END AS event_type,
       latitude, longitude,
       CAST(CAST(floor(epoch(snapshot_time)) AS BIGINT) - CAST(floor(epoch(prev_t)) AS BIGINT) AS INTEGER) AS gap_seconds,
       '{BATCH}' AS batch_id
FROM f_lagged WHERE prev_g IS NOT NULL AND on_ground <> prev_g""",
    "f_cand": f"""
SELECT e.icao24, e.event_time, e.event_type, e.latitude, e.longitude, e.gap_seconds, e.batch_id,
       a.icao_code AS ap_icao, a.name AS ap_name,
       round({hav('e.latitude', 'e.longitude', 'a.latitude', 'a.longitude')}, 3) AS dist_km
FROM f_events e LEFT JOIN f_airports a
  ON a.latitude BETWEEN e.latitude - {_M} AND e.latitude + {_M}
 AND a.longitude BETWEEN e.longitude - {_M} AND e.longitude + {_M}""",
    "f_matched": """
SELECT icao24, event_time, event_type, latitude, longitude, ap_icao AS airport_icao,
       ap_name AS airport_name, dist_km,
       CASE WHEN dist_km IS NULL THEN 'NONE' WHEN dist_km < 2e0 THEN 'HIGH'
            WHEN dist_km < 10e0 THEN 'MEDIUM' ELSE 'LOW' END AS confidence,
       gap_seconds, batch_id
FROM f_cand WHERE dist_km IS NULL OR dist_km <= 15e0
QUALIFY rank() OVER (PARTITION BY icao24, event_time, event_type ORDER BY dist_km ASC NULLS LAST) = 1""",
    "f_cand_geo": f"""
SELECT e.icao24, e.event_time, e.event_type, e.latitude, e.longitude, e.gap_seconds, e.batch_id,
       a.icao_code AS ap_icao, a.name AS ap_name,
       round({hav('e.latitude', 'e.longitude', 'a.latitude', 'a.longitude')}, 3) AS dist_km
FROM f_events e LEFT JOIN f_airports a
  ON round({hav('e.latitude', 'e.longitude', 'a.latitude', 'a.longitude')}, 3) <= 15e0""",
    "f_matched_geo": """
SELECT icao24, event_time, event_type, latitude, longitude, ap_icao AS airport_icao,
       ap_name AS airport_name, dist_km,
       CASE WHEN dist_km IS NULL THEN 'NONE' WHEN dist_km < 2e0 THEN 'HIGH'
            WHEN dist_km < 10e0 THEN 'MEDIUM' ELSE 'LOW' END AS confidence,
       gap_seconds, batch_id
FROM f_cand_geo
QUALIFY rank() OVER (PARTITION BY icao24, event_time, event_type ORDER BY dist_km ASC NULLS LAST) = 1""",
    "f_air": """
SELECT icao24, snapshot_time, snapshot_time_str, latitude, longitude FROM f_clean
WHERE on_ground = false AND latitude IS NOT NULL AND longitude IS NOT NULL""",
    "f_near_obs": f"""
SELECT * FROM (
  SELECT a.icao24 AS icao24_a, b.icao24 AS icao24_b, a.snapshot_time, a.snapshot_time_str,
         round({hav('a.latitude', 'a.longitude', 'b.latitude', 'b.longitude')}, 2) AS dist_km
  FROM f_air a JOIN f_air b ON a.snapshot_time = b.snapshot_time AND a.icao24 < b.icao24) t
WHERE dist_km <= 50e0""",
    "f_near": """
SELECT * FROM f_near_obs
QUALIFY row_number() OVER (PARTITION BY icao24_a, icao24_b ORDER BY snapshot_time DESC) = 1""",
    "f_aircraft": """
SELECT icao24, callsign, origin_country, position_source, position_source_label, category
FROM f_clean QUALIFY row_number() OVER (PARTITION BY icao24 ORDER BY snapshot_time DESC) = 1""",
    "f_country": "SELECT DISTINCT origin_country AS name FROM f_clean WHERE origin_country IS NOT NULL",
    "f_operates": "SELECT origin_country AS country, icao24 FROM f_aircraft WHERE origin_country IS NOT NULL",
    "f_airport": """
SELECT icao_code AS icao, iata_code AS iata, name, city, country, latitude, longitude, altitude_ft, type
FROM f_airports WHERE icao_code IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY icao_code
                           ORDER BY name ASC NULLS LAST, iata_code ASC NULLS LAST, latitude, longitude) = 1""",
    "f_snapshot_edge": """
SELECT icao24, concat_ws('_', icao24, snapshot_time_str) AS snapshot_id, snapshot_time, latitude,
       longitude, baro_altitude, geo_altitude, velocity, velocity_kmh, true_track, vertical_rate,
       on_ground, squawk, spi
FROM f_clean""",
    "f_flight_edge": """
SELECT icao24, airport_icao,
       CASE WHEN event_type = 'TAKEOFF' THEN 'DEPARTED_FROM' WHEN event_type = 'LANDING' THEN 'ARRIVED_AT' END AS rel_type,
       event_time, confidence, gap_seconds, dist_km
FROM f_matched
WHERE airport_icao IS NOT NULL AND confidence <> 'NONE' AND airport_icao IN (SELECT icao FROM f_airport)""",
    "f_near_ends": """
SELECT icao24_a AS src, icao24_b AS dst, dist_km FROM f_near
UNION ALL SELECT icao24_b AS src, icao24_a AS dst, dist_km FROM f_near""",
    "f_near_obs_ends": """
SELECT icao24_a AS src, icao24_b AS dst, dist_km FROM f_near_obs
UNION ALL SELECT icao24_b AS src, icao24_a AS dst, dist_km FROM f_near_obs""",
}

# dependency order
_ORDER = list(CTES)


def with_ctes(body: str) -> str:
    """Prefix ``body`` with the CTEs it (transitively) uses."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in _ORDER:
            if name not in needed and _mentions(text, name):
                needed.add(name)
                visit(CTES[name])

    visit(body)
    parts = [f"{n} AS ({CTES[n]}\n)" for n in _ORDER if n in needed]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body


def _mentions(text: str, name: str) -> bool:
    import re
    return re.search(rf"\b{name}\b", text) is not None


def _q2() -> str:
    return """
SELECT s.icao24, a.callsign,
       round(avg(s.velocity) + 1e-9, 2) AS avg_velocity_ms,
       round(avg(s.velocity) * 3.6e0 + 1e-9, 2) AS avg_velocity_kmh,
       count(*) AS snapshots
FROM f_snapshot_edge s JOIN f_aircraft a ON a.icao24 = s.icao24
WHERE s.on_ground = false AND s.velocity IS NOT NULL
GROUP BY s.icao24, a.callsign HAVING count(*) >= 3
ORDER BY avg_velocity_ms DESC, s.icao24 LIMIT 10"""


def _q3(ends: str) -> str:
    return f"""
SELECT e.src AS icao24, a.callsign, count(DISTINCT e.dst) AS near_count,
       round(avg(e.dist_km) + 1e-9, 2) AS avg_dist_km
FROM {ends} e JOIN f_aircraft a ON a.icao24 = e.src
GROUP BY e.src, a.callsign ORDER BY near_count DESC, icao24 LIMIT 10"""


def _q5(ends: str) -> str:
    return f"""
SELECT o1.country AS country_a, o2.country AS country_b, count(*) AS interactions
FROM {ends} e JOIN f_operates o1 ON o1.icao24 = e.src JOIN f_operates o2 ON o2.icao24 = e.dst
WHERE o1.country <> o2.country
GROUP BY o1.country, o2.country ORDER BY interactions DESC, country_a, country_b LIMIT 15"""


def _hotspots(rel: str, measure: str) -> str:
    return f"""
SELECT ap.icao AS airport_icao, ap.iata AS airport_iata, ap.name AS airport_name, ap.city, ap.country,
       count(*) AS {measure}, count(DISTINCT r.icao24) AS unique_aircraft
FROM f_flight_edge r JOIN f_airport ap ON ap.icao = r.airport_icao
WHERE r.rel_type = '{rel}' AND r.confidence IN {GOOD}
GROUP BY ap.icao, ap.iata, ap.name, ap.city, ap.country
ORDER BY {measure} DESC, airport_icao LIMIT 20"""


_MOST_TRACKED = ("SELECT icao24, count(*) AS snapshots FROM f_snapshot_edge GROUP BY icao24 "
                 "ORDER BY snapshots DESC, icao24 LIMIT 1")
_MOST_EVENTS = ("SELECT icao24, count(*) AS n FROM f_flight_edge GROUP BY icao24 "
                "ORDER BY n DESC, icao24 LIMIT 1")

BODIES = {
    "airports_fixture": "SELECT * FROM f_airports",
    "state_vectors_raw": "SELECT * FROM f_raw",
    "dedup_latest": "SELECT * FROM f_sv",
    "clean_enrich": "SELECT * FROM f_clean",
    "aircraft_latest": "SELECT * FROM f_aircraft",
    "country_nodes": "SELECT * FROM f_country",
    "operates_edges": "SELECT * FROM f_operates",
    "airport_nodes": "SELECT * FROM f_airport",
    "snapshot_nodes": "SELECT concat_ws('_', icao24, snapshot_time_str) AS id FROM f_clean",
    "snapshot_edges": "SELECT * FROM f_snapshot_edge",
    "flight_events": "SELECT * FROM f_events",
    "airport_match": "SELECT * FROM f_matched",
    "airport_match_geodesic": "SELECT * FROM f_matched_geo",
    "flight_events_table": """
SELECT icao24, event_time, event_type, latitude, longitude, airport_icao, airport_name, confidence,
       gap_seconds, batch_id, dist_km
FROM f_matched
QUALIFY row_number() OVER (PARTITION BY icao24, event_time, event_type ORDER BY airport_icao ASC NULLS LAST) = 1""",
    "confidence_counts": "SELECT confidence, count(*) AS n FROM f_matched GROUP BY confidence",
    "event_type_counts": """
SELECT count(*) AS total, count(*) FILTER (WHERE event_type = 'TAKEOFF') AS takeoffs,
       count(*) FILTER (WHERE event_type = 'LANDING') AS landings FROM f_events""",
    "flight_edges": "SELECT * FROM f_flight_edge",
    "near_observations": "SELECT * FROM f_near_obs",
    "near_pairs": "SELECT * FROM f_near",
    "q1_top_countries": """
SELECT country, count(*) AS aircraft_count FROM f_operates GROUP BY country
ORDER BY aircraft_count DESC, country LIMIT 10""",
    "q2_top_speed": _q2(),
    "q3_proximity_hubs": _q3("f_near_ends"),
    "q3_proximity_hubs_obs": _q3("f_near_obs_ends"),
    "q4_most_tracked": _MOST_TRACKED,
    "q4_trajectory": f"""
SELECT strftime(snapshot_time, '%Y-%m-%dT%H:%M:%SZ') AS "timestamp", baro_altitude AS altitude_m,
       velocity AS velocity_ms, velocity_kmh, vertical_rate AS vertical_rate_ms, latitude, longitude,
       on_ground
FROM f_snapshot_edge
WHERE icao24 = (SELECT icao24 FROM ({_MOST_TRACKED}) t) AND baro_altitude IS NOT NULL
ORDER BY snapshot_time""",
    "q5_country_interactions": _q5("f_near_ends"),
    "q5_country_interactions_obs": _q5("f_near_obs_ends"),
    "q6_position_sources": """
SELECT position_source_label AS source_label, count(*) AS aircraft_count FROM f_aircraft
GROUP BY position_source_label ORDER BY aircraft_count DESC, source_label""",
    "q7_departure_hotspots": _hotspots("DEPARTED_FROM", "departures"),
    "q8_arrival_hotspots": _hotspots("ARRIVED_AT", "arrivals"),
    "q9_top_routes": f"""
SELECT o.icao AS origin_icao, o.iata AS origin_iata, o.city AS origin_city,
       d.icao AS dest_icao, d.iata AS dest_iata, d.city AS dest_city, count(*) AS flights
FROM f_flight_edge dep JOIN f_flight_edge arr ON dep.icao24 = arr.icao24
JOIN f_airport o ON o.icao = dep.airport_icao JOIN f_airport d ON d.icao = arr.airport_icao
WHERE dep.rel_type = 'DEPARTED_FROM' AND arr.rel_type = 'ARRIVED_AT'
  AND dep.event_time < arr.event_time
  AND dep.confidence IN {GOOD} AND arr.confidence IN {GOOD} AND o.icao <> d.icao
GROUP BY o.icao, o.iata, o.city, d.icao, d.iata, d.city
ORDER BY flights DESC, origin_icao, dest_icao LIMIT 25""",
    "q10_net_traffic": f"""
SELECT ap.icao, ap.iata, ap.name, ap.country,
       coalesce(d.n, 0) AS departures, coalesce(a.n, 0) AS arrivals,
       coalesce(d.n, 0) - coalesce(a.n, 0) AS net_flow
FROM f_airport ap
LEFT JOIN (SELECT airport_icao, count(*) AS n FROM f_flight_edge
           WHERE rel_type = 'DEPARTED_FROM' AND confidence IN {GOOD} GROUP BY airport_icao) d
  ON d.airport_icao = ap.icao
LEFT JOIN (SELECT airport_icao, count(*) AS n FROM f_flight_edge
           WHERE rel_type = 'ARRIVED_AT' AND confidence IN {GOOD} GROUP BY airport_icao) a
  ON a.airport_icao = ap.icao
WHERE coalesce(d.n, 0) + coalesce(a.n, 0) > 0
ORDER BY coalesce(d.n, 0) + coalesce(a.n, 0) DESC, ap.icao LIMIT 30""",
    "q11_most_events": _MOST_EVENTS,
    "q11_aircraft_history": f"""
SELECT r.rel_type AS event_type, r.event_time, ap.icao AS airport_icao, ap.iata AS airport_iata,
       ap.name AS airport_name, ap.city, ap.country, r.confidence, r.dist_km
FROM f_flight_edge r JOIN f_airport ap ON ap.icao = r.airport_icao
WHERE r.icao24 = (SELECT icao24 FROM ({_MOST_EVENTS}) t)
ORDER BY r.event_time""",
    "graph_stats": """
SELECT 'aircraft' AS entity, count(*) AS n FROM f_aircraft
UNION ALL SELECT 'countries', count(*) FROM f_country
UNION ALL SELECT 'airports', count(*) FROM f_airport
UNION ALL SELECT 'snapshots', count(*) FROM f_clean
UNION ALL SELECT 'operates', count(*) FROM f_operates
UNION ALL SELECT 'snapshot_edges', count(*) FROM f_snapshot_edge
UNION ALL SELECT 'near', count(*) FROM f_near
UNION ALL SELECT 'departed_from', count(*) FROM f_flight_edge WHERE rel_type = 'DEPARTED_FROM'
UNION ALL SELECT 'arrived_at', count(*) FROM f_flight_edge WHERE rel_type = 'ARRIVED_AT'""",
    "key_uniqueness": """
SELECT 'aircraft' AS entity, icao24 AS key, count(*) AS n FROM f_aircraft GROUP BY icao24 HAVING count(*) > 1
UNION ALL SELECT 'country', name, count(*) FROM f_country GROUP BY name HAVING count(*) > 1
UNION ALL SELECT 'airport', icao, count(*) FROM f_airport GROUP BY icao HAVING count(*) > 1
UNION ALL SELECT 'airport_catalogue', icao_code, count(*) FROM f_airports WHERE icao_code IS NOT NULL
          GROUP BY icao_code HAVING count(*) > 1""",
    "snapshot_parse": """
SELECT icao24, snapshot_time, callsign, origin_country, time_position, last_contact, longitude, latitude,
       baro_altitude, on_ground, velocity, true_track, vertical_rate, geo_altitude, squawk, spi,
       position_source, category FROM f_raw""",
    "snapshot_parse_region": """
SELECT icao24, snapshot_time, callsign, origin_country, time_position, last_contact, longitude, latitude,
       CASE WHEN event_id % 3 <> 0 THEN baro_altitude END AS baro_altitude,
       CASE WHEN event_id % 3 <> 0 THEN on_ground END AS on_ground,
       CASE WHEN event_id % 3 <> 0 AND event_id % 7 <> 0 THEN velocity END AS velocity,
       CASE WHEN event_id % 3 <> 0 THEN true_track END AS true_track,
       CASE WHEN event_id % 3 <> 0 THEN vertical_rate END AS vertical_rate,
       CASE WHEN event_id % 3 <> 0 THEN geo_altitude END AS geo_altitude,
       CASE WHEN event_id % 3 <> 0 THEN squawk END AS squawk, CASE WHEN event_id % 3 <> 0 THEN spi END AS spi,
       CASE WHEN event_id % 3 <> 0 THEN position_source END AS position_source,
       CASE WHEN event_id % 3 <> 0 THEN category END AS category
FROM f_raw WHERE latitude BETWEEN 40 AND 60 AND longitude BETWEEN -10 AND 20""",
    "airport_catalogue_rejects": """
SELECT icao_code, iata_code, name, CASE WHEN k % 3 = 0 THEN NULL ELSE city END AS city, country, latitude, longitude,
       CASE WHEN k % 4 = 0 THEN NULL ELSE altitude_ft END AS altitude_ft, type
FROM (SELECT *, CAST(substr(icao_code, 2) AS BIGINT) AS k FROM f_airports)
WHERE length(icao_code) = 4 AND k % 11 <> 0 AND k % 5 <> 0 AND k % 7 <> 0 AND k % 6 <> 0
  AND latitude BETWEEN 34 AND 72 AND longitude BETWEEN -25 AND 45""",
    "stream_ingest_twice": """
SELECT s.icao24, s.snapshot_time, s.callsign, s.origin_country, s.time_position, s.last_contact, s.longitude, s.latitude,
       s.baro_altitude, s.on_ground, s.velocity, s.true_track, s.vertical_rate, s.geo_altitude, s.squawk, s.spi,
       s.position_source, s.category, 2 * d.n AS deliveries
FROM f_sv s JOIN (SELECT icao24, snapshot_time, count(*) AS n FROM f_raw GROUP BY ALL) d
  ON s.icao24 = d.icao24 AND s.snapshot_time = d.snapshot_time""",
    "stream_ingest": """
SELECT icao24, snapshot_time, callsign, origin_country, time_position, last_contact, longitude, latitude,
       baro_altitude, on_ground, velocity, true_track, vertical_rate, geo_altitude, squawk, spi,
       position_source, category FROM f_sv""",
    "airport_catalogue_csv": """
SELECT a.icao_code, a.iata_code, a.name, a.city, a.country, a.latitude, a.longitude,
       CAST(trunc(s.s_acctbal) AS INT) AS altitude_ft, a.type
FROM f_airports a JOIN supplier s ON a.icao_code = concat('A', lpad(CAST(s.s_suppkey AS VARCHAR), CAST(greatest(3, length(CAST(s.s_suppkey AS VARCHAR))) AS INT), '0'))
WHERE length(a.icao_code) = 4""",
    "stream_flight_events": "SELECT * FROM f_events",
    # the first two days once more, for other aircraft, in the fifth batch
    "stream_late_rows": """
SELECT concat('late-', icao24) AS icao24, snapshot_time, on_ground, latitude, longitude, CAST(4 AS BIGINT) AS epoch
FROM f_clean WHERE day(snapshot_time) <= 2 AND on_ground IS NOT NULL AND latitude IS NOT NULL AND longitude IS NOT NULL""",
    "edge_integrity": """
SELECT 'operates.country' AS edge_end, count(*) AS missing FROM f_operates o WHERE o.country NOT IN (SELECT name FROM f_country)
UNION ALL SELECT 'operates.aircraft', count(*) FROM f_operates o WHERE o.icao24 NOT IN (SELECT icao24 FROM f_aircraft)
UNION ALL SELECT 'snapshot_edge.aircraft', count(*) FROM f_snapshot_edge e WHERE e.icao24 NOT IN (SELECT icao24 FROM f_aircraft)
UNION ALL SELECT 'snapshot_edge.snapshot', count(*) FROM f_snapshot_edge e
          WHERE e.snapshot_id NOT IN (SELECT concat_ws('_', icao24, snapshot_time_str) FROM f_clean)
UNION ALL SELECT 'near.a', count(*) FROM f_near n WHERE n.icao24_a NOT IN (SELECT icao24 FROM f_aircraft)
UNION ALL SELECT 'near.b', count(*) FROM f_near n WHERE n.icao24_b NOT IN (SELECT icao24 FROM f_aircraft)
UNION ALL SELECT 'flight_edge.aircraft', count(*) FROM f_flight_edge f WHERE f.icao24 NOT IN (SELECT icao24 FROM f_aircraft)
UNION ALL SELECT 'flight_edge.airport', count(*) FROM f_flight_edge f WHERE f.airport_icao NOT IN (SELECT icao FROM f_airport)""",
    "latest_state_point_read": f"""
SELECT * FROM f_clean WHERE icao24 = (SELECT icao24 FROM ({_MOST_TRACKED}) t)
ORDER BY snapshot_time DESC LIMIT 1""",
}

# what was written must read back as the stage gives it
BODIES |= {"cycle_flight_events": BODIES["flight_events_table"], "cycle_flight_edges": BODIES["flight_edges"],
           "cycle_graph_stats": BODIES["graph_stats"], "reset_state_vectors": BODIES["dedup_latest"],
           "incremental_flight_events": BODIES["flight_events_table"], "incremental_flight_edges": BODIES["flight_edges"],
           "incremental_aircraft": BODIES["aircraft_latest"], "incremental_near": BODIES["near_pairs"],
           "incremental_graph_stats": BODIES["graph_stats"], "incremental_state_vectors": BODIES["stream_ingest"],
           "incremental_point_read": f"""
SELECT * FROM ({BODIES["stream_ingest"]}) s WHERE icao24 = (SELECT icao24 FROM ({_MOST_TRACKED}) t)
ORDER BY snapshot_time DESC LIMIT 1"""}


def oracle_queries() -> dict[str, str]:
    return {name: with_ctes(body) for name, body in BODIES.items()}
