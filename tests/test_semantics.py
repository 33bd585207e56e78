"""One test per observable rule of SURVEY section 1.4 (items 1-22)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from contrail.operators.clean import clean_and_enrich, latest_per_aircraft
from contrail.operators.events import detect_flight_events
from contrail.operators.graph import airport_nodes, build_graph, country_nodes, operates_edges
from contrail.operators.match import flight_events_table, match_airports
from contrail.operators.near import near_pairs
from contrail.schema import STATE_VECTORS
from tests.conftest import rows

SV = "event_id BIGINT, " + STATE_VECTORS
AP = ("icao_code STRING, iata_code STRING, name STRING, city STRING, country STRING, "
      "latitude DOUBLE, longitude DOUBLE, altitude_ft INT, type STRING")
T0 = dt.datetime(2024, 1, 1, 0, 0, 0)


def sv(spark, recs):
    """recs: dicts with a subset of the state vector columns."""
    cols = [c.strip().split(" ")[0] for c in SV.split(",")]
    data = [tuple(r.get(c) for c in cols) for r in recs]
    return spark.createDataFrame(data, SV)


def t(minutes, seconds=0.0):
    return T0 + dt.timedelta(minutes=minutes, seconds=seconds)


def test_item1_null_country_stays_null_blank_becomes_unknown(spark):
    raw = sv(spark, [
        dict(event_id=1, icao24="a", snapshot_time=t(0), origin_country=None),
        dict(event_id=2, icao24="b", snapshot_time=t(0), origin_country="  "),
        dict(event_id=3, icao24="c", snapshot_time=t(0), origin_country=" X "),
    ])
    clean = clean_and_enrich(raw)
    assert rows(clean, "icao24", "origin_country") == [("a", None), ("b", "Unknown"), ("c", "X")]
    assert rows(country_nodes(clean)) == [("Unknown",), ("X",)]
    ops = operates_edges(latest_per_aircraft(clean).select("icao24", "origin_country"))
    assert rows(ops) == [("Unknown", "b"), ("X", "c")]


def test_item2_blank_callsign_is_null(spark):
    raw = sv(spark, [dict(event_id=1, icao24="a", snapshot_time=t(0), callsign="   "),
                     dict(event_id=2, icao24="b", snapshot_time=t(0), callsign=" AB1 ")])
    assert rows(clean_and_enrich(raw), "icao24", "callsign") == [("a", None), ("b", "AB1")]


def test_item3_dedup_highest_ingest_order_wins(spark):
    raw = sv(spark, [dict(event_id=1, icao24="a", snapshot_time=t(0), velocity=1.0),
                     dict(event_id=5, icao24="a", snapshot_time=t(0), velocity=5.0),
                     dict(event_id=3, icao24="a", snapshot_time=t(0), velocity=3.0),
                     dict(event_id=4, icao24=None, snapshot_time=t(0), velocity=4.0)])
    assert rows(clean_and_enrich(raw), "icao24", "velocity") == [("a", 5.0)]


def _ground_seq(spark, seq, lat=50.0, lon=8.0):
    recs = []
    for i, g in enumerate(seq):
        recs.append(dict(event_id=i, icao24="a", snapshot_time=t(i), on_ground=g,
                         latitude=lat + i * 0.001, longitude=lon))
    return clean_and_enrich(sv(spark, recs))


def test_item4_lag_runs_after_null_removal(spark):
    ev = detect_flight_events(_ground_seq(spark, [True, None, False]), "b")
    out = ev.collect()
    assert len(out) == 1 and out[0].event_type == "TAKEOFF"
    assert out[0].gap_seconds == 120  # spans the null row


def test_item5_event_from_later_row_first_row_yields_nothing(spark):
    ev = detect_flight_events(_ground_seq(spark, [False, True, True, False]), "b")
    got = rows(ev, "event_type", "event_time", "latitude")
    assert got == [("LANDING", t(1), 50.001), ("TAKEOFF", t(3), 50.003)]


def test_item6_gap_truncates_each_side(spark):
    recs = [dict(event_id=1, icao24="a", snapshot_time=t(0, 0.9), on_ground=True, latitude=1.0, longitude=1.0),
            dict(event_id=2, icao24="a", snapshot_time=t(0, 2.1), on_ground=False, latitude=1.0, longitude=1.0)]
    ev = detect_flight_events(clean_and_enrich(sv(spark, recs)), "b").collect()
    assert ev[0].gap_seconds == 2  # 2 - 0, not int(1.2)


def test_split_window_equals_unsplit(pipe001):
    a = detect_flight_events(pipe001.clean, "b", split_unit="day")
    b = detect_flight_events(pipe001.clean, "b", split_unit=None)
    c = detect_flight_events(pipe001.clean, "b", split_unit="hour")
    assert rows(a) == rows(b) == rows(c)


def _airports(spark, recs):
    cols = [c.strip().split(" ")[0] for c in AP.split(",")]
    return spark.createDataFrame([tuple(r.get(c) for c in cols) for r in recs], AP)


def _events(spark, pts):
    data = [("e%d" % i, t(i), "TAKEOFF", lat, lon, 10, "b") for i, (lat, lon) in enumerate(pts)]
    return spark.createDataFrame(data, "icao24 STRING, event_time TIMESTAMP, event_type STRING, "
                                       "latitude DOUBLE, longitude DOUBLE, gap_seconds INT, batch_id STRING")


@pytest.mark.parametrize("cell_airports", [1_000, 1])  # whole cells, cells in parts
def test_item7_8_box_without_cos_and_vanishing_events(spark, cell_airports):
    ap = _airports(spark, [dict(icao_code="EAST", name="e", latitude=50.0, longitude=50.0 + 12 / 71.5)])
    # 12 km due east at 50N is 0.168 deg of longitude > 0.135 margin: missed -> NONE
    ev = _events(spark, [(50.0, 50.0)])
    m = match_airports(ev, ap, cell_airports=cell_airports).collect()
    assert [(r.airport_icao, r.confidence) for r in m] == [(None, "NONE")]
    # geodesic mode finds it
    g = match_airports(ev, ap, mode="geodesic", cell_airports=cell_airports).collect()
    assert g[0].airport_icao == "EAST" and g[0].confidence == "LOW"
    # box corner: inside the box, beyond 15 km -> the event disappears
    ap2 = _airports(spark, [dict(icao_code="CORN", name="c", latitude=10.13, longitude=10.13)])
    ev2 = _events(spark, [(10.0, 10.0)])
    assert match_airports(ev2, ap2, cell_airports=cell_airports).count() == 0
    # geodesic keeps it as NONE
    assert [r.confidence for r in match_airports(ev2, ap2, mode="geodesic",
                                                 cell_airports=cell_airports).collect()] == ["NONE"]


@pytest.mark.parametrize("cell_airports", [1_000, 1])
def test_item9_rank_ties_keep_both_event_table_keeps_lowest(spark, cell_airports):
    ap = _airports(spark, [dict(icao_code="B2", name="b", latitude=45.05, longitude=7.0),
                           dict(icao_code="A1", name="a", latitude=45.05, longitude=7.0),
                           dict(icao_code="C3", name="c", latitude=45.09, longitude=7.0)])
    ev = _events(spark, [(45.0, 7.0)])
    m = match_airports(ev, ap, cell_airports=cell_airports)
    assert sorted(r.airport_icao for r in m.collect()) == ["A1", "B2"]
    fe = flight_events_table(ev, ap, cell_airports=cell_airports).collect()
    assert [r.airport_icao for r in fe] == ["A1"]


def test_item10_11_rounding_and_confidence_bands(spark):
    from contrail.functions.labels import confidence_band
    df = spark.createDataFrame([(None,), (1.999,), (2.0,), (9.999,), (10.0,), (15.0,)], "d double")
    got = [r[0] for r in df.select(confidence_band(F.col("d"))).collect()]
    assert got == ["NONE", "HIGH", "MEDIUM", "MEDIUM", "LOW", "LOW"]
    # 15.0004 km rounds to 15.0 -> matched
    deg = 15.0004 / (6371.0 * 3.141592653589793 / 180.0)
    ap = _airports(spark, [dict(icao_code="N", name="n", latitude=20.0 + deg, longitude=5.0)])
    m = match_airports(_events(spark, [(20.0, 5.0)]), ap, mode="geodesic").collect()
    assert m[0].airport_icao == "N" and m[0].dist_km == 15.0


def _air(spark, recs):
    base = []
    for i, (icao, lat, lon, g, minute) in enumerate(recs):
        base.append(dict(event_id=i, icao24=icao, snapshot_time=t(minute), on_ground=g,
                         latitude=lat, longitude=lon))
    return clean_and_enrich(sv(spark, base))


def test_item10_12_near_rules(spark):
    d50 = 50.004 / (6371.0 * 3.141592653589793 / 180.0)
    clean = _air(spark, [
        ("b", 40.0, 3.0, False, 0), ("a", 40.0 + d50, 3.0, False, 0),   # 50.004 km: NEAR
        ("c", 40.0, 3.1, None, 0),                                       # null on_ground: excluded
        ("d", 40.0, 3.1, True, 0),                                       # on ground: excluded
        ("a", 40.0, 3.0, False, 5), ("b", 40.0, 3.2, False, 5),          # later snapshot of a-b
    ])
    obs = near_pairs(clean, grain="observation")
    assert rows(obs, "icao24_a", "icao24_b", "snapshot_time") == [("a", "b", t(0)), ("a", "b", t(5))]
    assert obs.filter(F.col("snapshot_time") == t(0)).first().dist_km == 50.0
    pair = near_pairs(clean).collect()
    assert len(pair) == 1 and pair[0].snapshot_time == t(5)
    assert pair[0].snapshot_time_str == "2024-01-01T00:05:00Z"


def test_near_antimeridian_and_pole(spark):
    clean = _air(spark, [("a", 10.0, 179.9, False, 0), ("b", 10.0, -179.9, False, 0),
                         ("c", 89.9, 0.0, False, 0), ("d", 89.9, 180.0, False, 0)])
    got = rows(near_pairs(clean), "icao24_a", "icao24_b")
    assert got == [("a", "b"), ("c", "d")]


def test_item13_flight_edges_idempotent_key(pipe001):
    fe = pipe001.graph.flight_edge
    assert fe.count() == fe.select("icao24", "event_time", "rel_type", "airport_icao").distinct().count()


def test_item18_19_snapshot_id_and_utc_string(spark):
    clean = _air(spark, [("a", 1.0, 1.0, True, 61)])
    g = build_graph(clean, match_airports(detect_flight_events(clean), _airports(spark, [])),
                    _airports(spark, []), near_pairs(clean))
    assert g.snapshot.first().id == "a_2024-01-01T01:01:00Z"
    assert g.snapshot.columns == ["id"]


def test_item22_aircraft_attributes_from_newest_even_if_null(spark):
    raw = sv(spark, [dict(event_id=1, icao24="a", snapshot_time=t(0), callsign="OLD", category=3),
                     dict(event_id=2, icao24="a", snapshot_time=t(1), callsign=None, category=None)])
    latest = latest_per_aircraft(clean_and_enrich(raw)).collect()
    assert latest[0].callsign is None and latest[0].category is None


def test_airport_nodes_dedup_and_null_key(spark):
    ap = _airports(spark, [dict(icao_code="X", name="b"), dict(icao_code="X", name="a"),
                           dict(icao_code=None, name="z")])
    assert rows(airport_nodes(ap), "icao", "name") == [("X", "a")]


def test_position_source_labels_and_kmh(spark):
    raw = sv(spark, [dict(event_id=i, icao24=str(i), snapshot_time=t(0), position_source=c, velocity=10.0)
                     for i, c in enumerate([0, 1, 2, 3, 4, None])])
    got = rows(clean_and_enrich(raw), "icao24", "position_source_label", "velocity_kmh")
    assert [g[1] for g in got] == ["ADS-B", "ASTERIX", "MLAT", "FLARM", "Unknown", "Unknown"]
    assert all(g[2] == 36.0 for g in got)
