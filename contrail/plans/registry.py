"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Every callable derives its inputs from the driver's tables in ``sf_dir``
and runs the full pipeline up to the stage it returns; no row caps, id
subsets or samples. Point queries (Q4, Q11, the point read) pick their
aircraft from the data the way the analysis does (most tracked / most
events), inside the same plan.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from contrail.operators.clean import clean_and_enrich, dedup_latest_write
from contrail.operators.events import event_type_counts
from contrail.operators.graph import snapshot_nodes
from contrail.operators.match import confidence_counts, flight_events_table, match_airports
from contrail.operators.near import near_pairs
from contrail.plans import queries as Q
from contrail.plans import roundtrips as R
from contrail.plans.pipeline import pipeline_from_dir
from contrail.sources.fixtures import fixture_tables

Query = Callable[[SparkSession, str], DataFrame]


def _g(fn, **pipeline_kw):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(pipeline_from_dir(spark, sf_dir, **pipeline_kw).graph)
    return run


def _p(fn, **pipeline_kw):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(pipeline_from_dir(spark, sf_dir, **pipeline_kw))
    return run


def _raw(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        raw, airports = fixture_tables(spark, sf_dir)
        return fn(raw, airports)
    return run


def _point_read(p) -> DataFrame:
    who = Q.q4_most_tracked(p.graph).select("icao24")
    latest = p.clean.join(who.hint("broadcast"), "icao24", "left_semi")
    return latest.orderBy(latest["snapshot_time"].desc()).limit(1)


QUERIES: dict[str, Query] = {
    # fixtures and stages
    "airports_fixture": _raw(lambda raw, ap: ap),
    "state_vectors_raw": _raw(lambda raw, ap: raw),
    "dedup_latest": _raw(lambda raw, ap: dedup_latest_write(raw)),
    "clean_enrich": _raw(lambda raw, ap: clean_and_enrich(raw)),
    "aircraft_latest": _g(lambda g: g.aircraft),
    "country_nodes": _g(lambda g: g.country),
    "operates_edges": _g(lambda g: g.operates),
    "airport_nodes": _g(lambda g: g.airport),
    "snapshot_nodes": _p(lambda p: snapshot_nodes(p.clean)),
    "snapshot_edges": _g(lambda g: g.snapshot_edge),
    "flight_events": _p(lambda p: p.events),
    "airport_match": _p(lambda p: p.matched),
    "airport_match_geodesic": _p(lambda p: match_airports(p.events, p.airports, mode="geodesic")),
    "flight_events_table": _p(lambda p: flight_events_table(p.events, p.airports)),
    "confidence_counts": _p(lambda p: confidence_counts(p.matched)),
    "event_type_counts": _p(lambda p: event_type_counts(p.events)),
    "flight_edges": _g(lambda g: g.flight_edge),
    "near_observations": _p(lambda p: near_pairs(p.clean, grain="observation")),
    "near_pairs": _g(lambda g: g.near),
    # analytical queries
    "q1_top_countries": _g(Q.q1_top_countries),
    "q2_top_speed": _g(Q.q2_top_speed),
    "q3_proximity_hubs": _g(lambda g: Q.q3_proximity_hubs(g, one_row_per_pair=True)),
    "q3_proximity_hubs_obs": _g(Q.q3_proximity_hubs, near_grain="tally"),
    "q4_most_tracked": _g(Q.q4_most_tracked),
    "q4_trajectory": _g(Q.q4_trajectory_of_most_tracked),
    "q5_country_interactions": _g(Q.q5_country_interactions, near_countries=True),
    "q5_country_interactions_obs": _g(Q.q5_country_interactions, near_grain="count", near_countries=True),
    "q6_position_sources": _g(Q.q6_position_sources),
    "q7_departure_hotspots": _g(Q.q7_departure_hotspots),
    "q8_arrival_hotspots": _g(Q.q8_arrival_hotspots),
    "q9_top_routes": _g(Q.q9_top_routes),
    "q10_net_traffic": _g(Q.q10_net_traffic),
    "q11_most_events": _g(Q.q11_most_events),
    "q11_aircraft_history": _g(Q.q11_history_of_most_events),
    "graph_stats": _g(Q.graph_stats),
    "key_uniqueness": _p(lambda p: Q.key_uniqueness(p.graph, p.airports)),
    "edge_integrity": _g(Q.edge_integrity),
    "latest_state_point_read": _p(_point_read),
    # ingest side, end to end on data derived from the tables
    "snapshot_parse": R.snapshot_parse,
    "snapshot_parse_region": R.snapshot_parse_region,
    "airport_catalogue_rejects": R.airport_catalogue_rejects,
    "stream_ingest_twice": R.stream_ingest_twice,
    "airport_catalogue_csv": R.airport_catalogue_csv,
    "stream_ingest": R.stream_ingest,
    "reset_state_vectors": R.reset_state_vectors,
    # tables the batch job has written in two cycles
    "cycle_flight_events": R.cycle_flight_events,
    "cycle_flight_edges": R.cycle_flight_edges,
    "cycle_graph_stats": R.cycle_graph_stats,
    # tables three scheduled cycles have left, dates landing out of order
    "incremental_flight_events": R.incremental_flight_events,
    "incremental_flight_edges": lambda spark, sf_dir: R._ntz(R.incremental_graph(spark, sf_dir).flight_edge, "event_time"),
    "incremental_aircraft": lambda spark, sf_dir: R.incremental_graph(spark, sf_dir).aircraft,
    "incremental_near": lambda spark, sf_dir: R._ntz(R.incremental_graph(spark, sf_dir).near, "snapshot_time"),
    "incremental_graph_stats": lambda spark, sf_dir: Q.graph_stats(R.incremental_graph(spark, sf_dir)),
    "incremental_state_vectors": R.incremental_state_vectors,
    "incremental_point_read": R.incremental_point_read,
    # positions out of order, and too late
    "stream_flight_events": R.stream_flight_events,
    "stream_late_rows": R.stream_late_rows,
}
