"""PL-8: the batch job from state vectors + airports to node and edge
tables, and the lazy form used by the registered queries."""

from __future__ import annotations

import os
import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.constants import AIRPORT_RADIUS_KM, BATCH_ID_FORMAT, NEAR_RADIUS_KM
from contrail.operators.clean import clean_and_enrich, latest_per_aircraft
from contrail.operators.events import detect_flight_events
from contrail.operators.graph import Graph, aircraft_nodes, build_graph, operates_edges
from contrail.operators.match import match_airports, match_both
from contrail.operators.near import airborne_positions, block, blocks_of, dense_cells, near_edges
from contrail.schema import AIRCRAFT_PROPS
from contrail.session import cut_lineage, delete_path, in_utc, release, scratch_path
from contrail.sinks.versions import Parts, bucketed, current, dated, merge_rows, paired, read_version, replace_parts, stored_files
from contrail.sources.fixtures import fixture_tables

# Batch id used by the registered queries, so results are repeatable.
FIXED_BATCH_ID = "20240101T000000Z"


@dataclass
class Pipeline:
    clean: DataFrame
    events: DataFrame
    matched: DataFrame
    graph: Graph
    airports: DataFrame


@in_utc
def new_batch_id(spark: SparkSession) -> str:
    """P-12: UTC yyyyMMddTHHmmssZ of now (the session zone is UTC)."""
    return spark.range(1).select(F.date_format(F.current_timestamp(), BATCH_ID_FORMAT)).first()[0]


@in_utc
def build_pipeline(raw: DataFrame, airports: DataFrame, batch_id: str = FIXED_BATCH_ID,
                   near_grain: str = "pair", match_mode: str = "reference",
                   airport_radius_km: float = AIRPORT_RADIUS_KM,
                   near_radius_km: float = NEAR_RADIUS_KM,
                   clean: DataFrame | None = None, near_countries: bool = False) -> Pipeline:
    """Lazy plans for every stage; nothing runs until an action.
    ``near_countries``: NEAR also has ``label_a`` and ``label_b``, the
    countries that operate its ends."""
    clean = clean if clean is not None else clean_and_enrich(raw)
    events = detect_flight_events(clean, batch_id)
    matched = match_airports(events, airports, airport_radius_km, match_mode)
    labels = None
    if near_countries:
        labels = operates_edges(aircraft_nodes(clean)).select("icao24", F.col("country").alias("label"))
    near = near_edges(clean, near_radius_km, near_grain, labels=labels)
    return Pipeline(clean, events, matched, build_graph(clean, matched, airports, near), airports)


def pipeline_from_dir(spark: SparkSession, sf_dir: str, **kw) -> Pipeline:
    raw, airports = fixture_tables(spark, sf_dir)
    return build_pipeline(raw, airports, **kw)


def graph_from_dir(spark: SparkSession, sf_dir: str, **kw) -> Graph:
    return pipeline_from_dir(spark, sf_dir, **kw).graph


# Buckets of the tables without a time; a table keeps those of its first write.
ENTITY_BUCKETS = 16
PAIR_BLOCKS = 5  # of a NEAR table whose first rows are given; made from positions, it has their blocks


def table_layout(name: str, near_grain: str = "pair") -> tuple[list[str], Parts]:
    """Keys and layout of a written table. Tables with a time lie in dates,
    entities in buckets of their key, catalogues in one."""
    if name == "near" and near_grain == "observation":
        return ["icao24_a", "icao24_b", "snapshot_time"], dated("snapshot_time", "snapshot_date")
    return {
        "country": (["name"], bucketed(["name"], 1)),
        "airport": (["icao"], bucketed(["icao"], 1)),
        "aircraft": (["icao24"], bucketed(["icao24"], ENTITY_BUCKETS)),
        "operates": (["icao24"], bucketed(["icao24"], ENTITY_BUCKETS)),
        "near": (["icao24_a", "icao24_b"], paired(["icao24_a", "icao24_b"], PAIR_BLOCKS)),
        "snapshot": (["id"], dated("snapshot_time", "snapshot_date")),
        "snapshot_edge": (["icao24", "snapshot_id"], dated("snapshot_time", "snapshot_date")),
        "flight_edge": (["icao24", "event_time", "rel_type", "airport_icao"], dated("event_time", "event_date")),
        "flight_events": (["icao24", "event_time", "event_type"], dated("event_time", "event_date")),
        "matched_events": (["icao24", "event_time", "event_type", "airport_icao"], dated("event_time", "event_date")),
        "boundaries": (["icao24"], dated("head_time", "snapshot_date")),
    }[name]


@in_utc
def write_pairs(clean: DataFrame, path: str) -> None:
    """NEAR at the pair grain, made from the positions ``clean`` and merged
    with what is there, the newest snapshot of a pair wins. A part of the
    table holds the pairs of two blocks of aircraft and is made by one task
    from their tracks and its stored files, so no pair is shuffled."""
    spark, (keys, layout) = clean.sparkSession, table_layout("near")
    base = current(spark, path)
    if base is not None and base.part_col != layout.part_col:  # a table of before this layout
        merge_rows(near_edges(clean), path, keys, bucketed(keys, base.buckets), [F.col("snapshot_time").desc()], unique=True)
        return
    layout = paired(keys, blocks_of(spark)) if base is None else replace(layout, buckets=base.buckets)
    seen, stored = range(layout.blocks), None
    if base is not None:
        seen = sorted(r[0] for r in airborne_positions(clean).filter("icao24 IS NOT NULL").select(
            block("icao24", layout.blocks)).distinct().collect())  # at most ``blocks``
        if not seen:
            return
    pairs = {str(int(layout.pair(i, j))): (i, j) for i in seen for j in seen if i <= j}
    if base is not None and (files := stored_files(spark, path, base, list(pairs))) is not None:
        ends = F.create_map(*[F.lit(x) for part, ij in pairs.items() for x in (part, f"{ij[0]} {ij[1]}")])
        of = F.split(ends[F.col("part")], " ")
        stored = files.select(of[0].cast("int").alias("i"), of[1].cast("int").alias("j"), "content")
    near = near_edges(clean, blocks=layout.blocks, stored=stored, ordered=True)
    replace_parts(near, path, keys, layout, list(pairs), grouped=True)


def seen_aircraft(clean: DataFrame) -> DataFrame:
    """Aircraft nodes with the time they are from."""
    return latest_per_aircraft(clean).select("icao24", *AIRCRAFT_PROPS, F.col("snapshot_time").alias("seen_at"))


@in_utc
def write_entities(aircraft: DataFrame, country: DataFrame, airport: DataFrame, near: DataFrame | None, out_dir: str,
                   near_grain: str = "pair", positions: DataFrame | None = None) -> None:
    """SNK-4, SNK-5, SNK-7 and NEAR, merged by key with what is there. An
    aircraft and a pair keep the values of their newest snapshot, whichever
    run saw it; rows are never removed. OPERATES is derived from the
    aircraft buckets that were touched. ``positions``: the snapshots that
    NEAR is made of, in place of ``near`` (:func:`write_pairs`)."""
    spark = aircraft.sparkSession
    if "seen_at" not in aircraft.columns:
        aircraft = aircraft.withColumn("seen_at", F.lit(None).cast("timestamp_ntz"))

    def merge(name, rows, order):
        return merge_rows(rows, os.path.join(out_dir, name), *table_layout(name, near_grain), order, unique=True)

    def aircraft_and_operates():
        touched = merge("aircraft", aircraft, [F.col("seen_at").desc_nulls_last()])
        operates = operates_edges(read_version(spark, os.path.join(out_dir, "aircraft"), touched))
        replace_parts(operates, os.path.join(out_dir, "operates"), *table_layout("operates"), touched)

    pairs = [lambda: merge("near", near, [F.col("snapshot_time").desc()])] if near is not None else []
    if positions is not None:
        pairs = [lambda: write_pairs(positions, os.path.join(out_dir, "near"))]
    at_once(spark, [*pairs, aircraft_and_operates, lambda: merge("country", country, []), lambda: merge("airport", airport, [])])


def at_once(spark: SparkSession, jobs: list) -> None:
    """Run independent table writes side by side, so that the tail of one
    does not leave the executors idle. All end before the first error is
    raised."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        for done in [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]:
            done.result()


@in_utc
def write_graph(graph: Graph, out_dir: str, near_grain: str = "pair", positions: DataFrame | None = None) -> dict[str, str]:
    """SNK-4..9: every node / edge table under ``out_dir``, merged by key
    with what is there. Each table is a versioned one: a write that fails
    leaves what earlier runs wrote. ``positions``: see :func:`write_entities`."""
    timed = {"snapshot": graph.snapshot_edge.select(F.col("snapshot_id").alias("id"), "snapshot_time"),
             "snapshot_edge": graph.snapshot_edge, "flight_edge": graph.flight_edge}

    def merge(name):
        merge_rows(timed[name], os.path.join(out_dir, name), *table_layout(name), unique=True)

    at_once(graph.aircraft.sparkSession, [lambda: write_entities(
        graph.aircraft, graph.country, graph.airport, graph.near, out_dir, near_grain, positions),
             *[lambda n=n: merge(n) for n in timed]])
    return {name: os.path.join(out_dir, name) for name in graph.tables()}


def read_graph(spark: SparkSession, out_dir: str) -> Graph:
    """The newest version of every table."""
    def rd(name):
        df = read_version(spark, os.path.join(out_dir, name))
        return df.select("id") if name == "snapshot" else df.drop("seen_at")
    return Graph(**{name: rd(name) for name in Graph.__dataclass_fields__})


def crowded(clean: DataFrame, base: str) -> DataFrame | None:
    """The cells that NEAR compares in parts, written once; None if there
    are none."""
    cells = cut_lineage(dense_cells(clean), "crowded", base=base)
    return None if cells.isEmpty() else cells


@in_utc
def run_batch(spark: SparkSession, raw: DataFrame, airports: DataFrame, out_dir: str,
              batch_id: str | None = None, near_grain: str = "pair",
              match_mode: str = "reference", timings: dict | None = None) -> dict:
    """PL-8: run the whole job once and write its tables under ``out_dir``.

    ``clean`` feeds five outputs that each read a few of its columns, so it
    is written once as parquet into the shared checkpoint folder and read
    back (lineage cut, survives executor loss, consumers prune columns).
    The much smaller events and match candidates are read whole by two
    consumers each and get a reliable checkpoint. Events and graph tables are
    merged by key into what earlier runs wrote: nothing of theirs is lost,
    and running a batch again changes nothing. (``plans/cycle.py`` has the
    scheduled form, which knows the dates that changed.)
    """
    batch_id = batch_id or new_batch_id(spark)
    timings = {} if timings is None else timings

    def stage(name, fn):
        spark.sparkContext.setJobGroup(f"contrail:{name}", f"batch job stage {name}")
        t0 = time.perf_counter()
        out = fn()
        timings[name] = round(time.perf_counter() - t0, 3)
        return out

    run_dir = scratch_path(spark, "run")  # this run's intermediates, deleted at the end
    airports = cut_lineage(airports, "airports", base=run_dir)  # written: joins are planned by its bytes
    clean = stage("clean", lambda: cut_lineage(clean_and_enrich(raw), "clean", base=run_dir))
    events = stage("events", lambda: cut_lineage(detect_flight_events(clean, batch_id), "events",
                                                 columnar=False))
    matched_all, keyed = stage("airport_match_plan", lambda: match_both(
        events, airports, mode=match_mode, materialize=lambda d: cut_lineage(d, "match", columnar=False)))
    stage("airport_match", lambda: merge_rows(
        matched_all, os.path.join(out_dir, "matched_events"), *table_layout("matched_events"), unique=True))
    stage("flight_events_table", lambda: merge_rows(
        keyed, os.path.join(out_dir, "flight_events"), *table_layout("flight_events"), unique=True))
    near = near_edges(clean, grain=near_grain, dense=crowded(clean, run_dir) if near_grain == "observation" else None)
    graph = build_graph(clean, matched_all, airports, near)
    graph.aircraft = seen_aircraft(clean)
    try:
        paths = stage("graph_write", lambda: write_graph(
            graph, os.path.join(out_dir, "graph"), near_grain, clean if near_grain == "pair" else None))
    finally:
        delete_path(spark, run_dir)
    del clean, events, matched_all, keyed, near, graph
    release(spark)
    return {"batch_id": batch_id, "paths": paths, "timings": timings,
            "graph_dir": os.path.join(out_dir, "graph")}
