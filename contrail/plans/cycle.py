"""ST-3 / ST-4 / PL-8: the scheduled cycle, driven by what changed.

A cycle ingests what has landed, compares the files of each date of the
state-vector table with those of the last cycle, and recomputes the dates
that differ; other dates are not scanned. Tables by date get those dates
replaced, entities and pairs are merged by key (newest wins).

Take-offs and landings between two dates need a neighbour's row. The table
``boundaries`` holds each aircraft's first and last positioned snapshot of
each date, one row instead of a day of snapshots. A changed date replaces its
boundaries; the events at a date's first snapshot come from the boundary
before it. Where late data land before a date that has not changed, that
date's first event is worked out again and put among its stored events.

A cycle that fails is repeated as a whole: its mark is written last, every
table write is atomic, and writing a date again gives the same rows.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from contrail.constants import FLIGHT_EVENT_TTL_DAYS, STATE_VECTOR_TTL_DAYS
from contrail.operators.clean import clean_and_enrich
from contrail.operators.events import date_boundaries, events_inside_dates, transitions
from contrail.operators.graph import airport_nodes, country_nodes, flight_edges, snapshot_edges
from contrail.operators.match import match_both
from contrail.operators.near import near_edges
from contrail.plans.pipeline import at_once, crowded, new_batch_id, seen_aircraft, table_layout, write_entities
from contrail.session import apply_scale_settings, cut_lineage, delete_path, in_utc, release, scratch_path
from contrail.sinks import versions as V
from contrail.sinks.tables import STATE_VECTOR_KEYS, compact_state_vectors, expire_partitions, recover

MARKS = "_cycles"


def files_by_date(spark: SparkSession, table: str, part_col: str = "snapshot_date") -> dict[str, str]:
    """date -> digest of the names and sizes of its files (a listing only)."""
    fs, root = V._fs(spark, table)
    out = {}
    for name in V.names_in(spark, table):
        if name.startswith(part_col + "="):
            _, folder = V._fs(spark, f"{table}/{name}")
            files = sorted(f"{s.getPath().getName()}:{s.getLen()}" for s in fs.listStatus(folder))
            out[name.split("=", 1)[1]] = hashlib.sha1("\n".join(files).encode()).hexdigest()
    return out


def last_mark(spark: SparkSession, out_dir: str) -> dict:
    names = [n for n in V.names_in(spark, f"{out_dir}/{MARKS}") if n.endswith(".json")]
    return json.loads(V.read_text(spark, f"{out_dir}/{MARKS}/{names[-1]}")) if names else \
        {"number": 0, "dates": {}, "compacted": {}}


def rows_of_dates(spark: SparkSession, table: str, dates: list[str]) -> DataFrame:
    """State vectors of the given dates; no other partition is scanned."""
    days = [dt.date.fromisoformat(d) for d in dates]
    return spark.read.parquet(table).filter(F.col("snapshot_date").isin(days)).drop("snapshot_date")


def _first_events(spark: SparkSession, bounds: str, dates: list[str], before: int | None, batch_id: str, base: str):
    """(events at the first snapshot of the changed dates and of the dates
    after them, first snapshots of unchanged dates among these). ``before``:
    version of the boundaries that the changed dates have replaced."""
    who = V.read_version(spark, bounds, dates).select("icao24")
    if before is not None:  # aircraft may also have gone from a date
        who = who.union(V.read_version(spark, bounds, dates, before).select("icao24"))
    # one row for each date an aircraft was seen on
    w = Window.partitionBy("icao24").orderBy("snapshot_date")
    chain = V.read_version(spark, bounds, part_column=True).join(who.distinct(), "icao24", "left_semi").withColumns({
        "prev_date": F.lag("snapshot_date").over(w), "snapshot_time_prev": F.lag("tail_time").over(w),
        "on_ground_prev": F.lag("tail_ground").over(w)})
    day, prev = F.col("snapshot_date"), F.col("prev_date")
    days = F.array(*[F.lit(dt.date.fromisoformat(d)) for d in dates])
    changed = F.array_contains(days, day)
    after = F.exists(days, lambda d: (d < day) & (prev.isNull() | (d >= prev)))
    heads = cut_lineage(chain.filter(changed | after).select(
        "icao24", F.col("head_time").alias("snapshot_time"), F.col("head_ground").alias("on_ground"),
        F.col("head_lat").alias("latitude"), F.col("head_lon").alias("longitude"), "snapshot_time_prev", "on_ground_prev",
        "snapshot_date", changed.alias("changed")), "heads", base=base)
    kept = heads.filter("NOT changed").select("icao24", F.col("snapshot_time").alias("event_time"), "snapshot_date")
    return transitions(heads, batch_id), kept


def _write_events(rows: DataFrame, out: str, name: str, dates: list[str], heads: DataFrame, more: list[str]) -> None:
    """Replaces the changed dates, and in the dates ``more`` the events at
    the first snapshots ``heads``."""
    spark = rows.sparkSession
    keys, layout = table_layout(name)
    base = V.current(spark, out)
    if base is not None and (held := [d for d in more if d in base.parts]):
        stored = V.read_version(spark, out, held)
        rows = rows.unionByName(stored.join(heads.select("icao24", "event_time"), ["icao24", "event_time"], "left_anti"))
    V.replace_parts(rows, out, keys, layout, sorted({*dates, *more}))


@in_utc
def recompute_dates(spark: SparkSession, state_vectors_path: str, dates: list[str], airports: DataFrame, out_dir: str,
                    batch_id: str | None = None, near_grain: str = "pair", match_mode: str = "reference") -> dict:
    """Bring the written tables up to date with the given dates of the
    state-vector table. The catalogue's newest rows win."""
    batch_id = batch_id or new_batch_id(spark)
    graph_dir = os.path.join(out_dir, "graph")
    bounds = os.path.join(out_dir, "boundaries")
    run_dir = scratch_path(spark, "cycle")
    try:
        airports = cut_lineage(airports, "airports", base=run_dir)  # written: joins are planned by its bytes
        clean = cut_lineage(clean_and_enrich(rows_of_dates(spark, state_vectors_path, dates)), "clean", base=run_dir)
        old = V.current(spark, bounds)
        V.replace_parts(date_boundaries(clean), bounds, *table_layout("boundaries"), dates)
        first, heads = _first_events(spark, bounds, dates, old.number if old else None, batch_id, run_dir)
        more = [str(r[0]) for r in heads.select("snapshot_date").distinct().collect()]  # a handful of dates
        events = cut_lineage(events_inside_dates(clean, batch_id).unionByName(first), "events", columnar=False)
        matched, keyed = match_both(events, airports, mode=match_mode,
                                    materialize=lambda d: cut_lineage(d, "match", columnar=False))
        airport = airport_nodes(airports)
        edges = snapshot_edges(clean)
        near = near_edges(clean, grain=near_grain, dense=crowded(clean, run_dir) if near_grain == "observation" else None)

        def event_table(name, rows, folder):
            _write_events(rows, os.path.join(folder, name), name, dates, heads, more)

        def dated_table(name, rows):
            V.replace_parts(rows, os.path.join(graph_dir, name), *table_layout(name, near_grain), dates)

        jobs = [lambda: event_table("matched_events", matched, out_dir), lambda: event_table("flight_events", keyed, out_dir),
                lambda: event_table("flight_edge", flight_edges(matched, airport), graph_dir),
                lambda: dated_table("snapshot", edges.select(F.col("snapshot_id").alias("id"), "snapshot_time")),
                lambda: dated_table("snapshot_edge", edges)]
        pairs, positions = near, clean if near_grain == "pair" else None
        if near_grain == "observation":
            jobs.append(lambda: dated_table("near", near))
            pairs = None
        jobs.append(lambda: write_entities(seen_aircraft(clean), country_nodes(clean), airport, pairs, graph_dir, near_grain,
                                           positions))
        at_once(spark, jobs)
    finally:
        delete_path(spark, run_dir)
    del clean, first, heads, events, matched, keyed, edges, near, pairs, positions, jobs
    release(spark)
    return {"batch_id": batch_id, "graph_dir": graph_dir, "dates": dates, "rewritten": sorted({*dates, *more})}


@in_utc
def run_cycle(spark: SparkSession, landing_dir: str, state_vectors_path: str, airports: DataFrame,
              out_dir: str, checkpoint_location: str, retention_days: int | None = None,
              now=None, batch_id: str | None = None, size_session: bool = False, compact: bool = True) -> dict:
    """One cycle: ingest (availableNow), recompute the dates whose files
    changed, expire whole days beyond their retention, and compact the dates
    that are closed (older than the newest, and quiet in this cycle), once
    each. Scheduling every 5 minutes is the caller's (cron, workflow tool, or
    a streaming trigger). ``size_session`` sizes shuffle partitions, scan
    splits and skew thresholds from the bytes of the state-vector table.

    A row is used however late it lands, as long as its date is retained."""
    from contrail.streaming.ingest import start_ingest

    q = start_ingest(spark, landing_dir, state_vectors_path, checkpoint_location, trigger="availableNow")
    q.awaitTermination()
    if size_session:
        apply_scale_settings(spark, [state_vectors_path])
    days = STATE_VECTOR_TTL_DAYS if retention_days is None else retention_days
    today = now.date() if now is not None else dt.datetime.now(dt.timezone.utc).date()
    oldest = (today - dt.timedelta(days=days)).isoformat()

    recover(spark, state_vectors_path, STATE_VECTOR_KEYS, "snapshot_date")
    mark = last_mark(spark, out_dir)
    files = {d: f for d, f in files_by_date(spark, state_vectors_path).items() if d >= oldest}
    dates = sorted(d for d, f in files.items() if mark["dates"].get(d) != f)
    result = {"batch_id": batch_id, "graph_dir": os.path.join(out_dir, "graph"), "dates": [], "rewritten": []}
    if dates:
        result = recompute_dates(spark, state_vectors_path, dates, airports, out_dir, batch_id)
    # SNK-10: whole days beyond their retention go
    expire_partitions(spark, state_vectors_path, "snapshot_date", days, today)
    for name in ("flight_events", "boundaries"):
        V.expire_parts(spark, os.path.join(out_dir, name), max(days, FLIGHT_EVENT_TTL_DAYS), today)
    closed = [d for d in files if compact and d not in dates and d < max(files) and mark["compacted"].get(d) != files[d]]
    compacted = {d: f for d, f in mark["compacted"].items() if d in files and d not in dates}
    if closed:
        compact_state_vectors(spark, state_vectors_path, [dt.date.fromisoformat(d) for d in sorted(closed)])
        new = files_by_date(spark, state_vectors_path)
        files |= {d: new[d] for d in closed}
        compacted |= {d: new[d] for d in closed}
    V.publish_text(spark, f"{out_dir}/{MARKS}/{mark['number'] + 1:010d}.json", json.dumps(
        {"number": mark["number"] + 1, "dates": files, "compacted": compacted}))
    return result | {"compacted": sorted(closed)}
