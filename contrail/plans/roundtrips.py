"""Registered end-to-end runs of the ingest side on data derived from the
driver's tables: snapshot documents and an airport catalogue CSV are landed
in the shared scratch folder (under ``spark.checkpoint.dir``), then read
back through the batch parser, the streaming ingest (ST-1/ST-2) and the
streaming transition detector (ST-6)."""

from __future__ import annotations

import datetime as dt
import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.constants import STATE_VECTOR_FIELDS
from contrail.operators.clean import clean_and_enrich, dedup_latest_write
from contrail.plans.cycle import run_cycle
from contrail.plans.pipeline import FIXED_BATCH_ID, read_graph, run_batch
from contrail.plans.queries import graph_stats, q4_most_tracked
from contrail.session import cut_lineage, ensure_checkpoint_dir
from contrail.sinks.tables import reset_derived, upsert_state_vectors, write_airports
from contrail.sinks.versions import read_version
from contrail.sources.airports_csv import load_airports
from contrail.sources.fixtures import fixture_tables, padded
from contrail.sources.point_read import newest_state
from contrail.sources.snapshots import parse_snapshots, snapshots_from_state_vectors
from contrail.streaming.ingest import start_ingest
from contrail.streaming.ordered import drain, late_rows, start_ordered_transitions, stream_events


def scratch_dir(spark: SparkSession, what: str) -> str:
    return os.path.join(ensure_checkpoint_dir(spark), f"{what}-{uuid.uuid4().hex}")


def _ntz(df: DataFrame, col: str) -> DataFrame:
    return df.withColumn(col, F.col(col).cast("timestamp_ntz"))


def snapshot_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PL-1 on every state vector: to documents and back (batch)."""
    raw, _ = fixture_tables(spark, sf_dir)
    return _ntz(parse_snapshots(snapshots_from_state_vectors(raw)), "snapshot_time")


REGION = (40.0, -10.0, 60.0, 20.0)


def snapshot_parse_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PL-1, SRC-3: documents read back inside a region box. Of every third
    state only the first seven values are sent, of every seventh the speed is
    no number: what is missing or unparsable is null."""
    raw, _ = fixture_tables(spark, sf_dir)
    docs = snapshots_from_state_vectors(raw.filter("event_id % 3 <> 0 AND event_id % 7 <> 0"))
    short = snapshots_from_state_vectors(raw.filter("event_id % 3 = 0")).withColumn(
        "states", F.transform("states", lambda s: F.slice(s, 1, 7)))
    speed = STATE_VECTOR_FIELDS.index("velocity")
    bad = snapshots_from_state_vectors(raw.filter("event_id % 3 <> 0 AND event_id % 7 = 0")).withColumn(
        "states", F.transform("states", lambda s: F.transform(s, lambda v, i: F.when(i == speed, F.lit("fast")).otherwise(v))))
    return _ntz(parse_snapshots(docs.unionByName(short).unionByName(bad), bbox=REGION), "snapshot_time")


def airport_catalogue_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-9, SNK-3: a catalogue with small airports, five-letter idents, bad
    coordinates and airports outside the region; what the filter leaves is
    written as the catalogue, twice, and read back."""
    _, airports = fixture_tables(spark, sf_dir)
    k = F.regexp_extract("icao_code", "[0-9]+", 0).cast("long")
    csv_rows = airports.select(
        F.when(k % 11 == 0, F.concat("icao_code", F.lit("X"))).otherwise(F.concat(F.lit(" "), "icao_code")).alias("ident"),
        F.when(k % 5 == 0, F.lit("small_airport")).otherwise(F.col("type")).alias("type"),
        F.concat(F.lit("  "), "name", F.lit(" ")).alias("name"),
        F.when(k % 7 == 0, F.lit("north")).otherwise(F.col("latitude").cast("string")).alias("latitude_deg"),
        F.when(k % 6 == 0, F.lit(120.5)).otherwise(F.col("longitude")).cast("string").alias("longitude_deg"),
        F.when(k % 4 == 0, F.lit("high")).otherwise(F.col("altitude_ft").cast("string")).alias("elevation_ft"),
        F.col("country").alias("iso_country"), F.when(k % 3 == 0, F.lit(" ")).otherwise(F.col("city")).alias("municipality"),
        "iata_code")
    path = scratch_dir(spark, "airports-rejects")
    csv_rows.write.option("header", True).csv(f"{path}/csv")
    for _ in range(2):  # replaced as a whole
        write_airports(load_airports(spark, f"{path}/csv"), f"{path}/catalogue")
    return spark.read.parquet(f"{path}/catalogue")


def stream_ingest_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST-2: the same documents land twice, in two micro-batches, the second
    time in other files; the table read with the newest write per key is as
    after one. ``deliveries``: rows stored for the key's snapshot."""
    raw, _ = fixture_tables(spark, sf_dir)
    root = scratch_dir(spark, "stream-twice")
    landing, table = os.path.join(root, "landing"), os.path.join(root, "table")
    docs = snapshots_from_state_vectors(raw)
    # as scanned, then dealt by their content: no task holds a fixed share of the documents
    for files in (docs, docs.repartition(F.xxhash64("time", "states"))):
        files.write.mode("append").json(landing)
        start_ingest(spark, landing, table, os.path.join(root, "checkpoint"), trigger="availableNow").awaitTermination()
    stored = spark.read.parquet(table).drop("snapshot_date")
    times = stored.groupBy("icao24", "snapshot_time").agg(F.count(F.lit(1)).alias("deliveries"))
    return _ntz(dedup_latest_write(stored).join(times, ["icao24", "snapshot_time"]).drop("ingest_seq"), "snapshot_time")


def airport_catalogue_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PL-2: the derived airports written in the catalogue's CSV layout
    (elevation as the raw decimal balance), then loaded with the filter
    and normalisation rules."""
    _, airports = fixture_tables(spark, sf_dir)
    supplier = spark.read.parquet(os.path.join(sf_dir, "supplier.parquet"))
    csv_rows = (airports.join(supplier.select(F.concat(F.lit("A"), padded(F.col("s_suppkey"), 3))
                                              .alias("icao_code"), "s_suppkey", "s_acctbal"), "icao_code")
                .select(F.col("icao_code").alias("ident"), "type", "name",
                        F.col("latitude").cast("string").alias("latitude_deg"),
                        F.col("longitude").cast("string").alias("longitude_deg"),
                        F.col("s_acctbal").cast("string").alias("elevation_ft"),
                        F.col("country").alias("iso_country"), F.col("city").alias("municipality"),
                        "iata_code"))
    path = scratch_dir(spark, "airports-csv")
    csv_rows.write.option("header", True).csv(path)
    return load_airports(spark, path)


_WRITTEN: dict[tuple, str] = {}


def _written(spark: SparkSession, sf_dir: str, what: str, write) -> str:
    """Folder of tables that several queries read: written once for each
    application and input."""
    key = (spark.sparkContext.applicationId, sf_dir, what)
    if key not in _WRITTEN:
        out = scratch_dir(spark, what)
        write(out)
        _WRITTEN[key] = out
    return _WRITTEN[key]


def cycle_dir(spark: SparkSession, sf_dir: str) -> str:
    """Folder of the tables two cycles of the batch job have written: one
    over all days and, after it, one that sees the second half only. The
    second must keep what the first wrote."""
    def write(out):
        raw, airports = fixture_tables(spark, sf_dir)
        second = raw.filter(F.col("snapshot_time") >= F.lit("2024-01-15").cast("timestamp_ntz"))
        for days in (raw, second):
            run_batch(spark, days, airports, out, batch_id=FIXED_BATCH_ID)
    return _written(spark, sf_dir, "cycles", write)


def incremental_dir(spark: SparkSession, sf_dir: str) -> str:
    """Folder of the tables three scheduled cycles have written: snapshot
    documents of the middle days land first, then the days before them, then
    the rest; each landing is followed by a cycle (ingest, recompute of the
    changed dates, expiry, compaction)."""
    def write(out):
        raw, airports = fixture_tables(spark, sf_dir)
        day = F.dayofmonth("snapshot_time")
        for days in (day.between(11, 20), day < 11, day > 20):
            snapshots_from_state_vectors(raw.filter(days)).write.mode("append").options(
                compression="gzip", maxRecordsPerFile=100_000).json(os.path.join(out, "landing"))
            run_cycle(spark, os.path.join(out, "landing"), os.path.join(out, "state_vectors"), airports,
                      os.path.join(out, "job"), os.path.join(out, "checkpoint"), retention_days=40,
                      now=dt.datetime(2024, 2, 1), batch_id=FIXED_BATCH_ID)
    return os.path.join(_written(spark, sf_dir, "incremental", write), "job")


def incremental_flight_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST-3, SNK-2: the flight events table after three cycles."""
    return _ntz(read_version(spark, os.path.join(incremental_dir(spark, sf_dir), "flight_events")), "event_time")


def incremental_graph(spark: SparkSession, sf_dir: str):
    """ST-3, PL-8: the graph after three cycles."""
    return read_graph(spark, os.path.join(incremental_dir(spark, sf_dir), "graph"))


def incremental_state_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-1, SNK-10: the state vectors after three cycles; the dates that
    were closed by then are compacted to one row per key, the others are
    read with the newest write per key."""
    path = os.path.join(os.path.dirname(incremental_dir(spark, sf_dir)), "state_vectors")
    table = spark.read.parquet(path).drop("snapshot_date")
    return _ntz(dedup_latest_write(table).drop("ingest_seq"), "snapshot_time")


def incremental_point_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-5: the newest state vector of the most tracked aircraft, found by
    its key in the tables that three cycles have written."""
    job = incremental_dir(spark, sf_dir)
    graph, table = os.path.join(job, "graph"), os.path.join(os.path.dirname(job), "state_vectors")
    who = q4_most_tracked(read_graph(spark, graph)).first()["icao24"]
    return _ntz(newest_state(spark, graph, table, who).drop("ingest_seq"), "snapshot_time")


def cycle_flight_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-2, ST-3: the flight events table as two cycles have left it."""
    return read_version(spark, os.path.join(cycle_dir(spark, sf_dir), "flight_events"))


def cycle_flight_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-8: the flight edges as two cycles have left them."""
    return read_graph(spark, os.path.join(cycle_dir(spark, sf_dir), "graph")).flight_edge


def cycle_graph_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-4..8: row counts of the graph tables two cycles have left."""
    return graph_stats(read_graph(spark, os.path.join(cycle_dir(spark, sf_dir), "graph")))


def reset_state_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-1, SNK-11: state vectors written, reset, and written again by two
    upserts that overlap: the table holds each key once, with its newest
    write. Before the reset it also holds aircraft, on the same days, that
    no later upsert writes: they must be gone."""
    raw, _ = fixture_tables(spark, sf_dir)
    path = scratch_dir(spark, "reset")
    rows = raw.withColumnRenamed("event_id", "ingest_seq")
    gone = rows.withColumn("icao24", F.concat(F.lit("gone-"), "icao24"))
    upsert_state_vectors(rows.unionByName(gone), path)
    reset_derived(spark, {"state_vectors": path})
    upsert_state_vectors(rows.filter(F.col("ingest_seq") % 2 == 0), path)
    upsert_state_vectors(rows, path)
    return spark.read.parquet(path).drop("snapshot_date").withColumnRenamed("ingest_seq", "event_id")


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST-1/ST-2: snapshot documents landed as files, ingested by the
    streaming query (availableNow, append-only micro-batches) and read back
    with the newest write per key, as the batch job reads it."""
    raw, _ = fixture_tables(spark, sf_dir)
    root = scratch_dir(spark, "stream-ingest")
    snapshots_from_state_vectors(raw).write.json(os.path.join(root, "landing"))
    q = start_ingest(spark, os.path.join(root, "landing"), os.path.join(root, "table"),
                     os.path.join(root, "checkpoint"), trigger="availableNow")
    q.awaitTermination()  # to the end of what has landed, or its error
    table = spark.read.parquet(os.path.join(root, "table")).drop("snapshot_date")
    return _ntz(dedup_latest_write(table).drop("ingest_seq"), "snapshot_time")


LATE_DAYS = 2  # the first days' rows, of other aircraft, that land when they are late


def _stream_dir(spark: SparkSession, sf_dir: str) -> str:
    """Folder of the ordered transitions of all positions. Five days land at
    a time, but half of the rows of the last two of them (by a hash) land with
    the next five days: out of order, within the default lateness of seven
    days. The fifth landing also brings rows of the first days that are too
    late. The detector runs after each landing from its checkpoint; at the end
    all rows are final."""
    def write(root):
        raw, _ = fixture_tables(spark, sf_dir)
        clean = clean_and_enrich(raw).withColumn("snapshot_time", F.col("snapshot_time").cast("timestamp"))
        pos = cut_lineage(clean.select("icao24", "snapshot_time", "on_ground", "latitude", "longitude"), "positions")
        day = F.dayofmonth("snapshot_time") - 1
        delayed = (day % 5 >= 3) & (F.xxhash64("icao24", "snapshot_time") % 2 == 0)
        lands = F.floor(day / 5) + delayed.cast("int")
        late = pos.filter(day < LATE_DAYS).withColumn("icao24", F.concat(F.lit("late-"), "icao24"))
        landing = os.path.join(root, "landing")
        for i in range(7):
            part = pos.filter(lands == i)
            (part.unionByName(late) if i == 4 else part).write.parquet(os.path.join(landing, f"part={i:04d}"))
            stream = spark.readStream.schema(pos.schema).option("recursiveFileLookup", True).parquet(landing)
            start_ordered_transitions(stream, root, os.path.join(root, "checkpoint"), FIXED_BATCH_ID).awaitTermination()
        drain(spark, root, FIXED_BATCH_ID)
    return _written(spark, sf_dir, "stream-events", write)


def stream_flight_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST-6: take-offs and landings of rows that arrive out of order."""
    return _ntz(stream_events(spark, _stream_dir(spark, sf_dir)), "event_time")


def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST-4: the rows that came after the watermark, with their batch."""
    return _ntz(late_rows(spark, _stream_dir(spark, sf_dir)).drop("seq"), "snapshot_time")
