"""PL-4 detect_flight_events: on_ground transitions per aircraft.

``lag`` runs over each aircraft's positioned snapshots in time order. To
keep one aircraft with a huge history from landing in one task, the window
is partitioned by (icao24, time bucket) instead of icao24 alone: each
bucket gets one "ghost" row, the last positioned snapshot of the
aircraft's previous non-empty bucket, so the first real row of a bucket
still sees its true predecessor. The ghost rows come from a small
(aircraft x bucket) aggregate that is combined map-side; the result equals
the unsplit window exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contrail.functions.labels import event_type_of
from contrail.session import in_utc



_SPLIT_UNITS = ("day", "hour", "minute")


def _bucket(ts: Column, unit: str) -> Column:
    """Time bucket of the split lag window; finer units bound the rows per
    (aircraft, bucket) further when snapshots are very dense."""
    if unit == "day":
        return F.to_date(ts)
    if unit in _SPLIT_UNITS:
        return F.date_trunc(unit, ts)
    raise ValueError(f"unknown split unit {unit!r} (use one of {_SPLIT_UNITS} or None)")


def positioned_snapshots(clean: DataFrame, *more: str) -> DataFrame:
    """F-2: on_ground, latitude and longitude known. Null rows go first, so
    a transition can span them. ``more``: further columns to keep."""
    return (clean.filter(F.col("on_ground").isNotNull() & F.col("latitude").isNotNull()
                         & F.col("longitude").isNotNull())
                 .select("icao24", "snapshot_time", "on_ground", "latitude", "longitude", *more))


def with_previous_state(pos: DataFrame, split_unit: str | None = "day") -> DataFrame:
    """W-1 / W-2: add ``on_ground_prev`` and ``snapshot_time_prev`` (lag 1
    over icao24 ordered by snapshot_time)."""
    if split_unit is None:
        w = Window.partitionBy("icao24").orderBy("snapshot_time")
        return pos.withColumns({
            "on_ground_prev": F.lag("on_ground", 1).over(w),
            "snapshot_time_prev": F.lag("snapshot_time", 1).over(w),
        })

    pos = pos.withColumn("_bucket", _bucket(F.col("snapshot_time"), split_unit))
    # scalar max / max_by keep fixed-width buffers: hash aggregation with a
    # map-side combine (a struct value would force a sort aggregate)
    tails = pos.groupBy("icao24", "_bucket").agg(
        F.max("snapshot_time").alias("_tail_time"),
        F.max_by("on_ground", "snapshot_time").alias("_tail_ground"))
    next_bucket = F.lead("_bucket", 1).over(Window.partitionBy("icao24").orderBy("_bucket"))
    ghosts = (tails.withColumn("_next", next_bucket)
                   .filter(F.col("_next").isNotNull())
                   .select("icao24",
                           F.col("_tail_time").alias("snapshot_time"),
                           F.col("_tail_ground").alias("on_ground"),
                           F.lit(None).cast("double").alias("latitude"),
                           F.lit(None).cast("double").alias("longitude"),
                           F.col("_next").alias("_bucket"),
                           F.lit(True).alias("_ghost")))
    rows = pos.withColumn("_ghost", F.lit(False)).unionByName(ghosts)
    w = Window.partitionBy("icao24", "_bucket").orderBy("snapshot_time")
    return (rows.withColumns({
                "on_ground_prev": F.lag("on_ground", 1).over(w),
                "snapshot_time_prev": F.lag("snapshot_time", 1).over(w),
            })
            .filter(~F.col("_ghost"))
            .drop("_ghost", "_bucket"))


def transitions(prev: DataFrame, batch_id: str) -> DataFrame:
    """TAKEOFF (True -> False) / LANDING (False -> True) of rows with their
    previous state; position and time from the later row; ``gap_seconds``
    truncates each side to whole seconds before subtracting (P-9). A row
    without a previous one yields nothing (F-3)."""
    return (
        prev.filter(F.col("on_ground_prev").isNotNull()
                    & (F.col("on_ground") != F.col("on_ground_prev")))
            .select(
                "icao24",
                F.col("snapshot_time").alias("event_time"),
                event_type_of(F.col("on_ground_prev"), F.col("on_ground")).alias("event_type"),
                "latitude",
                "longitude",
                (F.unix_timestamp("snapshot_time") - F.unix_timestamp("snapshot_time_prev"))
                .cast("int").alias("gap_seconds"),
                F.lit(batch_id).alias("batch_id"),
            )
    )


@in_utc
def detect_flight_events(clean: DataFrame, batch_id: str = "manual",
                         split_unit: str | None = "day") -> DataFrame:
    """The transitions of all positioned snapshots."""
    return transitions(with_previous_state(positioned_snapshots(clean), split_unit), batch_id)


@in_utc
def events_inside_dates(clean: DataFrame, batch_id: str) -> DataFrame:
    """Transitions between two snapshots of one date."""
    w = Window.partitionBy("icao24", F.to_date("snapshot_time")).orderBy("snapshot_time")
    prev = positioned_snapshots(clean).withColumns({
        "on_ground_prev": F.lag("on_ground", 1).over(w), "snapshot_time_prev": F.lag("snapshot_time", 1).over(w)})
    return transitions(prev, batch_id)


@in_utc
def date_boundaries(clean: DataFrame) -> DataFrame:
    """First and last positioned snapshot of each aircraft and date: what
    another date's events need to know of this one."""
    t = "snapshot_time"
    return positioned_snapshots(clean).groupBy("icao24", F.to_date(t).alias("snapshot_date")).agg(
        F.min(t).alias("head_time"), F.min_by("on_ground", t).alias("head_ground"),
        F.min_by("latitude", t).alias("head_lat"), F.min_by("longitude", t).alias("head_lon"),
        F.max(t).alias("tail_time"), F.max_by("on_ground", t).alias("tail_ground")).drop("snapshot_date")


def event_type_counts(events: DataFrame) -> DataFrame:
    """A-7: totals by event type in one pass."""
    return events.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("event_type") == "TAKEOFF").alias("takeoffs"),
        F.count_if(F.col("event_type") == "LANDING").alias("landings"),
    )
