"""ST-4 / ST-6: take-offs and landings of a stream whose rows arrive out of
order, and a table of the rows that arrive too late.

A micro-batch's rows are stored by the hour they belong to. The watermark is
the newest time seen so far, over all aircraft, minus the allowed lateness. A
row at or before the watermark of the batches before it is late: it goes to
the late rows, with the batch it came in, and is counted. When a batch moves
the watermark on, the rows between the old and the new one are final. Only
their hours are read; they are put in order behind each aircraft's last final
row, which is kept in a keyed table, and compared as the batch job does it.
So a batch costs its own rows, the rows it makes final, and their aircraft.

All work is DataFrame work inside ``foreachBatch``. A batch ends by
publishing its mark (watermark, version of the last rows, counts). A batch
that is run again finds its mark and does nothing, or repeats all writes over
themselves, beginning from the mark of the batch before.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from contrail.constants import STATE_VECTOR_TTL_DAYS
from contrail.operators.clean import keep_top_per_key
from contrail.operators.events import positioned_snapshots, transitions, with_previous_state
from contrail.session import delete_path, in_utc
from contrail.sinks import versions as V

LATENESS = dt.timedelta(days=STATE_VECTOR_TTL_DAYS)
STATE_BUCKETS = 16
_ROW = "icao24 STRING, snapshot_time TIMESTAMP, on_ground BOOLEAN, latitude DOUBLE, longitude DOUBLE, seq LONG"
_STORED = f"{_ROW}, late BOOLEAN, slot STRING, epoch LONG"
_EVENTS = ("icao24 STRING, event_time TIMESTAMP, event_type STRING, latitude DOUBLE, longitude DOUBLE, "
           "gap_seconds INT, batch_id STRING")
_LAYOUT = V.bucketed(["icao24"], STATE_BUCKETS)


def _mark(spark: SparkSession, root: str, before: int | None = None) -> dict:
    """The newest mark, or the newest of the batches before one."""
    names = [n for n in V.names_in(spark, f"{root}/marks") if n.endswith(".json")]
    if before is not None:
        names = [n for n in names if int(n[:10]) < before]
    if not names:
        return {"epoch": -1, "watermark": None, "newest": None, "state": None, "rows": 0, "late": 0}
    return json.loads(V.read_text(spark, f"{root}/marks/{names[-1]}"))


def _at(us: int) -> Column:
    return F.timestamp_micros(F.lit(us))


def _slot(us: int) -> str:
    return (dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=us)).strftime("%Y%m%d%H")


def _finish(spark: SparkSession, root: str, mark: dict, until: int | None, epoch: int, batch_id: str) -> tuple[int | None, list[str]]:
    """Makes the rows after ``mark``'s watermark up to ``until`` final.
    Returns the version of the last rows and the hours read."""
    since, state_path = mark["watermark"], f"{root}/last_rows"
    if until is None or (since is not None and until <= since):
        return mark["state"], []
    slots = [n for n in V.names_in(spark, f"{root}/rows/late=false") if n.startswith("slot=")
             and (since is None or n[5:] >= _slot(since)) and n[5:] <= _slot(until)]
    if not slots:
        return mark["state"], []
    rows = (spark.read.schema(_STORED).option("basePath", f"{root}/rows")
            .parquet(*[f"{root}/rows/late=false/{s}" for s in slots]).filter(F.col("snapshot_time") <= _at(until)))
    if since is not None:
        rows = rows.filter(F.col("snapshot_time") > _at(since))
    cols = ["icao24", "snapshot_time", "on_ground", "latitude", "longitude"]
    final = keep_top_per_key(rows, ["icao24", "snapshot_time"], [F.col("epoch").desc(), F.col("seq").desc()]).select(*cols)
    chain = final
    if mark["state"] is not None:
        last = V.read_version(spark, state_path, number=mark["state"])
        chain = final.unionByName(last.join(final.select("icao24").distinct(), "icao24", "left_semi").select(*cols))
    events = transitions(with_previous_state(chain), batch_id)
    if since is not None:
        events = events.filter(F.col("event_time") > _at(since))
    events.write.mode("overwrite").parquet(f"{root}/events/epoch={epoch}")
    newest = final.groupBy("icao24").agg(F.max("snapshot_time").alias("snapshot_time"), *[
        F.max_by(c, "snapshot_time").alias(c) for c in cols[2:]])
    V.merge_rows(newest, state_path, ["icao24"], _LAYOUT, [F.col("snapshot_time").desc()], unique=True)
    return V.current(spark, state_path).number, slots


def _close(spark: SparkSession, root: str, name: str, mark: dict) -> None:
    """Publishes the mark; then hours that are final as a whole go."""
    V.publish_text(spark, f"{root}/marks/{name}.json", json.dumps(mark))
    for s in V.names_in(spark, f"{root}/rows/late=false"):
        if mark["watermark"] is not None and s.startswith("slot=") and s[5:] < _slot(mark["watermark"]):
            delete_path(spark, f"{root}/rows/late=false/{s}")


@in_utc
def take_batch(batch: DataFrame, epoch: int, root: str, batch_id: str, lateness: dt.timedelta = LATENESS) -> dict:
    """One micro-batch of positions (icao24, snapshot_time, on_ground,
    latitude, longitude; optional ingest_seq, the higher of one key wins)."""
    spark = batch.sparkSession
    if f"{epoch:010d}.json" in V.names_in(spark, f"{root}/marks"):
        return _mark(spark, root, epoch + 1)  # done before the failure
    mark = _mark(spark, root, epoch)
    seq = F.col("ingest_seq").cast("long") if "ingest_seq" in batch.columns else F.lit(0).cast("long")
    keyed = batch.filter(F.col("icao24").isNotNull() & F.col("snapshot_time").isNotNull()).withColumn("seq", seq)
    pos = positioned_snapshots(keyed.withColumn("snapshot_time", F.col("snapshot_time").cast("timestamp")), "seq")
    late = F.lit(False) if mark["watermark"] is None else F.col("snapshot_time") <= _at(mark["watermark"])
    seen = Observation(f"positions_{epoch}")
    rows = pos.withColumns({"late": late, "slot": F.date_format("snapshot_time", "yyyyMMddHH"),
                            "epoch": F.lit(epoch).cast("long")}).observe(
        seen, F.count(F.lit(1)).alias("rows"), F.count_if("late").alias("late"), F.unix_micros(F.max("snapshot_time")).alias("newest"))
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("late", "slot", "epoch")
         .parquet(f"{root}/rows"))
    got = seen.get
    times = [t for t in (mark["newest"], got["newest"]) if t is not None]
    newest = max(times) if times else None
    until = newest - int(lateness / dt.timedelta(microseconds=1)) if times else None
    if until is not None and mark["watermark"] is not None:
        until = max(until, mark["watermark"])
    state, _ = _finish(spark, root, mark, until, epoch, batch_id)
    new = {"epoch": epoch, "watermark": until, "newest": newest, "state": state, "rows": got["rows"], "late": got["late"]}
    _close(spark, root, f"{epoch:010d}", new)
    return new


@in_utc
def drain(spark: SparkSession, root: str, batch_id: str) -> dict:
    """The stream has come to an end: all rows so far are final. What arrives
    afterwards and is not newer is late."""
    mark = _mark(spark, root)
    state, _ = _finish(spark, root, mark, mark["newest"], mark["epoch"] + 1_000_000_000, batch_id)
    new = mark | {"watermark": mark["newest"], "state": state, "rows": 0, "late": 0}
    if new["watermark"] != mark["watermark"]:
        _close(spark, root, f"{mark['epoch'] if mark['epoch'] >= 0 else 0:010d}_drained", new)
    return new


def start_ordered_transitions(positions: DataFrame, root: str, checkpoint_location: str, batch_id: str = "stream",
                              lateness: dt.timedelta = LATENESS, trigger: str = "availableNow"):
    """Start the query on a streaming DataFrame of positions. ``trigger``:
    "availableNow" or a processing time like "20 seconds"."""
    writer = positions.writeStream.foreachBatch(lambda batch, epoch: take_batch(batch, epoch, root, batch_id, lateness)) \
        .option("checkpointLocation", checkpoint_location)
    return (writer.trigger(availableNow=True) if trigger == "availableNow" else writer.trigger(processingTime=trigger)).start()


def stream_events(spark: SparkSession, root: str) -> DataFrame:
    """The events so far."""
    if not V.names_in(spark, f"{root}/events"):
        return spark.createDataFrame([], _EVENTS)
    return spark.read.schema(_EVENTS).option("recursiveFileLookup", True).parquet(f"{root}/events")


def late_rows(spark: SparkSession, root: str) -> DataFrame:
    """The rows that came too late, with the batch they came in."""
    if "late=true" not in V.names_in(spark, f"{root}/rows"):
        return spark.createDataFrame([], _STORED).drop("late", "slot")
    return (spark.read.schema(_STORED).option("basePath", f"{root}/rows").parquet(f"{root}/rows/late=true")
            .drop("late", "slot"))
