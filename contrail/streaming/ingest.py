"""ST-1..ST-5: snapshot ingest as a Structured Streaming query.

Landed snapshot files (one JSON document per line) are the stream source;
every micro-batch is parsed (PL-1) and stored in the date-partitioned
state-vector table (SNK-1) inside ``foreachBatch``: appended by default
(cost = the micro-batch; the newest write per key wins when the table is
read, and closed days are compacted), or upserted with ``mode="upsert"``.
Either way a micro-batch replayed after a failure leaves the same result
(with the checkpointed source offsets). An empty micro-batch is a no-op.
``trigger`` is the poll period ("20 seconds") or ``availableNow`` for a
catch-up run before the batch job (ST-3).
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from contrail.constants import POLL_PERIOD_SECONDS
from contrail.schema import SNAPSHOT_JSON
from contrail.session import in_utc
from contrail.sinks.tables import append_partitions, upsert_state_vectors
from contrail.sources.snapshots import parse_snapshots

def snapshot_stream(spark: SparkSession, landing_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(SNAPSHOT_JSON)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(landing_dir)


@in_utc
def ingest_batch(batch: DataFrame, epoch_id: int, table_path: str,
                 bbox: tuple[float, float, float, float] | None = None, mode: str = "append") -> dict:
    """Parse and store one micro-batch. ``ingest_seq`` = epoch, so for one
    key a later micro-batch wins; inside one micro-batch the newer report
    (higher ``last_contact``) wins.

    ``mode="append"`` (default) writes the rows into their date partitions
    and leaves duplicates of a key to the reader (the batch job keeps the
    newest write) and to :func:`~contrail.sinks.tables.compact`: the cost of
    a micro-batch is its own size. A replayed micro-batch appends identical
    rows, which the same rule removes. ``mode="upsert"`` rewrites the touched
    date partitions (a keyed table at every moment, at the cost of
    rewriting a day per micro-batch)."""
    t0 = time.perf_counter()
    rows = parse_snapshots(batch, bbox, seq=F.lit(int(epoch_id)).cast("long"))
    obs = Observation(f"ingest_{epoch_id}")
    observed = rows.observe(obs, F.count(F.lit(1)).alias("rows"))
    if mode == "upsert":
        touched = upsert_state_vectors(observed, table_path)
    elif mode == "append":
        append_partitions(observed.filter(F.col("icao24").isNotNull() & F.col("snapshot_time").isNotNull()),
                          table_path, "snapshot_time", "snapshot_date")
        touched = None
    else:
        raise ValueError(f"mode must be 'append' or 'upsert', got {mode!r}")
    # A-10: the count is collected by the first action on the batch
    return {"epoch": int(epoch_id), "rows": int(obs.get["rows"]), "partitions": touched,
            "seconds": time.perf_counter() - t0}


def start_ingest(spark: SparkSession, landing_dir: str, table_path: str, checkpoint_location: str,
                 bbox: tuple[float, float, float, float] | None = None,
                 trigger: str = "poll", on_batch: Callable[[dict], None] | None = None,
                 mode: str = "append", max_files_per_trigger: int | None = None):
    """Start the ingest query. ``trigger``: "poll" (every 20 s),
    "availableNow" (process what has landed, then stop) or a processing
    time like "5 seconds". ``max_files_per_trigger`` bounds a micro-batch
    when a backlog has built up."""
    def handle(batch: DataFrame, epoch_id: int) -> None:
        stats = ingest_batch(batch, epoch_id, table_path, bbox, mode)
        if on_batch is not None:
            on_batch(stats)

    writer = (snapshot_stream(spark, landing_dir, max_files_per_trigger).writeStream
              .foreachBatch(handle)
              .option("checkpointLocation", checkpoint_location))
    if trigger == "availableNow":
        writer = writer.trigger(availableNow=True)
    elif trigger == "poll":
        writer = writer.trigger(processingTime=f"{POLL_PERIOD_SECONDS} seconds")
    else:
        writer = writer.trigger(processingTime=trigger)
    return writer.start()


def ingest_metrics(query) -> list[dict]:
    """A-10: per micro-batch rows seen, rows/s and batch latency, from the
    query's progress reports (small, one entry per micro-batch)."""
    out = []
    for p in query.recentProgress:
        dur = p.get("durationMs", {}) if isinstance(p, dict) else p.durationMs
        out.append({
            "batch": p["batchId"] if isinstance(p, dict) else p.batchId,
            "rows": p["numInputRows"] if isinstance(p, dict) else p.numInputRows,
            "rows_per_sec": (p["processedRowsPerSecond"] if isinstance(p, dict)
                             else p.processedRowsPerSecond),
            "batch_ms": dur.get("triggerExecution", 0) if isinstance(dur, dict) else 0,
        })
    return out
