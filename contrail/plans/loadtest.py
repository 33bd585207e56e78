"""A-11: load-test report (rows written, errors, duration, rate, loss)
and SRC-5 point-read latency, against the state-vector sink."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.constants import LOAD_TEST_BATCH, LOAD_TEST_ROWS
from contrail.session import session_conf
from contrail.sinks.tables import upsert_state_vectors
from contrail.sources.synthetic import synthetic_state_vectors


def point_read(table: DataFrame, icao24: str) -> DataFrame:
    """SRC-5 on a stored state-vector table: the newest row of one aircraft
    (the filter reaches the scan; files are sorted by icao24)."""
    key = icao24.strip().lower()
    return (table.filter(F.col("icao24") == key)
                 .orderBy(F.col("snapshot_time").desc()).limit(1))


def load_test(spark: SparkSession, table_path: str, total: int = LOAD_TEST_ROWS,
              batch_size: int = LOAD_TEST_BATCH, seed: int = 42,
              at: str = "2024-01-01 00:00:00", point_reads: int = 5) -> dict:
    """Write ``total`` synthetic rows as one distributed upsert
    (``batch_size`` is only reported, for comparison with row batching),
    read the table back to measure loss, and time point reads of a key that
    exists: the median of ``point_reads`` warm runs of one lookup plan (the
    first run, which lists files and reads footers, is reported apart)."""
    rows = synthetic_state_vectors(spark, total, seed, at)
    errors = 0
    t0 = time.perf_counter()
    try:
        upsert_state_vectors(rows, table_path)
    except Exception:  # noqa: BLE001 - the report counts failures
        errors = total
    duration = time.perf_counter() - t0
    table = spark.read.parquet(table_path)
    n = table.filter(F.col("icao24").startswith("stress-")).count()
    key = rows.select("icao24").first()[0]
    lookup = point_read(table, key)
    # a single-stage lookup: nothing for adaptive execution to re-plan
    with session_conf(spark, {"spark.sql.adaptive.enabled": "false"}):
        t1 = time.perf_counter()
        lookup.collect()
        first_ms = (time.perf_counter() - t1) * 1000.0
        reads = []
        for _ in range(max(1, point_reads)):
            t1 = time.perf_counter()
            lookup.collect()
            reads.append((time.perf_counter() - t1) * 1000.0)
    reads.sort()
    return {
        "inserted": total - errors, "errors": errors, "batch_size": batch_size,
        "duration_sec": round(duration, 3),
        "rows_per_sec": round(total / duration, 1) if duration else None,
        "loss_pct": round(100.0 * (total - n) / total, 2) if total else 0.0,
        "point_read_ms": round(reads[len(reads) // 2], 2),
        "point_read_first_ms": round(first_ms, 2),
    }
