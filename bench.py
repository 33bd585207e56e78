"""Benchmark: the batch job and the analytical queries at $BENCH_SF_DIR.

Stages are timed as the job runs them: ingest (snapshot documents landed
from the driver's tables, parsed and appended to the date-partitioned
state-vector table), then the batch job over that table: clean (newest
write per key, checkpointed), events, airport match, flight events,
proximity + graph tables (written), then every query Q1..Q12 against the
written graph tables, as a served query would run. A load test (A-11:
synthetic rows, upsert, loss, point read) is reported alongside.

Prints one JSON line:
{"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from pyspark.sql import functions as F  # noqa: E402

from contrail.plans import queries as Q  # noqa: E402
from contrail.plans.loadtest import load_test  # noqa: E402
from contrail.plans.pipeline import FIXED_BATCH_ID, read_graph, run_batch  # noqa: E402
from contrail.session import local_session  # noqa: E402
from contrail.sinks.tables import append_partitions  # noqa: E402
from contrail.sources.fixtures import fixture_tables  # noqa: E402
from contrail.sources.snapshots import parse_snapshots, snapshots_from_state_vectors  # noqa: E402


def timed(results: dict, name: str, fn):
    from pyspark import SparkContext
    sc = SparkContext._active_spark_context
    if sc is not None:
        sc.setJobGroup(name, name)  # lets the event log attribute stages to this step
    t0 = time.perf_counter()
    out = fn()
    results[name] = round(time.perf_counter() - t0, 3)
    return out


def shuffle_totals(events_dir: str) -> dict:
    """Shuffle and scan volume of the whole run, summed from the task-end
    records of Spark's event log (written to the bench's scratch folder)."""
    tot = {"shuffle_write": 0, "shuffle_read": 0, "scan_input": 0}
    stage_group: dict[int, str] = {}
    by_group: dict[str, list] = {}
    files = [os.path.join(d, f) for d, _, fs in os.walk(events_dir) for f in fs
             if f.startswith(("events_", "local-", "app-")) and not f.endswith(".inprogress")]
    for path in files:
        if path.endswith(".zstd"):
            import io
            import zstandard
            raw = zstandard.ZstdDecompressor().stream_reader(open(path, "rb"))
            lines = io.TextIOWrapper(raw, encoding="utf-8")
        else:
            lines = open(path, encoding="utf-8")
        with lines as f:
            for line in f:
                if '"SparkListenerJobStart"' in line:
                    ev = json.loads(line)
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in ev.get("Stage IDs", []):
                        stage_group[sid] = group or "other"
                    continue
                if '"SparkListenerTaskEnd"' not in line:
                    continue
                ev = json.loads(line)
                m = ev.get("Task Metrics") or {}
                w = (m.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0)
                r = m.get("Shuffle Read Metrics") or {}
                rd = r.get("Remote Bytes Read", 0) + r.get("Local Bytes Read", 0)
                tot["shuffle_write"] += w
                tot["shuffle_read"] += rd
                tot["scan_input"] += (m.get("Input Metrics") or {}).get("Bytes Read", 0)
                g = by_group.setdefault(stage_group.get(ev.get("Stage ID"), "other"), [0, 0])
                g[0] += w
                g[1] += rd
    out = {k: round(v / (1 << 20), 1) for k, v in tot.items()}
    out["shuffle_write_by_step"] = {k: round(v[0] / (1 << 20), 2) for k, v in sorted(by_group.items())
                                    if v[0] or v[1]}
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    work = tempfile.mkdtemp(prefix="contrail-bench-", dir=os.environ.get("TMPDIR", "/tmp"))
    events_dir = os.path.join(work, "eventlog")
    os.makedirs(events_dir)
    spark = local_session(cpus, shuffle_partitions=max(8, int(cpus) * 2) if cpus.isdigit() else 16,
                          app_name="contrail-bench",
                          extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": events_dir})
    res: dict[str, float] = {}

    raw, airports = fixture_tables(spark, sf_dir)
    n_raw = raw.count()

    # ingest: land snapshot documents derived from the tables, then parse
    # them and append them to the date-partitioned state-vector table, as
    # the stream's micro-batches do (newest write per key wins on read)
    landing = os.path.join(work, "landing")
    snapshots_from_state_vectors(raw).write.json(landing)
    sv_path = os.path.join(work, "state_vectors")

    def ingest():
        docs = spark.read.schema("time BIGINT, states ARRAY<ARRAY<STRING>>").json(landing)
        rows = parse_snapshots(docs, seq=F.lit(0).cast("long"))
        append_partitions(rows, sv_path, "snapshot_time", "snapshot_date")
    timed(res, "ingest", ingest)

    spark.sparkContext.setJobGroup("load_test", "load_test")
    load = load_test(spark, os.path.join(work, "load_test"))

    # the batch job over the ingested table
    ingested = spark.read.parquet(sv_path).drop("snapshot_date")
    out = run_batch(spark, ingested, airports, os.path.join(work, "job"), batch_id=FIXED_BATCH_ID,
                    timings=res)
    graph_dir = out["graph_dir"]
    g = read_graph(spark, graph_dir)

    queries = {
        "q1": lambda: Q.q1_top_countries(g),
        "q2": lambda: Q.q2_top_speed(g),
        "q3": lambda: Q.q3_proximity_hubs(g),
        "q4h": lambda: Q.q4_most_tracked(g),
        "q4": lambda: Q.q4_trajectory_of_most_tracked(g),
        "q5": lambda: Q.q5_country_interactions(g),
        "q6": lambda: Q.q6_position_sources(g),
        "q7": lambda: Q.q7_departure_hotspots(g),
        "q8": lambda: Q.q8_arrival_hotspots(g),
        "q9": lambda: Q.q9_top_routes(g),
        "q10": lambda: Q.q10_net_traffic(g),
        "q11h": lambda: Q.q11_most_events(g),
        "q11": lambda: Q.q11_history_of_most_events(g),
        "q12": lambda: Q.graph_stats(g),
    }
    for name, fn in queries.items():
        timed(res, name, lambda fn=fn: fn().collect())

    total = round(sum(res.values()), 3)
    spark.stop()  # flushes the event log
    io = shuffle_totals(events_dir)
    print(json.dumps({
        "metric": "total_sec", "value": total, "unit": "sec", "queries": res, "sf": sf,
        "rows": {"state_vectors_raw": n_raw},
        "ingest_rows_per_sec": round(n_raw / res["ingest"], 1) if res["ingest"] else None,
        "load_test": load,
        "io_mb": io,
    }))


if __name__ == "__main__":
    main()
