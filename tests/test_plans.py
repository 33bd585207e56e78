"""Physical-plan shape checks for the scale-relevant operators."""

from contrail.operators.events import detect_flight_events
from contrail.operators.match import match_airports
from contrail.operators.near import near_pairs
from contrail.plans import queries as Q


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedup_limits_rows_before_the_shuffle(pipe001):
    p = plan(pipe001.clean)
    assert "WindowGroupLimit" in p and "Partial" in p
    assert p.index("Partial") > p.index("Exchange hashpartitioning(icao24")


def test_match_is_broadcast_and_row_local(spark, tmp_path, pipe001):
    # the batch job writes the catalogue first, so its bytes are known
    path = str(tmp_path / "airports")
    pipe001.airports.write.parquet(path)
    p = plan(match_airports(pipe001.events, spark.read.parquet(path)))
    assert "BroadcastHashJoin" in p
    assert "BroadcastNestedLoopJoin" not in p and "CartesianProduct" not in p
    # no window over the events after the join (the nearest airport is an array reduction)
    after_join = p[: p.index("BroadcastHashJoin")]
    assert "Window" not in after_join


def test_match_plans_nothing_by_running_it(spark, pipe001):
    """Building the plan starts no job; a catalogue without dense cells
    leaves no trace of the step that puts parts together."""
    sc = spark.sparkContext
    sc.setJobGroup("plan-only", "plan of the match")
    df = match_airports(pipe001.events, pipe001.airports)
    assert list(sc.statusTracker().getJobIdsForGroup("plan-only")) == []
    df.collect()
    p = plan(df)
    final = p[p.index("Final Plan"):p.index("Initial Plan")]
    assert "collect_set" not in final and "collect_set" in p[p.index("Initial Plan"):]


def test_dense_cells_are_matched_in_parts(spark):
    """1,000 airports around one hub, half of them with a twin in the same
    place: parts of about 100 give the rows of one list, repeats included."""
    import datetime as dt

    from pyspark.sql import functions as F
    n = 1000
    place = F.col("id") - F.col("id") % 2 * F.when(F.col("id") < n // 2, 1).otherwise(0)
    ap = spark.range(n).select(
        F.format_string("P%05d", "id").alias("icao_code"), F.lit("p").alias("name"),
        (F.lit(50.0) + (place * 7919 % n) / n * 0.1).alias("latitude"),
        (F.lit(8.0) + (place * 104729 % n) / n * 0.1).alias("longitude"))
    ev = spark.range(300).select(
        F.format_string("e%04d", F.col("id") % 250).alias("icao24"), F.lit(dt.datetime(2024, 1, 1)).alias("event_time"),
        F.lit("TAKEOFF").alias("event_type"), (F.lit(49.8) + F.col("id") % 250 * 0.002).alias("latitude"),
        F.lit(8.05).alias("longitude"), F.lit(10).alias("gap_seconds"), F.lit("b").alias("batch_id"))
    for mode in ("reference", "geodesic"):
        one, parted = (sorted(map(str, match_airports(ev, ap, mode=mode, cell_airports=k).collect())) for k in (10 * n, 100))
        assert one == parted and len(set(one)) < len(one)
        assert sum("NONE" not in r for r in one) > 150


def test_split_lag_window_keys(pipe001):
    p = plan(detect_flight_events(pipe001.clean, "b"))
    assert "_bucket" in p and "Window [lag" in p
    assert "SortAggregate" not in p  # tails use hash aggregation


def test_near_is_an_equi_join_with_hash_aggregate(pipe001):
    p = plan(near_pairs(pipe001.clean))
    assert "BroadcastNestedLoopJoin" not in p and "CartesianProduct" not in p
    assert ("SortMergeJoin" in p) or ("BroadcastHashJoin" in p) or ("ShuffledHashJoin" in p)
    assert "SortAggregate" not in p


def test_queries_avoid_expand_and_cross_products(pipe001):
    g = pipe001.graph
    for df in (Q.q3_proximity_hubs(g), Q.q7_departure_hotspots(g), Q.q9_top_routes(g),
               Q.q10_net_traffic(g), Q.q5_country_interactions(g)):
        p = plan(df)
        assert "Expand" not in p
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_scan_prunes_columns(spark):
    from contrail.sources.fixtures import fixture_tables
    raw, _ = fixture_tables(spark, "/root/testdata/sf0.01")
    p = plan(raw.select("icao24", "snapshot_time"))
    scan = [line for line in p.splitlines() if "FileScan parquet" in line][0]
    assert "value" not in scan.split("ReadSchema")[-1]


def test_at_scale_plans_without_broadcast(spark, pipe001):
    """With broadcasting disabled (as when the inputs are large) the joins
    become shuffle joins on the grid keys, never nested loops."""
    from contrail.session import session_conf
    with session_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1",
                              "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}):
        near = plan(near_pairs(pipe001.clean))
        assert "SortMergeJoin" in near or "ShuffledHashJoin" in near
        assert "BroadcastNestedLoopJoin" not in near and "CartesianProduct" not in near
        assert "hashpartitioning(snapshot_time" in near
        m = plan(match_airports(pipe001.events, pipe001.airports))
        assert "SortMergeJoin" in m or "ShuffledHashJoin" in m
        assert "BroadcastHashJoin" not in m and "rank(" not in m
        assert "BroadcastNestedLoopJoin" not in m and "CartesianProduct" not in m


def test_routes_scan_the_edges_once_and_join_nothing(spark, tmp_path, pipe001):
    """One scan of the flight edges, counts gathered by aircraft and node."""
    import dataclasses
    path = str(tmp_path / "edges")
    pipe001.graph.flight_edge.write.parquet(path)
    g = dataclasses.replace(pipe001.graph, flight_edge=spark.read.parquet(path))
    df = Q.route_counts(g)
    df.collect()
    p = plan(df)
    final = p[p.index("Final Plan"):p.index("Initial Plan")] if "Initial Plan" in p else p
    reads = [x for x in final.splitlines() if "FileScan parquet" in x]
    assert len(reads) == 1 and "ReusedExchange" in final
    assert "Window" not in final and "Join" not in final


def test_crowded_cells_are_compared_in_parts(spark):
    """A hub of 3,000 aircraft in one cell: as many rows as pairwise, dealt
    to many parts of the cell."""
    import datetime as dt

    from contrail.operators.near import airborne_positions, dense_cells, near_observations
    from pyspark.sql import functions as F
    n = 3000
    hub = spark.range(n + 400).select(
        F.format_string("a%05d", F.col("id")).alias("icao24"), F.lit(dt.datetime(2024, 1, 1)).alias("snapshot_time"),
        (F.when(F.col("id") < n, F.lit(50.0)).otherwise(F.lit(50.02)) + (F.col("id") * 7919 % n) / n * 0.04).alias("latitude"),
        (F.lit(8.0) + (F.col("id") * 104729 % n) / n * 0.06).alias("longitude"), F.lit(False).alias("on_ground"))
    cells = dense_cells(hub, 1.0, 200)
    assert cells.agg(F.max("parts")).first()[0] >= 3 and dense_cells(hub, 1.0, 100_000).isEmpty()
    plain = near_observations(hub, 1.0)
    parted = near_observations(hub, 1.0, cells)
    assert "part" in plan(parted)
    key = ["icao24_a", "icao24_b", "dist_km"]
    assert parted.count() == plain.count() > n and parted.select(key).exceptAll(plain.select(key)).isEmpty()
    air = airborne_positions(hub)
    from contrail.functions.geo import haversine_km
    a, b = air.toDF("a", "ta", "la", "lo"), air.toDF("b", "tb", "lb", "ob")
    pairs = a.join(b, a["a"] < b["b"]).filter(haversine_km(a["la"], a["lo"], b["lb"], b["ob"], 2) <= 1.0)
    assert pairs.count() == parted.count()
