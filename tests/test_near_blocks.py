"""NEAR pairs by blocks of aircraft: no pair is shuffled."""

import datetime as dt
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from contrail.operators import near as N
from contrail.plans import queries as Q

T0 = dt.datetime(2024, 1, 1)
POSITIONS = "icao24 string, snapshot_time timestamp, on_ground boolean, latitude double, longitude double"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def tracks(spark, seed, n=40):
    r = random.Random(seed)
    data = [(f"é{k}" if k % 9 == 0 else f"a{k:03d}", T0 + dt.timedelta(minutes=t), r.random() < 0.1,
             None if r.random() < 0.05 else r.choice([50.0, 89.9, -33.0]) + r.uniform(-0.3, 0.3) * (k % 2),
             r.choice([179.9, -179.95, 8.0]) + r.uniform(0, 0.1))
            for k in range(n) for t in range(6) if r.random() < 0.8]
    data += [(None, T0, False, 50.0, 8.0), ("a001", None, False, 50.0, 8.0), ("nan", T0, False, float("nan"), 8.0)]
    return spark.createDataFrame(data, POSITIONS)


@pytest.mark.parametrize(("radius", "blocks", "step"), [(50.0, 1, 500_000), (50.0, 5, 7), (3.2, 16, 500_000)])
def test_blocks_give_the_rows_of_the_join(spark, monkeypatch, radius, blocks, step):
    monkeypatch.setattr(N, "CANDIDATES", step)
    clean = tracks(spark, blocks)
    want = N.near_pairs(clean, radius)
    got = N.near_by_blocks(clean, radius, blocks=blocks)
    key = ["icao24_a", "icao24_b", "snapshot_time", "dist_km"]
    assert rows(got, *key) == rows(want, *key) and want.count() > 20
    tally = rows(N.near_by_blocks(clean, radius, True, blocks).select("icao24_a", "icao24_b", "observations", F.round("dist_sum", 6)))
    assert tally == rows(N.near_observations(clean, radius).groupBy("icao24_a", "icao24_b").agg(
        F.count(F.lit(1)), F.round(F.sum("dist_km"), 6)))


def test_no_pair_is_shuffled(pipe001):
    p = plan(pipe001.graph.near)
    assert "FlatMapGroupsInArrow" in p and "icao24_a" not in p[p.index("FlatMapGroupsInArrow") + 200:]
    assert "Exchange" not in p[:p.index("FlatMapGroupsInArrow")]


def test_integrity_makes_the_pairs_once(pipe001):
    assert plan(Q.edge_integrity(pipe001.graph)).count("FlatMapGroupsInArrow") == 1


def test_both_landings_are_written_by_many_tasks(spark, monkeypatch):
    from contrail.plans import roundtrips as R
    counts, ingest = [], R.start_ingest

    def seen(spark, landing, *args, **kw):
        counts.append(spark.read.text(landing).select(F.input_file_name()).distinct().count())
        return ingest(spark, landing, *args, **kw)
    monkeypatch.setattr(R, "start_ingest", seen)
    monkeypatch.setattr(R, "fixture_tables", lambda s, d, f=R.fixture_tables: (f(s, d)[0].repartition(6), None))
    conf = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(conf)
    spark.conf.set(conf, "false")
    try:
        R.stream_ingest_twice(spark, "/root/testdata/sf0.001")
    finally:
        spark.conf.set(conf, old)
    assert counts[0] == 6 and counts[1] - counts[0] > 2
