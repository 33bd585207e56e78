"""Query surface: parameter bounds (T-2), point queries and empty results
(T-7), Q9 counting vs the pairwise definition, oracle parity on sf0.001."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

from contrail.plans import queries as Q
from tests.conftest import SF0001, rows


@pytest.mark.parametrize("bad", [0, 101, -1, "10", True])
def test_limit_bounds(pipe0001, bad):
    with pytest.raises(ValueError):
        Q.q1_top_countries(pipe0001.graph, bad)


def test_min_snapshots_bound(pipe0001):
    with pytest.raises(ValueError):
        Q.q2_top_speed(pipe0001.graph, 10, 0)


def test_point_queries_normalise_and_empty(pipe0001):
    g = pipe0001.graph
    who = Q.q4_most_tracked(g).first().icao24
    a = Q.q4_trajectory(g, "  " + who.upper() + " ")
    assert a.count() > 0
    assert rows(a) == rows(Q.q4_trajectory_of_most_tracked(g))
    assert Q.q4_trajectory(g, "zzzzzz").count() == 0        # empty -> caller's 404
    busiest = Q.q11_most_events(g).first().icao24
    assert rows(Q.q11_aircraft_history(g, busiest.upper())) == rows(Q.q11_history_of_most_events(g))
    assert Q.q11_aircraft_history(g, "nobody").count() == 0


def test_q9_counting_equals_pairwise(pipe001):
    g = pipe001.graph
    full = Q.route_counts(g)
    pair = Q.q9_top_routes_pairwise(g, 100)
    top = {(r.origin, r.dest): r.flights for r in full.collect()}
    for r in pair.collect():
        assert top[(r.origin_icao, r.dest_icao)] == r.flights
    minute = {(r.origin, r.dest): r.flights for r in Q.route_counts(g, "minute").collect()}
    assert minute == top
    hour = {(r.origin, r.dest): r.flights for r in Q.route_counts(g, "hour").collect()}
    assert hour == top


def test_hubs_at_the_pair_grain_need_no_grouping(pipe001):
    g = pipe001.graph
    assert rows(Q.q3_proximity_hubs(g, one_row_per_pair=True)) == rows(Q.q3_proximity_hubs(g))


def test_near_grains_in_queries(pipe001):
    from contrail.operators.near import near_pairs
    obs = near_pairs(pipe001.clean, grain="observation")
    pair = pipe001.graph.near
    assert obs.count() >= pair.count()
    assert obs.select("icao24_a", "icao24_b").distinct().count() == pair.count()
    assert pair.filter(F.col("icao24_a") >= F.col("icao24_b")).count() == 0


def _registered():
    import __spark_entry__ as E
    return E.queries(), E.oracle_sql()


def test_every_query_of_the_library_has_an_oracle():
    """Those of the optional subpackage are held to SQL or brute force by its
    own tests."""
    from contrail.plans.registry import QUERIES
    qs, sqls = _registered()
    assert set(QUERIES) <= set(qs) and set(QUERIES) <= set(sqls) <= set(qs)


def _views():
    """All tables are views, as the driver has them."""
    con = duckdb.connect()
    for f in os.listdir(SF0001):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{os.path.join(SF0001, f)}')")
    return con


@pytest.mark.parametrize("name", sorted(n for n in _registered()[1] if n != "stream_ingest"))
def test_registered_query_matches_oracle_sf0001(spark, name):
    qs, sqls = _registered()
    s = qs[name](spark, SF0001)
    got = sorted(tuple(str(v) for v in r) for r in s.select(*sorted(s.columns)).collect())
    res = _views().execute(sqls[name])
    cols = [c[0] for c in res.description]
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    want = sorted(tuple(str(r[i]) for i in order) for r in res.fetchall())
    assert sorted(s.columns) == sorted(cols)
    assert got == want


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.columns == ["icao", "iata", "name", "country", "departures", "arrivals", "net_flow"]
    assert df.count() > 0
