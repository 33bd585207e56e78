"""Q1..Q12: the analytical queries over the graph tables.

Each function takes a :class:`~contrail.operators.graph.Graph` and returns a
DataFrame with the output columns of the query. Top-N ties are broken by
the key columns ascending. Attribute lookups (callsign, airport fields) run
after the top-N, against a result of at most ``limit`` (<= 100) rows, so
they are broadcast joins of a proven-small side.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail import constants as K
from contrail.functions.labels import check_limit, check_min_snapshots, normalize_icao
from contrail.operators.graph import Graph
from contrail.session import in_utc


def _lim(limit: int | None, q: str) -> int:
    return check_limit(K.DEFAULT_LIMITS[q] if limit is None else limit)


def _round2(x: Column) -> Column:
    """Round half up to 2 decimals, exact ties up whatever the float noise."""
    return F.round(x + F.lit(1e-9), 2)


def _good(edges: DataFrame, rel_type: str) -> DataFrame:
    """F-12: edges of one type with confidence HIGH or MEDIUM."""
    return edges.filter((F.col("rel_type") == rel_type) & F.col("confidence").isin(*K.GOOD_CONFIDENCES))


# --------------------------------------------------------------------------
# Q1 countries by fleet
# --------------------------------------------------------------------------

def q1_top_countries(g: Graph, limit: int | None = None) -> DataFrame:
    n = _lim(limit, "q1")
    return (g.operates.groupBy(F.col("country")).agg(F.count(F.lit(1)).alias("aircraft_count"))
             .orderBy(F.col("aircraft_count").desc(), F.col("country").asc()).limit(n))


# --------------------------------------------------------------------------
# Q2 fastest aircraft by mean airborne speed
# --------------------------------------------------------------------------

def q2_top_speed(g: Graph, limit: int | None = None,
                 min_snapshots: int = K.DEFAULT_MIN_SNAPSHOTS) -> DataFrame:
    n = _lim(limit, "q2")
    check_min_snapshots(min_snapshots)
    airborne = g.snapshot_edge.filter((F.col("on_ground") == F.lit(False)) & F.col("velocity").isNotNull())
    agg = (airborne.groupBy("icao24")
                   .agg(F.avg("velocity").alias("_avg"), F.count(F.lit(1)).alias("snapshots"))
                   .filter(F.col("snapshots") >= min_snapshots))
    order = [F.col("avg_velocity_ms").desc(), F.col("icao24").asc()]
    top = (agg.select("icao24", _round2(F.col("_avg")).alias("avg_velocity_ms"),
                      _round2(F.col("_avg") * 3.6).alias("avg_velocity_kmh"), "snapshots")
              .orderBy(*order).limit(n))
    return (g.aircraft.select("icao24", "callsign").join(F.broadcast(top), "icao24", "right")
             .select("icao24", "callsign", "avg_velocity_ms", "avg_velocity_kmh", "snapshots")
             .orderBy(*order))


# --------------------------------------------------------------------------
# Q3 proximity hubs
# --------------------------------------------------------------------------

def _near_by_aircraft(near: DataFrame, one_row_per_pair: bool) -> DataFrame:
    """Per aircraft, over its undirected NEAR edges: distinct neighbours,
    sum and count of distances. Pairs are combined first (unless each is one
    row already, or a tally of its observations), then each pair is credited
    to both ends (no Expand-based distinct count)."""
    if "observations" in near.columns:
        per_pair = near.select("icao24_a", "icao24_b", F.col("dist_sum").alias("_s"), F.col("observations").alias("_c"))
    elif one_row_per_pair:
        per_pair = near.select("icao24_a", "icao24_b", F.col("dist_km").alias("_s"), F.lit(1).cast("long").alias("_c"))
    else:
        per_pair = near.groupBy("icao24_a", "icao24_b").agg(
            F.sum("dist_km").alias("_s"), F.count(F.lit(1)).alias("_c"))
    ends = per_pair.select(F.col("icao24_a").alias("icao24"), "_s", "_c").unionByName(
        per_pair.select(F.col("icao24_b").alias("icao24"), "_s", "_c"))
    return ends.groupBy("icao24").agg(F.count(F.lit(1)).alias("near_count"),
                                      F.sum("_s").alias("_s"), F.sum("_c").alias("_c"))


def q3_proximity_hubs(g: Graph, limit: int | None = None, one_row_per_pair: bool = False) -> DataFrame:
    """``one_row_per_pair``: the graph holds NEAR at the pair grain, so the
    pairs need no grouping before they are credited to their ends."""
    n = _lim(limit, "q3")
    order = [F.col("near_count").desc(), F.col("icao24").asc()]
    top = (_near_by_aircraft(g.near, one_row_per_pair)
           .select("icao24", "near_count", _round2(F.col("_s") / F.col("_c")).alias("avg_dist_km"))
           .orderBy(*order).limit(n))
    return (g.aircraft.select("icao24", "callsign").join(F.broadcast(top), "icao24", "right")
             .select("icao24", "callsign", "near_count", "avg_dist_km").orderBy(*order))


# --------------------------------------------------------------------------
# Q4 trajectory / most tracked aircraft
# --------------------------------------------------------------------------

def _trajectory_rows(edges: DataFrame) -> DataFrame:
    return (edges.filter(F.col("baro_altitude").isNotNull())
                 .select(F.col("snapshot_time_str").alias("timestamp"),
                         F.col("baro_altitude").alias("altitude_m"),
                         F.col("velocity").alias("velocity_ms"),
                         "velocity_kmh",
                         F.col("vertical_rate").alias("vertical_rate_ms"),
                         "latitude", "longitude", "on_ground", "snapshot_time"))


@in_utc
def q4_trajectory(g: Graph, icao24: str) -> DataFrame:
    """Snapshots of one aircraft with a known altitude, in time order
    (empty result = unknown aircraft; the caller decides)."""
    key = normalize_icao(icao24)
    edges = g.snapshot_edge.filter(F.col("icao24") == key).withColumn(
        "snapshot_time_str", F.date_format("snapshot_time", K.SNAPSHOT_TIME_FORMAT))
    return _trajectory_rows(edges).orderBy("snapshot_time").drop("snapshot_time")


def q4_most_tracked(g: Graph) -> DataFrame:
    return (g.snapshot_edge.groupBy("icao24").agg(F.count(F.lit(1)).alias("snapshots"))
             .orderBy(F.col("snapshots").desc(), F.col("icao24").asc()).limit(1))


@in_utc
def q4_trajectory_of_most_tracked(g: Graph) -> DataFrame:
    """Q4 for the aircraft Q4h picks, as one plan (no driver round trip)."""
    who = F.broadcast(q4_most_tracked(g).select("icao24"))
    edges = g.snapshot_edge.join(who, "icao24", "left_semi").withColumn(
        "snapshot_time_str", F.date_format("snapshot_time", K.SNAPSHOT_TIME_FORMAT))
    return _trajectory_rows(edges).orderBy("snapshot_time").drop("snapshot_time")


# --------------------------------------------------------------------------
# Q5 country interactions
# --------------------------------------------------------------------------

def q5_country_interactions(g: Graph, limit: int | None = None) -> DataFrame:
    """Country pairs of aircraft joined by NEAR, both orientations, c1 <> c2.
    Each edge is mapped to its two countries once, counted per (ca, cb),
    and the small result is mirrored. Edges that carry the countries of their
    ends (labels that went along with the aircraft) are counted where they
    are made; others are joined, and shuffled for it where OPERATES, which
    grows with the fleet, has too many bytes to be broadcast."""
    n = _lim(limit, "q5")
    ops = g.operates
    edges = F.sum("observations") if "observations" in g.near.columns else F.count(F.lit(1))
    if "label_a" in g.near.columns:
        ends = g.near.withColumnsRenamed({"label_a": "ca", "label_b": "cb"})
    else:
        ca = ops.select(F.col("icao24").alias("icao24_a"), F.col("country").alias("ca"))
        cb = ops.select(F.col("icao24").alias("icao24_b"), F.col("country").alias("cb"))
        ends = g.near.drop("snapshot_time", "snapshot_time_str").join(ca, "icao24_a").join(cb, "icao24_b")
    per = ends.filter(F.col("ca") != F.col("cb")).groupBy("ca", "cb").agg(edges.alias("w"))
    mirrored = per.select(F.col("ca").alias("country_a"), F.col("cb").alias("country_b"), "w").unionByName(
        per.select(F.col("cb").alias("country_a"), F.col("ca").alias("country_b"), "w"))
    return (mirrored.groupBy("country_a", "country_b").agg(F.sum("w").alias("interactions"))
                    .orderBy(F.col("interactions").desc(), F.col("country_a"), F.col("country_b"))
                    .limit(n))


# --------------------------------------------------------------------------
# Q6 position-source distribution
# --------------------------------------------------------------------------

def q6_position_sources(g: Graph) -> DataFrame:
    return (g.aircraft.groupBy(F.col("position_source_label").alias("source_label"))
             .agg(F.count(F.lit(1)).alias("aircraft_count"))
             .orderBy(F.col("aircraft_count").desc(), F.col("source_label").asc()))


# --------------------------------------------------------------------------
# Q7 / Q8 departure and arrival hotspots
# --------------------------------------------------------------------------

def _hotspots(g: Graph, rel_type: str, measure: str, limit: int) -> DataFrame:
    per_aircraft = _good(g.flight_edge, rel_type).groupBy("airport_icao", "icao24").agg(
        F.count(F.lit(1)).alias("_n"))
    order = [F.col(measure).desc(), F.col("airport_icao").asc()]
    top = (per_aircraft.groupBy("airport_icao")
                       .agg(F.sum("_n").alias(measure), F.count(F.lit(1)).alias("unique_aircraft"))
                       .orderBy(*order).limit(limit))
    ap = g.airport.select(F.col("icao").alias("airport_icao"), F.col("iata").alias("airport_iata"),
                          F.col("name").alias("airport_name"), "city", "country")
    return (F.broadcast(top).join(ap, "airport_icao")
             .select("airport_icao", "airport_iata", "airport_name", "city", "country",
                     measure, "unique_aircraft").orderBy(*order))


def q7_departure_hotspots(g: Graph, limit: int | None = None) -> DataFrame:
    return _hotspots(g, K.DEPARTED_FROM, "departures", _lim(limit, "q7"))


def q8_arrival_hotspots(g: Graph, limit: int | None = None) -> DataFrame:
    return _hotspots(g, K.ARRIVED_AT, "arrivals", _lim(limit, "q8"))


# --------------------------------------------------------------------------
# Q9 top routes
# --------------------------------------------------------------------------

# seconds of a time block and levels of halving over all blocks
_SPLITS = {"day": (86_400, 18), "hour": (3_600, 23), "minute": (60, 28)}


@in_utc
def route_counts(g: Graph, split_unit: str = "day") -> DataFrame:
    """flights(origin, dest) = number of (departure, arrival) pairs of the
    same aircraft with departure time < arrival time and origin <> dest
    (every departure pairs with every later arrival, not only the next).

    Counted without listing the pairs, from one scan. Events are gathered by
    (aircraft, time block). Pairs inside a block are listed from its two
    arrays. Two different blocks part ways at exactly one level of a binary
    tree over time: the earlier one lies in the left half of a node, the later
    one in the right half. So each block's departures are counted once for
    every level where it is a left half, its arrivals where it is a right
    half, and the counts meet at the (aircraft, node): two lists with each
    airport at most once, so there is no join at all.
    """
    seconds, levels = _SPLITS[split_unit]
    edges = g.flight_edge.filter(F.col("rel_type").isin(K.DEPARTED_FROM, K.ARRIVED_AT)
                                 & F.col("confidence").isin(*K.GOOD_CONFIDENCES))
    block = F.floor(F.unix_seconds(F.col("event_time").cast("timestamp")) / seconds) + (1 << (levels - 1))
    seen = F.struct(F.col("event_time").alias("t"), F.col("airport_icao").alias("airport"))
    per = edges.groupBy("icao24", block.cast("long").alias("b")).agg(
        F.collect_list(F.when(F.col("rel_type") == K.DEPARTED_FROM, seen)).alias("deps"),
        F.collect_list(F.when(F.col("rel_type") == K.ARRIVED_AT, seen)).alias("arrs"))

    # pairs inside one (aircraft, block)
    pairs = (per.filter((F.size("deps") > 0) & (F.size("arrs") > 0))
                .select("arrs", F.explode("deps").alias("d")).select("d", F.explode("arrs").alias("a"))
                .filter((F.col("d.t") < F.col("a.t")) & (F.col("d.airport") != F.col("a.airport"))))
    within = (pairs.groupBy(F.col("d.airport").alias("origin"), F.col("a.airport").alias("dest"))
                   .agg(F.count(F.lit(1)).alias("flights")))

    # pairs across blocks, from counts at the nodes where they part
    def side(events: str, half: int) -> Column:
        return F.transform(events, lambda e: F.struct(F.lit(half).alias("half"), e["airport"].alias("airport")))

    one = per.select("icao24", "b", F.explode(F.concat(side("deps", 0), side("arrs", 1))).alias("e"))
    at = one.select("icao24", "b", "e.half", "e.airport", F.explode(F.expr(
        f"filter(sequence(0, {levels - 1}), l -> shiftright(b, l) % 2 = e.half)")).alias("level"))
    counts = at.groupBy("icao24", "level", F.expr("shiftright(b, level + 1)").alias("node"), "half", "airport").agg(
        F.count(F.lit(1)).alias("n"))
    tally = F.struct("airport", "n")
    nodes = counts.groupBy("icao24", "level", "node").agg(
        F.collect_list(F.when(F.col("half") == 0, tally)).alias("deps"), F.collect_list(F.when(F.col("half") == 1, tally)).alias("arrs"))
    across = (nodes.select("arrs", F.explode("deps").alias("d")).select("d", F.explode("arrs").alias("a"))
              .filter(F.col("d.airport") != F.col("a.airport"))
              .groupBy(F.col("d.airport").alias("origin"), F.col("a.airport").alias("dest"))
              .agg(F.sum(F.col("d.n") * F.col("a.n")).alias("flights")))
    return (within.unionByName(across).groupBy("origin", "dest")
                  .agg(F.sum("flights").alias("flights")))


@in_utc
def q9_top_routes(g: Graph, limit: int | None = None) -> DataFrame:
    n = _lim(limit, "q9")
    order = [F.col("flights").desc(), F.col("origin_icao").asc(), F.col("dest_icao").asc()]
    top = (route_counts(g).select(F.col("origin").alias("origin_icao"), F.col("dest").alias("dest_icao"),
                                  "flights")
           .orderBy(*order).limit(n))
    o = g.airport.select(F.col("icao").alias("origin_icao"), F.col("iata").alias("origin_iata"),
                         F.col("city").alias("origin_city"))
    d = g.airport.select(F.col("icao").alias("dest_icao"), F.col("iata").alias("dest_iata"),
                         F.col("city").alias("dest_city"))
    return (F.broadcast(F.broadcast(top).join(o, "origin_icao")).join(d, "dest_icao")
             .select("origin_icao", "origin_iata", "origin_city", "dest_icao", "dest_iata",
                     "dest_city", "flights").orderBy(*order))


def q9_top_routes_pairwise(g: Graph, limit: int | None = None) -> DataFrame:
    """Q9 by the direct self-join of departures and arrivals (per-aircraft
    quadratic). Kept as the cross-check of :func:`route_counts` in tests."""
    n = _lim(limit, "q9")
    deps = _good(g.flight_edge, K.DEPARTED_FROM).select(
        "icao24", F.col("airport_icao").alias("origin_icao"), F.col("event_time").alias("t_dep"))
    arrs = _good(g.flight_edge, K.ARRIVED_AT).select(
        "icao24", F.col("airport_icao").alias("dest_icao"), F.col("event_time").alias("t_arr"))
    return (deps.join(arrs, "icao24")
                .filter((F.col("t_dep") < F.col("t_arr")) & (F.col("origin_icao") != F.col("dest_icao")))
                .groupBy("origin_icao", "dest_icao").agg(F.count(F.lit(1)).alias("flights"))
                .orderBy(F.col("flights").desc(), "origin_icao", "dest_icao").limit(n))


# --------------------------------------------------------------------------
# Q10 net traffic per airport
# --------------------------------------------------------------------------

def q10_net_traffic(g: Graph, limit: int | None = None) -> DataFrame:
    """Departures and arrivals per airport in one conditional aggregate
    over the good-confidence edges (one scan, one map-side-combined
    shuffle; never the cross product that count(DISTINCT) would undo)."""
    n = _lim(limit, "q10")
    good = g.flight_edge.filter(F.col("confidence").isin(*K.GOOD_CONFIDENCES)
                                & F.col("rel_type").isin(K.DEPARTED_FROM, K.ARRIVED_AT))
    both = good.groupBy(F.col("airport_icao").alias("icao")).agg(
        F.count_if(F.col("rel_type") == K.DEPARTED_FROM).alias("departures"),
        F.count_if(F.col("rel_type") == K.ARRIVED_AT).alias("arrivals"))
    order = [(F.col("departures") + F.col("arrivals")).desc(), F.col("icao").asc()]
    top = both.orderBy(*order).limit(n)
    return (F.broadcast(top).join(g.airport.select("icao", "iata", "name", "country"), "icao")
             .select("icao", "iata", "name", "country", "departures", "arrivals",
                     (F.col("departures") - F.col("arrivals")).alias("net_flow"))
             .orderBy(*order))


# --------------------------------------------------------------------------
# Q11 airport history of an aircraft / aircraft with most events
# --------------------------------------------------------------------------

def _history(edges: DataFrame, g: Graph) -> DataFrame:
    ap = g.airport.select(F.col("icao").alias("airport_icao"), F.col("iata").alias("airport_iata"),
                          F.col("name").alias("airport_name"), "city", "country")
    return (edges.join(ap, "airport_icao")
                 .select(F.col("rel_type").alias("event_type"), "event_time", "airport_icao",
                         "airport_iata", "airport_name", "city", "country", "confidence", "dist_km")
                 .orderBy("event_time", "event_type", "airport_icao"))


def q11_aircraft_history(g: Graph, icao24: str) -> DataFrame:
    """All flight edges of one aircraft (every confidence kept; NONE never
    becomes an edge) with the airport's attributes, in time order."""
    key = normalize_icao(icao24)
    return _history(g.flight_edge.filter(F.col("icao24") == key), g)


def q11_most_events(g: Graph) -> DataFrame:
    return (g.flight_edge.groupBy("icao24").agg(F.count(F.lit(1)).alias("n"))
             .orderBy(F.col("n").desc(), F.col("icao24").asc()).limit(1))


def q11_history_of_most_events(g: Graph) -> DataFrame:
    who = F.broadcast(q11_most_events(g).select("icao24"))
    return _history(g.flight_edge.join(who, "icao24", "left_semi"), g)


# --------------------------------------------------------------------------
# Q12 graph statistics and data-quality checks
# --------------------------------------------------------------------------

def graph_stats(g: Graph) -> DataFrame:
    """A-8: node and edge counts; NEAR counted once per undirected edge."""
    def cnt(df: DataFrame, entity: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(entity).alias("entity"), "n")

    parts = [
        cnt(g.aircraft, "aircraft"), cnt(g.country, "countries"), cnt(g.airport, "airports"),
        cnt(g.snapshot, "snapshots"), cnt(g.operates, "operates"),
        cnt(g.snapshot_edge, "snapshot_edges"), cnt(g.near, "near"),
    ]
    # both flight-edge types from one pass
    by_type = g.flight_edge.agg(
        F.count_if(F.col("rel_type") == K.DEPARTED_FROM).alias("departed_from"),
        F.count_if(F.col("rel_type") == K.ARRIVED_AT).alias("arrived_at"))
    parts.append(by_type.select(F.lit("departed_from").alias("entity"), F.col("departed_from").alias("n")))
    parts.append(by_type.select(F.lit("arrived_at").alias("entity"), F.col("arrived_at").alias("n")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def key_uniqueness(g: Graph, airports: DataFrame | None = None) -> DataFrame:
    """A-12: keys that occur more than once (expected: none in the node
    tables; the raw catalogue may repeat codes)."""
    def dups(df: DataFrame, key: str, entity: str) -> DataFrame:
        return (df.groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("n"))
                  .filter(F.col("n") > 1).select(F.lit(entity).alias("entity"), "key", "n"))

    out = dups(g.aircraft, "icao24", "aircraft").unionByName(dups(g.country, "name", "country")) \
        .unionByName(dups(g.airport, "icao", "airport"))
    if airports is not None:
        out = out.unionByName(dups(airports.filter(F.col("icao_code").isNotNull()), "icao_code",
                                   "airport_catalogue"))
    return out


def edge_integrity(g: Graph) -> DataFrame:
    """SNK-9 / J-6 as a check: per edge table, the edges whose endpoint is
    missing from its node table (left anti joins; expected 0 everywhere).
    Node key sides are projected to the key only."""
    aircraft = g.aircraft.select("icao24")
    checks = [
        ("operates.country", g.operates.select(F.col("country").alias("k")), g.country.select(F.col("name").alias("k"))),
        ("operates.aircraft", g.operates.select(F.col("icao24").alias("k")), aircraft.withColumnRenamed("icao24", "k")),
        ("snapshot_edge.aircraft", g.snapshot_edge.select(F.col("icao24").alias("k")), aircraft.withColumnRenamed("icao24", "k")),
        ("snapshot_edge.snapshot", g.snapshot_edge.select(F.col("snapshot_id").alias("k")), g.snapshot.select(F.col("id").alias("k"))),
        ("flight_edge.aircraft", g.flight_edge.select(F.col("icao24").alias("k")), aircraft.withColumnRenamed("icao24", "k")),
        ("flight_edge.airport", g.flight_edge.select(F.col("airport_icao").alias("k")), g.airport.select(F.col("icao").alias("k"))),
    ]
    parts = [edges.join(nodes, "k", "left_anti").agg(F.count(F.lit(1)).alias("missing"))
                  .select(F.lit(name).alias("edge_end"), "missing") for name, edges, nodes in checks]
    # the pairs, by far the most edges, are made once and joined as counts by aircraft
    ends = (g.near.select(F.explode(F.array(F.struct(F.lit(True).alias("is_a"), F.col("icao24_a").alias("k")),
                                            F.struct(F.lit(False).alias("is_a"), F.col("icao24_b").alias("k")))).alias("e"))
                  .groupBy("e.is_a", "e.k").agg(F.count(F.lit(1)).alias("n")))
    missing = (ends.join(aircraft, ends["k"] == aircraft["icao24"], "left_anti")
                   .agg(*[F.coalesce(F.sum(F.when(F.col("is_a") == side, F.col("n"))), F.lit(0)).alias("n")
                          for side in (True, False)]).toDF("a", "b"))
    parts.insert(4, missing.select(F.explode(F.array(
        F.struct(F.lit("near.a").alias("edge_end"), F.col("a").alias("missing")),
        F.struct(F.lit("near.b").alias("edge_end"), F.col("b").alias("missing")))).alias("e")).select("e.*"))
    return reduce(DataFrame.unionByName, parts)
