"""PL-6 near_pairs: aircraft flying within a radius of each other at the
same snapshot time (J-2).

Condition: same snapshot_time, both airborne (on_ground = false, null
excluded) and positioned, icao24_a < icao24_b, haversine rounded to 2
decimals <= radius.

Plan: an equi-join on (snapshot_time, grid key). The probe side keeps its
single key; the build side is replicated to the keys it can reach (at most
2 latitude bands x 2 longitude cells, usually 1-2), so every pair within
the radius meets in exactly one key and no per-snapshot cross product is
formed. Both sides shuffle on the same key; AQE splits hot keys.

Grains: ``"observation"`` is one row per pair and snapshot; ``"pair"``
(the stored graph, one edge per pair) keeps the values of the pair's
latest snapshot, via a map-side-combined ``max_by`` aggregate.

:func:`near_by_blocks` has the rows of a pair without shuffling any pair:
aircraft are dealt to blocks, a task gets the tracks of two blocks and sees
all snapshots of each pair of theirs. What is shuffled are positions, once
for each other block.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.constants import EARTH_RADIUS_KM, NEAR_DIST_DECIMALS, NEAR_RADIUS_KM
from contrail.functions.geo import explode_radius_keys, haversine_km, radius_key
from contrail.functions.labels import time_string
from contrail.session import ship_code



def airborne_positions(clean: DataFrame) -> DataFrame:
    """F-5: airborne and positioned rows, narrow projection."""
    return (clean.filter((F.col("on_ground") == F.lit(False)) & F.col("latitude").isNotNull()
                         & F.col("longitude").isNotNull())
                 .select("icao24", "snapshot_time", "latitude", "longitude"))


DENSE_CELL = 2_000  # aircraft of one cell and snapshot that one task compares


def _cell_of(air: DataFrame, radius_km: float) -> list:
    key = radius_key(F.col("latitude"), F.col("longitude"), radius_km)
    return ["snapshot_time", key["gy"].alias("gy"), key["gx"].alias("gx")]


def dense_cells(clean: DataFrame, radius_km: float = NEAR_RADIUS_KM, bound: int = DENSE_CELL) -> DataFrame:
    """Cells of one snapshot with more than ``bound`` aircraft, and the
    number of ``parts`` to compare them in: (snapshot_time, gy, gx, parts)."""
    air = airborne_positions(clean)
    return (air.groupBy(*_cell_of(air, radius_km)).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > bound)
               .select("snapshot_time", "gy", "gx", F.ceil(F.col("n") / bound).cast("int").alias("parts")))


def _in_parts(rows: DataFrame, dense: DataFrame, keys: list[str], part) -> DataFrame:
    """``rows`` with ``part``, made from the number of parts of their cell."""
    cells = dense.toDF("_t", "_gy", "_gx", "_parts")
    t, gy, gx = keys
    return (rows.join(cells, (rows[t] == cells["_t"]) & (rows[gy] == cells["_gy"]) & (rows[gx] == cells["_gx"]), "left")
                .withColumn(part[0], part[1](F.coalesce("_parts", F.lit(1)))).drop("_t", "_gy", "_gx", "_parts"))


def _unit_vector(side: str) -> list:
    lat, lon = F.radians("latitude"), F.radians("longitude")
    return [c.alias(f"{x}_{side}") for x, c in
            (("x", F.cos(lat) * F.cos(lon)), ("y", F.cos(lat) * F.sin(lon)), ("z", F.sin(lat)))]


def _half_chords(radius_km: float) -> tuple[float, float]:
    """Squared half chords below which a distance surely rounds to at most
    ``radius_km``, and above which it surely does not."""
    slack = 10.0 ** -NEAR_DIST_DECIMALS
    return tuple(math.sin(min(max(r, 0.0) / (2.0 * EARTH_RADIUS_KM), math.pi / 2)) ** 2
                 for r in (radius_km - slack, radius_km + slack))


def _half_chord():
    """The squared half chord of a pair, by its vectors."""
    dx, dy, dz = (F.col(f"{x}_a") - F.col(f"{x}_b") for x in "xyz")
    return (dx * dx + dy * dy + dz * dz) / 4.0


def _near(radius_km: float):
    """Whether a pair's rounded distance is at most ``radius_km``: by the
    vectors, and about the radius by the distance itself."""
    surely, maybe = _half_chords(radius_km)
    a = _half_chord()
    rounded = haversine_km("lat_a", "lon_a", "lat_b", "lon_b", NEAR_DIST_DECIMALS)
    return (a < surely) | ((a <= maybe) & (rounded <= radius_km))


SMALL = 1e-4  # squared half chord up to which the series of the arc has all digits
TIE = 1e-6    # of the last decimal: nearer to a tie, the haversine formula and decimal arithmetic round


def _rounded_distance(radius_km: float):
    """The rounded distance of a pair of :func:`_near`."""
    exact = haversine_km("lat_a", "lon_a", "lat_b", "lon_b")
    if _half_chords(radius_km)[1] > SMALL:
        dist = exact
    else:
        a = _half_chord()
        dist = 2.0 * EARTH_RADIUS_KM * F.sqrt(a) * (1.0 + a * (1 / 6 + a * (3 / 40 + a * (15 / 336))))
    scale = 10.0 ** NEAR_DIST_DECIMALS
    whole = F.floor(dist * scale + 0.5)
    rest = dist * scale + 0.5 - whole
    return F.when((rest > TIE) & (rest < 1 - TIE), whole / scale).otherwise(F.round(exact, NEAR_DIST_DECIMALS))


def near_observations(clean: DataFrame, radius_km: float = NEAR_RADIUS_KM, dense: DataFrame | None = None) -> DataFrame:
    """One row per (pair, snapshot_time) within ``radius_km``. ``dense``:
    cells to compare in parts (:func:`dense_cells`); the probing aircraft of
    such a cell are dealt to its parts, the others go to each of them, so that
    a crowded hub is spread over tasks. The rows are the same.

    Pairs outnumber positions by far, so what one position gives (time string,
    unit vector) is made before the join, and a pair is judged by names first,
    then by products of the vectors. Both sides are sorted rows (never a
    broadcast, where Spark would make the columns of a position once a pair)."""
    air = airborne_positions(clean)
    key = radius_key(F.col("latitude"), F.col("longitude"), radius_km)
    probe = air.select(F.col("icao24").alias("icao24_a"), "snapshot_time",
                       time_string(F.col("snapshot_time")).alias("snapshot_time_str"),
                       F.col("latitude").alias("lat_a"), F.col("longitude").alias("lon_a"), *_unit_vector("a"),
                       key["gy"].alias("gy"), key["gx"].alias("gx"))
    build = explode_radius_keys(
        air.select(F.col("icao24").alias("icao24_b"), F.col("snapshot_time").alias("t_b"),
                   F.col("latitude").alias("lat_b"), F.col("longitude").alias("lon_b"), *_unit_vector("b")),
        "lat_b", "lon_b", radius_km, "gy_b", "gx_b")
    if dense is not None:
        probe = _in_parts(probe, dense, ["snapshot_time", "gy", "gx"],
                          ("part", lambda n: F.pmod(F.xxhash64("icao24_a"), n).cast("int")))
        build = _in_parts(build, dense, ["t_b", "gy_b", "gx_b"], ("part_b", lambda n: F.explode(F.sequence(F.lit(0), n - 1))))
    else:
        probe, build = probe.withColumn("part", F.lit(0)), build.withColumn("part_b", F.lit(0))
    cond = ((probe["snapshot_time"] == build["t_b"]) & (probe["part"] == build["part_b"]) & (probe["gy"] == build["gy_b"])
            & (probe["gx"] == build["gx_b"]) & (probe["icao24_a"] < build["icao24_b"]) & _near(radius_km))
    return probe.join(build.hint("merge"), cond, "inner").select("icao24_a", "icao24_b", "snapshot_time", "snapshot_time_str",
                                                   _rounded_distance(radius_km).alias("dist_km"))


def near_pairs(clean: DataFrame, radius_km: float = NEAR_RADIUS_KM, grain: str = "pair",
               dense: DataFrame | None = None) -> DataFrame:
    """NEAR edges. ``grain="pair"``: one row per pair with the values of its
    latest snapshot; ``grain="observation"``: one row per pair and snapshot."""
    obs = near_observations(clean, radius_km, dense)
    if grain == "observation":
        return obs
    if grain != "pair":
        raise ValueError(f"grain must be 'pair' or 'observation', got {grain!r}")
    # scalar max / max_by: fixed-width buffers, so a hash aggregate with a
    # map-side combine; the time string is re-derived from the latest time
    return (obs.groupBy("icao24_a", "icao24_b")
               .agg(F.max("snapshot_time").alias("snapshot_time"),
                    F.max_by("dist_km", "snapshot_time").alias("dist_km"))
               .select("icao24_a", "icao24_b", "snapshot_time",
                       time_string(F.col("snapshot_time")).alias("snapshot_time_str"), "dist_km"))


MIN_BLOCKS = 16       # of aircraft; more with more shuffle partitions
CANDIDATES = 500_000  # pairs of positions that a task compares at a time
ROUNDS = 3            # in which only the newest open meeting of a pair is looked at
BATCH = 100_000       # rows of merged pairs handed on at a time

_TRACK = ["snapshot_time", "latitude", "longitude", "cell"]
_PAIR = ["icao24_a", "icao24_b", "snapshot_time", "dist_km"]


def _sines(lat1, lon1, cos1, lat2, lon2, cos2) -> np.ndarray:
    """The squared half chord under the root of :func:`haversine_km`."""
    s_phi = np.sin(np.radians(lat2 - lat1) / 2.0)
    s_lam = np.sin(np.radians(lon2 - lon1) / 2.0)
    return s_phi * s_phi + cos1 * cos2 * s_lam * s_lam


def _distance(a: np.ndarray) -> np.ndarray:
    """Kilometres of :func:`_sines`, rounded half up to 2 decimals."""
    scale = 10.0 ** NEAR_DIST_DECIMALS
    return np.floor(EARTH_RADIUS_KM * 2.0 * np.arctan2(np.sqrt(a), np.sqrt(1.0 - a)) * scale + 0.5) / scale


def _latest(pair: np.ndarray, within) -> np.ndarray:
    """Of the places of each ``pair`` (in order of time) the last one that is
    ``within``. Most pairs are settled by their newest meetings."""
    if not len(pair):
        return pair
    if pair.max() >= 8 * len(pair):
        pair = np.unique(pair, return_inverse=True)[1]
    size, left, found = int(pair.max()) + 1, np.arange(len(pair)), []
    for turn in range(ROUNDS + 1):
        if turn == ROUNDS:
            left = left[within(left)]
        last = np.full(size, -1)
        last[pair[left]] = left  # the last one written stays
        newest = last[last >= 0]
        near = within(newest) if turn < ROUNDS else np.ones(len(newest), dtype=bool)
        found.append(newest[near])
        if near.all():
            break
        unsettled = np.zeros(size, dtype=bool)
        unsettled[pair[newest[~near]]] = True
        left = left[unsettled[pair[left]] & (last[pair[left]] != left)]
    return np.concatenate(found)


class _Side:
    """Positions of the tracks of one block."""

    def __init__(self, rows: pa.RecordBatch):
        t, lat, lon, cell = (rows.column(c) for c in _TRACK)
        self.names, self.labels = rows.column("icao24").to_pylist(), rows.column("label") if "label" in rows.schema.names else None
        self.own = np.repeat(np.arange(rows.num_rows), np.diff(t.offsets.to_numpy()))
        self.t, self.lat, self.lon, self.cell = t.flatten().cast(pa.int64()).to_numpy(), *(c.flatten().to_numpy() for c in (lat, lon, cell))

    def arrange(self, order: np.ndarray) -> None:
        self.own, self.t, self.lat, self.lon = (c[order] for c in (self.own, self.t, self.lat, self.lon))
        lat, lon = np.radians(self.lat), np.radians(self.lon)
        self.cos = np.cos(lat)
        self.vector = self.cos * np.cos(lon), self.cos * np.sin(lon), np.sin(lat)


class _Meeting:
    """Positions ``p`` of the probing side and ``q`` of the other."""

    def __init__(self, one: _Side, two: _Side, p: np.ndarray, q: np.ndarray, radius_km: float):
        self.one, self.two, self.p, self.q, self.radius_km = one, two, p, q, radius_km

    def distance(self, at=slice(None)) -> np.ndarray:
        x, y, p, q = self.one, self.two, self.p[at], self.q[at]
        return _distance(_sines(x.lat[p], x.lon[p], x.cos[p], y.lat[q], y.lon[q], y.cos[q]))

    def within(self, at=slice(None)) -> np.ndarray:
        """Whether the rounded distance is at most the radius: by the
        vectors, and about the radius by the distance itself."""
        surely, maybe = _half_chords(self.radius_km)
        p, q = self.p[at], self.q[at]
        a = np.zeros(len(p))
        for u, v in zip(self.one.vector, self.two.vector, strict=True):
            d = u[p] - v[q]
            a += d * d
        a /= 4.0
        near = a < surely
        edge = np.flatnonzero(~near & (a <= maybe))
        near[edge] = self.distance(np.arange(len(self.p))[at][edge]) <= self.radius_km
        return near


def _stored_pairs(files: list) -> pa.Table:
    """The pairs of table files (their bytes), names as dictionaries."""
    tables = [pq.read_table(pa.BufferReader(f.as_buffer()), columns=_PAIR, read_dictionary=_PAIR[:2],
                            coerce_int96_timestamp_unit="us") for f in files]
    tables = [t.set_column(2, _PAIR[2], t[_PAIR[2]].cast(pa.int64())) for t in tables]
    return pa.concat_tables(tables).unify_dictionaries().combine_chunks()


def _newest_of(stored: pa.Table, new: list[tuple], names: list[str]) -> Iterator[tuple]:
    """``new`` rows (rank a, rank b, time, distance) and stored ones, by
    key; of two rows of a pair the newer, without a difference the new one."""
    rank = {name: k for k, name in enumerate(names)}
    key, t, dist = [], [], []
    if stored is not None:
        x, y = (np.array([rank[v] for v in c.dictionary.to_pylist()], dtype=np.int64)[c.indices.to_numpy()]
                for c in (stored[side].chunk(0) for side in _PAIR[:2]))
        key.append(x * len(names) + y)
        t.append(stored[_PAIR[2]].to_numpy())
        dist.append(stored[_PAIR[3]].to_numpy())
    for x, y, time, km in new:
        key.append(x * len(names) + y)
        t.append(time)
        dist.append(km)
    key, t, dist = (np.concatenate(c) if c else np.zeros(0, dtype=np.int64) for c in (key, t, dist))
    order = np.argsort(key, kind="stable")  # stored before new
    same = key[order[1:]] == key[order[:-1]]
    older = t[order[1:]] < t[order[:-1]]
    keep = np.ones(len(order), dtype=bool)
    keep[:-1] &= ~(same & ~older)
    keep[1:] &= ~(same & older)
    order = order[keep]
    for lo in range(0, len(order), BATCH):
        at = order[lo:lo + BATCH]
        yield key[at] // len(names), key[at] % len(names), t[at], dist[at]


def _meet(radius_km: float, grain: str, merged: bool, columns: list[str]):
    """Pairs of the probing tracks (side 0) and the others (side 1) of two
    blocks: the rows of :func:`near_by_blocks`. ``merged``: in order, with the
    stored pairs of these blocks (side 2)."""
    def met(one: _Side, two: _Side, rank_p, rank_q, same_block: bool) -> Iterator[tuple]:
        _, t_all = np.unique(np.concatenate([one.t, two.t]), return_inverse=True)
        cells, cell_all = np.unique(np.concatenate([one.cell, two.cell]), return_inverse=True)
        place = t_all * len(cells) + cell_all
        place_p, place_q = place[:len(one.t)], place[len(one.t):]
        order = np.lexsort((one.t, one.own))  # a track in order of time
        place_p = place_p[order]
        one.arrange(order)
        order = np.argsort(place_q, kind="stable")
        place_q = place_q[order]
        two.arrange(order)
        first = np.searchsorted(place_q, place_p, side="left")
        found = np.searchsorted(place_q, place_p, side="right") - first
        # whole aircraft at a time, so that a pair is in one step
        last_of = np.flatnonzero(np.concatenate([one.own[1:] != one.own[:-1], [True]]))
        done = np.cumsum(found)[last_of]
        lo = seen = 0
        while lo < len(one.own):
            k = max(np.searchsorted(done, seen + CANDIDATES, side="right") - 1, np.searchsorted(last_of, lo))
            base, hi, seen = one.own[lo], int(last_of[k]) + 1, int(done[k])
            n = found[lo:hi]
            p = np.repeat(np.arange(lo, hi), n)
            q = np.arange(len(p)) + np.repeat(first[lo:hi] - (np.cumsum(n) - n), n)
            lo = hi
            if same_block:  # both orders are there
                keep = rank_p[one.own[p]] < rank_q[two.own[q]]
                p, q = p[keep], q[keep]
            meeting = _Meeting(one, two, p, q, radius_km)
            pair = (one.own[p] - base) * len(two.names) + two.own[q]
            with np.errstate(invalid="ignore"):
                if grain == "pair":
                    newest, tallies = _latest(pair, meeting.within), []
                else:
                    near = np.flatnonzero(meeting.within())
                    pair = np.unique(pair[near], return_inverse=True)[1] if pair.size and pair.max() >= 8 * len(pair) else pair[near]
                    last = np.full(int(pair.max()) + 1 if len(pair) else 0, -1)
                    last[pair] = near  # the last one written stays
                    kinds = np.flatnonzero(last >= 0)
                    newest, tallies = last[kinds], [np.bincount(pair)[kinds]]
                    if grain == "tally":
                        tallies.append(np.bincount(pair, meeting.distance(near))[kinds])
            if len(newest):
                yield one.own[p[newest]], two.own[q[newest]], one.t[p[newest]], meeting.distance(newest), tallies

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(list(batches))
        t_type = rows.schema.field(_TRACK[0]).type.value_type
        same_block = rows["i"][0] == rows["j"][0]
        one, two = (_Side(rows.filter(pc.equal(rows["side"], side)).combine_chunks().to_batches()[0]) if n else None
                    for side, n in ((s, pc.sum(pc.equal(rows["side"], s)).as_py()) for s in (0, 1)))
        files = [f for f in rows["content"] if f.is_valid] if "content" in rows.column_names else []
        stored = _stored_pairs(files) if files else None
        names = {*(one.names if one else []), *(two.names if two else [])}
        if stored is not None:
            names.update(*(stored[side].chunk(0).dictionary.to_pylist() for side in _PAIR[:2]))
        names = sorted(names)
        del rows, files
        text = pa.array(names, pa.string())

        def batch(x, y, t, dist, *more) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([text.take(pa.array(x)), text.take(pa.array(y)), pa.array(t).cast(t_type), pa.array(dist),
                                               *more], names=columns)

        new = []
        if one and two and len(one.own) and len(two.own):
            at = {name: k for k, name in enumerate(names)}
            rank_p, rank_q = (np.array([at[name] for name in side.names]) for side in (one, two))
            for own_p, own_q, t, dist, tallies in met(one, two, rank_p, rank_q, same_block):
                x, y = rank_p[own_p], rank_q[own_q]
                if merged:
                    new.append((np.minimum(x, y), np.maximum(x, y), t, dist))
                    continue
                labels = []
                if one.labels is not None:
                    p, q = one.labels.take(pa.array(own_p)), two.labels.take(pa.array(own_q))
                    labels = [pc.if_else(pa.array(x < y), p, q), pc.if_else(pa.array(x < y), q, p)]
                yield batch(np.minimum(x, y), np.maximum(x, y), t, dist, *labels, *map(pa.array, tallies))
        if merged:
            for part in _newest_of(stored, new, names):
                yield batch(*part)
    return run


def blocks_of(spark: SparkSession) -> int:
    """Number of blocks that aircraft are dealt to. A track is sent to one
    group more than there are blocks, so they grow slowly."""
    return max(MIN_BLOCKS, math.ceil(math.sqrt(int(spark.conf.get("spark.sql.shuffle.partitions")))))


def block(icao24: str, blocks: int) -> Column:
    return F.pmod(F.xxhash64(icao24), F.lit(blocks)).cast("int")


def near_by_blocks(clean: DataFrame, radius_km: float = NEAR_RADIUS_KM, tally: bool = False, blocks: int | None = None,
                   sums: bool = True, labels: DataFrame | None = None, stored: DataFrame | None = None,
                   ordered: bool = False) -> DataFrame:
    """One row per pair within ``radius_km`` at some snapshot: time and
    distance of its latest one; with ``tally`` also the number of its
    observations and (unless ``sums`` is false) the sum of their distances.

    Aircraft are dealt to ``blocks`` by a hash of their key; each two blocks
    (and each with itself) are one group, which holds the tracks of both.
    Positions meet by snapshot and grid cell as in :func:`near_observations`,
    a bounded number at a time.

    ``labels`` (icao24, label; one row per aircraft) go along with the tracks
    and come out as ``label_a`` and ``label_b`` of the pair, null without one.

    ``stored`` (i, j, content): files of pairs found before, as they lie in a
    table, of the groups (i, j). They are merged with the new pairs of their
    group, the newest of each pair stays. ``ordered``: the rows of a group
    come in order of their keys (with ``stored`` always)."""
    ship_code()
    blocks = blocks_of(clean.sparkSession) if blocks is None else blocks
    air = airborne_positions(clean).filter("icao24 IS NOT NULL AND snapshot_time IS NOT NULL")
    key = radius_key(F.col("latitude"), F.col("longitude"), radius_km)
    label = ["label"] if labels is not None else []

    def tracks(rows: DataFrame, gy, gx) -> DataFrame:
        at = F.struct("snapshot_time", "latitude", "longitude", (F.shiftleft(gy, 32) + gx).alias("cell"))
        made = rows.groupBy("icao24").agg(F.collect_list(at).alias("track")).select(
            "icao24", *[f"track.{c}" for c in _TRACK], block("icao24", blocks).alias("block"))
        return made if labels is None else made.join(labels.select("icao24", "label"), "icao24", "left")

    probe = tracks(air, key["gy"], key["gx"]).select(
        F.col("block").alias("i"), F.explode(F.sequence(F.col("block"), F.lit(blocks - 1))).alias("j"),
        F.lit(0).alias("side"), "icao24", *_TRACK, *label)
    build = tracks(explode_radius_keys(air, "latitude", "longitude", radius_km), F.col("gy"), F.col("gx")).select(
        F.explode(F.sequence(F.lit(0), F.col("block"))).alias("i"), F.col("block").alias("j"),
        F.lit(1).alias("side"), "icao24", *_TRACK, *label)
    both = probe.unionByName(build)
    if stored is not None:
        both = both.unionByName(stored.select("i", "j", F.lit(2).alias("side"), "content"), allowMissingColumns=True)
    # a group makes many more rows than it reads: tasks are not put together by what they read
    tasks = min(blocks * (blocks + 1) // 2, int(clean.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    time_type = clean.schema["snapshot_time"].dataType.simpleString()
    grain = "pair" if not tally else "tally" if sums else "count"
    columns = {"icao24_a": "string", "icao24_b": "string", "snapshot_time": time_type, "dist_km": "double"}
    if labels is not None:
        columns |= {"label_a": "string", "label_b": "string"}
    if tally:
        columns |= {"observations": "long"} | ({"dist_sum": "double"} if sums else {})
    return both.repartition(tasks, "i", "j").groupBy("i", "j").applyInArrow(
        _meet(radius_km, grain, ordered or stored is not None, list(columns)), ", ".join(f"{c} {kind}" for c, kind in columns.items()))


def near_edges(clean: DataFrame, radius_km: float = NEAR_RADIUS_KM, grain: str = "pair", dense: DataFrame | None = None,
               labels: DataFrame | None = None, **blocks) -> DataFrame:
    """The NEAR edges of a graph: :func:`near_pairs`, at the pair grain by
    blocks; ``grain="tally"`` adds each pair's number of observations and
    the sum of their distances, ``"count"`` the number alone. ``labels`` and
    ``blocks``: see :func:`near_by_blocks`."""
    if grain not in ("pair", "tally", "count"):
        return near_pairs(clean, radius_km, grain, dense)
    more = {"pair": [], "tally": ["observations", "dist_sum"], "count": ["observations"]}[grain]
    more += ["label_a", "label_b"] if labels is not None else []
    return near_by_blocks(clean, radius_km, grain != "pair", sums=grain == "tally", labels=labels, **blocks).select(
        "icao24_a", "icao24_b", "snapshot_time", time_string(F.col("snapshot_time")).alias("snapshot_time_str"),
        "dist_km", *more)
