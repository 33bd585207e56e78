"""NEAR pairs merged with stored ones, and counted by country, without a
shuffle of the pairs."""

import datetime as dt

import pytest
from conftest import SF0001, rows
from pyspark.sql import functions as F
from test_near_blocks import T0, plan, tracks

from contrail.operators import near as N
from contrail.plans import pipeline as P
from contrail.plans import queries as Q
from contrail.plans.registry import QUERIES
from contrail.session import session_conf
from contrail.sinks import versions as V
from contrail.sources.fixtures import fixture_tables

KEY = ["icao24_a", "icao24_b", "snapshot_time", "snapshot_time_str", "dist_km"]


def air(spark, *positions):
    """(aircraft, minute, longitude) of aircraft on one latitude."""
    return spark.createDataFrame([(k, T0 + dt.timedelta(minutes=m), False, 50.0, float(x)) for k, m, x in positions],
                                 "icao24 string, snapshot_time timestamp, on_ground boolean, latitude double, longitude double")


def stored(spark, path):
    return rows(V.read_version(spark, path), *KEY)


def test_the_newest_meeting_of_a_pair_stays_whichever_write_saw_it(spark, tmp_path):
    path = str(tmp_path / "near")
    P.write_pairs(air(spark, ("a", 5, 8.0), ("b", 5, 8.1), ("c", 5, 8.2), ("a", 1, 9.0), ("b", 1, 9.2)), path)
    first = stored(spark, path)
    assert [(a, b, t.minute) for a, b, t, *_ in first] == [("a", "b", 5), ("a", "c", 5), ("b", "c", 5)]
    # before, at the same time, after; and aircraft that were not there
    P.write_pairs(air(spark, ("a", 3, 8.0), ("b", 3, 8.3), ("a", 5, 8.0), ("c", 5, 8.4), ("b", 7, 1.0), ("c", 7, 1.1), ("b", 7, 1.2), ("d", 7, 1.3)), path)
    second = {(a, b): (t.minute, km) for a, b, t, _, km in stored(spark, path)}
    want = N.near_pairs(air(spark, ("a", 5, 8.0), ("c", 5, 8.4))).first()["dist_km"]
    assert {k: t for k, (t, _) in second.items()} == {("a", "b"): 5, ("a", "c"): 5, ("b", "c"): 7, ("b", "d"): 7, ("c", "d"): 7}
    assert second["a", "c"][1] == want and second["a", "b"][1] == first[0][-1]
    # nobody in the air: nothing changes
    before = V.current(spark, path).number
    P.write_pairs(air(spark, ("a", 9, 8.0)).filter("false"), path)
    assert V.current(spark, path).number == before


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 0, 1)])
def test_parts_of_the_positions_give_the_pairs_of_all(spark, tmp_path, monkeypatch, order):
    monkeypatch.setattr(N, "CANDIDATES", 50)
    monkeypatch.setattr(N, "BATCH", 7)
    monkeypatch.setattr(V, "FILE_ROWS", 5)  # parts of several files
    clean, path = tracks(spark, 3), str(tmp_path / "near")
    third = F.floor(F.minute("snapshot_time") / 2)
    for k in order:
        P.write_pairs(clean.filter(third == k), path)
    want = N.near_edges(clean)
    assert stored(spark, path) == rows(want, *KEY) and want.count() > 20


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_times_before_1970_and_of_both_kinds_are_read_back(spark, tmp_path, kind):
    path = str(tmp_path / "near")
    for minute in (0, 1):
        P.write_pairs(air(spark, ("a", minute, 8.0), ("b", minute, 8.1)).withColumn(
            "snapshot_time", (F.col("snapshot_time") - F.expr("INTERVAL 60 YEARS")).cast(kind)), path)
    got = V.read_version(spark, path)
    assert got.select(F.col("snapshot_time").cast("string")).first()[0] == "1964-01-01 00:01:00"
    assert dict(got.dtypes)["snapshot_time"] == kind


def test_rows_given_are_merged_with_a_table_made_from_positions(spark, tmp_path):
    path = str(tmp_path / "near")
    clean = tracks(spark, 4)
    early = F.minute("snapshot_time") < 3
    P.write_pairs(clean.filter(early), path)
    keys, layout = P.table_layout("near")
    V.merge_rows(N.near_edges(clean.filter(~early)), path, keys, layout, [F.col("snapshot_time").desc()], unique=True)
    assert stored(spark, path) == rows(N.near_edges(clean), *KEY)
    # a table of before this layout, in buckets of the pair
    old = str(tmp_path / "old")
    V.merge_rows(N.near_edges(clean.filter(early)), old, keys, V.bucketed(keys, 16), unique=True)
    P.write_pairs(clean.filter(~early), old)
    assert stored(spark, old) == stored(spark, path)


def test_batches_shuffle_no_pair(spark, tmp_path, monkeypatch):
    merged, merge = [], P.merge_rows
    monkeypatch.setattr(P, "merge_rows", lambda rows, path, *a, **kw: (merged.append(path.rsplit("/", 1)[1]), merge(rows, path, *a, **kw))[1])
    raw, airports = fixture_tables(spark, SF0001)
    out = str(tmp_path)
    for _ in range(2):
        P.run_batch(spark, raw, airports, out, batch_id="b")
    assert "near" not in merged and "aircraft" in merged
    table = V.current(spark, f"{out}/graph/near")
    files = V.stored_files(spark, f"{out}/graph/near", table, list(table.parts)).select("part", "content")
    assert files.count() == len(table.parts)  # a part comes from one task
    ends = files.select(F.lit(0).alias("i"), F.lit(0).alias("j"), "content")
    p = plan(N.near_edges(P.build_pipeline(raw, airports).clean, blocks=1, stored=ends, ordered=True))
    assert "Exchange" not in p[:p.index("FlatMapGroupsInArrow")]


@pytest.mark.parametrize("grain", ["pair", "count"])
def test_countries_are_counted_without_a_join_of_pairs(spark, pipe001, grain):
    with session_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        p = P.pipeline_from_dir(spark, SF0001, near_grain=grain, near_countries=True)
        got = Q.q5_country_interactions(p.graph)
        text = plan(got)
        assert "Join" not in text[:text.index("FlatMapGroupsInArrow")]
        joined = P.pipeline_from_dir(spark, SF0001, near_grain="pair" if grain == "pair" else "tally")
        assert rows(got) == rows(Q.q5_country_interactions(joined.graph)) and got.count() > 0
    name = "q5_country_interactions" + ("" if grain == "pair" else "_obs")
    registered = plan(QUERIES[name](spark, SF0001))
    assert "Join" not in registered[:registered.index("FlatMapGroupsInArrow")]


def test_labels_stay_with_their_end(spark):
    clean = tracks(spark, 5)
    names = clean.select("icao24").distinct().filter("icao24 IS NOT NULL")
    labels = names.filter("icao24 <> 'a001'").select("icao24", F.concat(F.lit("of "), "icao24").alias("label"))
    got = N.near_edges(clean, labels=labels)
    wrong = got.filter(~(F.col("label_a").eqNullSafe(F.when(F.col("icao24_a") != "a001", F.concat(F.lit("of "), "icao24_a"))))
                       | ~(F.col("label_b").eqNullSafe(F.when(F.col("icao24_b") != "a001", F.concat(F.lit("of "), "icao24_b")))))
    assert wrong.count() == 0 and rows(got, *KEY) == rows(N.near_edges(clean), *KEY)
    assert got.filter("label_a IS NULL OR label_b IS NULL").count() > 0
