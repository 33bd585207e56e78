"""Runs of the batch job one after another, and under another time zone."""
import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF0001, rows
from contrail.operators.match import match_both
from contrail.plans import cycle as C
from contrail.plans.pipeline import read_graph, run_batch, table_layout
from contrail.session import session_conf
from contrail.sinks import tables as S
from contrail.sinks import versions as V
from contrail.sinks.tables import reset_derived, upsert
from contrail.sinks.versions import read_version
from contrail.sources import point_read as P
from contrail.sources.fixtures import airports_from_suppliers, fixture_tables, padded


def _tables(spark, out):
    g = read_graph(spark, out + "/graph")
    found = {name: rows(df) for name, df in g.tables().items()}
    found["flight_events"] = rows(read_version(spark, out + "/flight_events"))
    return found


def test_later_runs_keep_earlier_events_and_repeats_change_nothing(spark, tmp_path):
    raw, airports = fixture_tables(spark, SF0001)
    half = F.lit("2024-01-15").cast("timestamp_ntz")
    out = str(tmp_path / "out")
    run_batch(spark, raw.filter(F.col("snapshot_time") < half), airports, out, batch_id="b")
    first = _tables(spark, out)
    run_batch(spark, raw.filter(F.col("snapshot_time") >= half), airports, out, batch_id="b")
    both = _tables(spark, out)
    for name in ("flight_events", "flight_edge", "snapshot_edge", "snapshot", "country"):
        assert first[name] and set(first[name]) <= set(both[name]), name
    # all days again: adds what spans the halves, and once more changes nothing
    run_batch(spark, raw, airports, out, batch_id="b")
    whole = _tables(spark, out)
    alone = str(tmp_path / "alone")
    run_batch(spark, raw, airports, alone, batch_id="b")
    assert whole == _tables(spark, alone)
    run_batch(spark, raw, airports, out, batch_id="b")
    assert _tables(spark, out) == whole


def test_same_rows_in_another_time_zone(spark, tmp_path):
    raw, airports = fixture_tables(spark, SF0001)
    utc, other = str(tmp_path / "utc"), str(tmp_path / "other")
    run_batch(spark, raw, airports, utc, batch_id="b")
    stamped = raw.withColumn("snapshot_time", F.col("snapshot_time").cast("timestamp"))
    with session_conf(spark, {"spark.sql.session.timeZone": "America/New_York"}):
        run_batch(spark, stamped, airports, other, batch_id="b")
    a, b = read_graph(spark, utc + "/graph"), read_graph(spark, other + "/graph")
    assert rows(a.snapshot) == rows(b.snapshot)
    dates = lambda p: rows(read_version(spark, p + "/flight_events", part_column=True).select("icao24", "event_date"))
    assert dates(utc) == dates(other)


def test_long_keys_keep_their_digits(spark):
    s = spark.createDataFrame([(7, "a", 1, 0.0), (1000, "b", 1, 0.0), (10001, "c", 1, 0.0)],
                              "s_suppkey long, s_name string, s_nationkey int, s_acctbal double")
    n = spark.createDataFrame([(1, "X")], "n_nationkey int, n_name string")
    got = {r["icao_code"] for r in airports_from_suppliers(s, n).collect()}
    assert got == {"A007", "A1000", "A10001"}
    assert spark.range(1).select(padded(F.lit("abcdef1"), 6)).first()[0] == "abcdef1"


def test_repeated_airport_codes_match_alike_in_whole_cells_and_parts(spark):
    ap = spark.createDataFrame([("AAAA", "z", 40.0, 2.0), ("AAAA", "a", 40.0, 2.0), ("BBBB", "b", 40.0, 2.0)],
                               "icao_code string, name string, latitude double, longitude double")
    ev = spark.createDataFrame([("x", dt.datetime(2024, 1, 1), "TAKEOFF", 40.01, 2.0, 60, "b")],
                               "icao24 string, event_time timestamp_ntz, event_type string, latitude double, "
                               "longitude double, gap_seconds int, batch_id string")
    for n in (1, 100):
        both = match_both(ev, ap, cell_airports=n)
        assert sorted((r["airport_icao"], r["airport_name"]) for r in both[0].collect()) == [("AAAA", "a"), ("BBBB", "b")]
        assert [(r["airport_icao"], r["airport_name"]) for r in both[1].collect()] == [("AAAA", "a")]


def test_reset_keeps_the_partition_layout(spark, tmp_path):
    path = str(tmp_path / "t")
    rows_ = spark.createDataFrame([("x", dt.datetime(2024, 1, d), "TAKEOFF") for d in (1, 2)],
                                  "icao24 string, event_time timestamp_ntz, event_type string")
    upsert(rows_, path, ["icao24", "event_time"], "event_time", "event_date")
    schema = spark.read.parquet(path).schema
    reset_derived(spark, {"t": path})
    assert spark.read.parquet(path).count() == 0 and spark.read.parquet(path).schema == schema
    assert not [p for p in (tmp_path / "t").iterdir() if p.suffix == ".parquet"]
    upsert(rows_, path, ["icao24", "event_time"], "event_time", "event_date")
    assert spark.read.parquet(path).count() == 2


def _whole(spark, out):
    found = _tables(spark, out)
    found["matched"] = rows(read_version(spark, out + "/matched_events"))
    return found


def _land(spark, rows_, path, name):
    """Lands state vectors by date, as the ingest stores them."""
    S.append_partitions(rows_.withColumn("ingest_seq", F.lit(name)), path, "snapshot_time", "snapshot_date")


def _days(raw, *days):
    return raw.filter(F.dayofmonth("snapshot_time").isin(*days))


def test_cycles_equal_one_run_however_late_dates_land(spark, tmp_path):
    raw, airports = fixture_tables(spark, SF0001)
    raw = _days(raw, 3, 4, 5, 6, 7, 8, 20).withColumnRenamed("event_id", "ingest_order")
    raw = raw.withColumn("last_contact", F.col("ingest_order"))
    sv, out, alone = (str(tmp_path / x) for x in ("sv", "out", "alone"))
    # the newest first, then a hole is filled, then half a date, then its other half
    parts = [_days(raw, 4, 8, 20), _days(raw, 3, 6), _days(raw, 5).filter("ingest_order % 2 = 0"),
             _days(raw, 5, 7).filter("ingest_order % 2 = 1 OR dayofmonth(snapshot_time) = 7")]
    seen = []
    for i, part in enumerate(parts):
        before = C.files_by_date(spark, sv)
        _land(spark, part.drop("ingest_order"), sv, i)
        dates = sorted(d for d, f in C.files_by_date(spark, sv).items() if before.get(d) != f)
        seen.append(C.recompute_dates(spark, sv, dates, airports, out, batch_id="b"))
    assert [r["dates"] for r in seen][1:] == [["2024-01-03", "2024-01-06"], ["2024-01-05"], ["2024-01-05", "2024-01-07"]]
    assert "2024-01-08" in seen[1]["rewritten"]            # a neighbour's first event
    C.recompute_dates(spark, sv, sorted(C.files_by_date(spark, sv)), airports, alone, batch_id="b")
    got, want = _whole(spark, out), _whole(spark, alone)
    batch = str(tmp_path / "batch")
    run_batch(spark, spark.read.parquet(sv).drop("snapshot_date"), airports, batch, batch_id="b")
    for name, table in _whole(spark, batch).items():
        assert table and got[name] == table == want[name], name


def test_point_reads_open_one_bucket_and_one_date(spark, tmp_path):
    raw, airports = fixture_tables(spark, SF0001)
    raw = _days(raw, 3, 4, 5).withColumn("last_contact", F.col("event_id")).drop("event_id")
    sv, out = str(tmp_path / "sv"), str(tmp_path / "out")
    _land(spark, raw, sv, 0)
    C.recompute_dates(spark, sv, sorted(C.files_by_date(spark, sv)), airports, out, batch_id="b")
    graph = out + "/graph"
    newest = {}
    for r in read_version(spark, graph + "/aircraft").collect():
        newest[r["icao24"]] = r
    keys = sorted(newest)[:3]
    for key in keys:
        one = P.newest_aircraft(spark, graph, f" {key.upper()} ")
        folders = {f.split("/bucket=")[1].split("/")[0] for f in one.inputFiles()}
        assert one.collect() == [newest[key]] and len(folders) == 1
        state = P.newest_state(spark, graph, sv, key)
        want = raw.filter(F.col("icao24") == key).orderBy(F.desc("snapshot_time"), F.desc("last_contact")).first()
        (got,) = state.collect()
        assert (got["snapshot_time"], got["last_contact"]) == (want["snapshot_time"], want["last_contact"])
        assert {f.split("snapshot_date=")[1].split("/")[0] for f in state.inputFiles()} == {str(want["snapshot_time"].date())}
        plan = state._jdf.queryExecution().executedPlan().toString()
        assert f"EqualTo(icao24,{key})" in plan
    assert P.newest_state(spark, graph, sv, "no such").count() == 0
    schema = spark.read.parquet(sv).schema
    assert P.newest_state(spark, graph, sv, keys[0], schema).count() == 1
    S.expire_partitions(spark, sv, "snapshot_date", 1, dt.date(2024, 2, 1))
    assert P.newest_state(spark, graph, sv, keys[0], schema).collect() == []


def test_bucket_of_a_key_is_the_writers(spark):
    for key in ("4b1805", "", "é", "x" * 100):
        want = spark.range(1).select(F.pmod(F.xxhash64(F.lit(key)), F.lit(16))).first()[0]
        assert P.bucket_of(spark, key, 16) == str(want)


def test_a_cycle_scans_changed_dates_only(spark, tmp_path):
    raw, _ = fixture_tables(spark, SF0001)
    sv = str(tmp_path / "sv")
    _land(spark, _days(raw, 3, 4, 5), sv, 0)
    df = C.rows_of_dates(spark, sv, ["2024-01-04"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    pruned = [x for x in plan.split("PartitionFilters: [")[1:]]
    assert len(pruned) == 1 and "snapshot_date" in pruned[0].split("]")[0]
    files = [r[0] for r in df.select(F.input_file_name()).distinct().collect()]
    assert files and all("snapshot_date=2024-01-04" in f for f in files)


def test_run_cycle_skips_quiet_dates_and_compacts_closed_ones_once(spark, tmp_path):
    from contrail.sources.snapshots import snapshots_from_state_vectors
    raw, airports = fixture_tables(spark, SF0001)
    landing, sv, out, ck = (str(tmp_path / x) for x in ("landing", "sv", "out", "ck"))

    def cycle(part):
        if part is not None:
            snapshots_from_state_vectors(part).write.mode("append").json(landing)
        return C.run_cycle(spark, landing, sv, airports, out, ck, retention_days=40, now=dt.datetime(2024, 2, 1), batch_id="b")

    first = cycle(_days(raw, 3, 4))
    second = cycle(_days(raw, 5))
    third = cycle(None)
    assert (first["dates"], second["dates"], third["dates"]) == (["2024-01-03", "2024-01-04"], ["2024-01-05"], [])
    assert first["compacted"] == [] and second["compacted"] == ["2024-01-03", "2024-01-04"] and third["compacted"] == []
    assert len([f for f in os.listdir(sv + "/snapshot_date=2024-01-03") if f.endswith(".parquet")]) == 1
    alone = str(tmp_path / "alone")
    run_batch(spark, spark.read.parquet(sv).drop("snapshot_date"), airports, alone, batch_id="b")
    assert _tables(spark, out) == _tables(spark, alone)


KINDS = ["aircraft", "near", "country", "operates", "flight_events", "snapshot_edge"]


@pytest.mark.parametrize("step", ["rows", "pointer"])
@pytest.mark.parametrize("name", KINDS)
def test_a_failed_write_leaves_the_version_before(spark, tmp_path, monkeypatch, name, step):
    path = str(tmp_path / name)
    keys, layout = table_layout(name)
    cols = [f"{k} string" for k in keys if not k.endswith("_time")] + \
        ([f"{layout.time_col} timestamp_ntz"] if layout.time_col else []) + ["value int"]

    def table(values, times):
        n = len(cols) - 1 - (layout.time_col is not None)
        return spark.createDataFrame([(*[f"k{i}"] * n, *([dt.datetime(2024, 1, 1 + i % 2)] if layout.time_col else []), v)
                                      for i, v in enumerate(values)], ", ".join(cols))
    V.merge_rows(table([1, 2, 3], None), path, keys, layout)
    before = rows(read_version(spark, path))
    bad = table([7, 8, 9, 10], None)
    if step == "rows":
        broken = bad.withColumn("value", F.when(F.col("value") < 9, F.col("value")).otherwise(F.raise_error(F.lit("lost")).cast("int")))
    else:
        broken = bad
        monkeypatch.setattr(V, "publish_text", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    for write in (lambda: V.merge_rows(broken, path, keys, layout),
                  lambda: V.replace_parts(broken, path, keys, layout, list(V.current(spark, path).parts) + [str(i) for i in range(16)])):
        with pytest.raises(Exception, match="lost"):
            write()
        assert rows(read_version(spark, path)) == before and len(before) == 3
    monkeypatch.undo()
    V.merge_rows(bad, path, keys, layout)
    assert sorted(r["value"] for r in read_version(spark, path).collect()) == [7, 8, 9, 10]


def test_a_lost_upsert_is_redone(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")

    def rows_(v):
        return spark.createDataFrame([("x", dt.datetime(2024, 1, d), v) for d in (1, 2)], "icao24 string, snapshot_time timestamp_ntz, value int")
    S.upsert(rows_(1), path, ["icao24", "snapshot_time"], "snapshot_time", "snapshot_date")

    def fails(*a):
        raise OSError("lost")
    for point, left in (("_rewrite", 2), ("delete_path", 3)):  # staged; rewritten and not tidied up
        monkeypatch.setattr(S, point, fails)
        with pytest.raises(OSError):
            S.upsert(rows_(left), path, ["icao24", "snapshot_time"], "snapshot_time", "snapshot_date")
        monkeypatch.undo()
        assert spark.read.parquet(path).count() == 2
        assert S.recover(spark, path, ["icao24", "snapshot_time"], "snapshot_date") == 1
        assert [r["value"] for r in spark.read.parquet(path).collect()] == [left, left]
    assert S.recover(spark, path, ["icao24", "snapshot_time"], "snapshot_date") == 0


def test_newest_wins_whatever_the_order_of_writes(spark, tmp_path):
    path = str(tmp_path / "aircraft")
    keys, layout = table_layout("aircraft")
    order = [F.col("seen_at").desc_nulls_last()]

    def rows_(day, name, n=20):
        return spark.createDataFrame([(f"a{i}", name, dt.datetime(2024, 1, day)) for i in range(n)],
                                     "icao24 string, callsign string, seen_at timestamp_ntz")
    V.merge_rows(rows_(9, "new"), path, keys, layout, order)
    touched = V.merge_rows(rows_(5, "old", 3), path, keys, layout, order)
    assert {r["callsign"] for r in read_version(spark, path).collect()} == {"new"}
    parts = V.current(spark, path).parts
    assert len(touched) <= 3 and {p for p, n in parts.items() if n == 2} == set(touched)  # other buckets stay as they are
    V.merge_rows(rows_(9, "again", 1), path, keys, layout, order)  # at equal times the later write
    assert read_version(spark, path).filter("callsign = 'again'").count() == 1


def test_versions_are_kept_expired_and_reset(spark, tmp_path):
    path = str(tmp_path / "e")
    keys, layout = table_layout("flight_events")

    def rows_(*days):
        return spark.createDataFrame([("x", dt.datetime(2024, 1, d), "LANDING") for d in days],
                                     "icao24 string, event_time timestamp_ntz, event_type string")
    for days in ((1, 2), (2, 3), (4,), (2,)):
        V.merge_rows(rows_(*days), path, keys, layout)
    assert read_version(spark, path).count() == 4 and read_version(spark, path, number=3).count() == 4
    assert sorted(os.listdir(path + "/_versions"))[-1].startswith("0000000004")
    assert not os.path.exists(path + "/version=2/event_date=2024-01-02") or V.current(spark, path).parts["2024-01-02"] == 4
    assert V.expire_parts(spark, path, 30, dt.date(2024, 2, 1)) == ["2024-01-01"]
    with pytest.raises(ValueError):
        V.merge_rows(rows_(1), path, keys, V.bucketed(["icao24"], 4))
    assert reset_derived(spark, {"events": path}) == ["events"]
    assert read_version(spark, path).count() == 0 and read_version(spark, path).columns == ["icao24", "event_time", "event_type"]
    V.merge_rows(rows_(1), path, keys, layout)
    assert read_version(spark, path).count() == 1


def test_a_second_writer_is_refused(spark, tmp_path):
    V.publish_text(spark, str(tmp_path / "p" / "1.json"), "{}")
    with pytest.raises(RuntimeError):
        V.publish_text(spark, str(tmp_path / "p" / "1.json"), "{}")
