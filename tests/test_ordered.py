"""The ordered stream: late rows, replays after a failure at any step."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows
from contrail.operators.events import detect_flight_events
from contrail.streaming import ordered as O

SCHEMA = "icao24 string, snapshot_time timestamp, on_ground boolean, latitude double, longitude double, ingest_seq long"
HOUR = dt.timedelta(hours=1)


def _row(who, hour, ground, seq=0, lat=1.0):
    return (who, dt.datetime(2024, 1, 1) + hour * HOUR, ground, lat, 2.0, seq)


BATCHES = [
    [_row("a", 0, True), _row("a", 5, False), _row("b", 3, True), _row("c", 1, None), _row(None, 1, True)],
    [_row("a", 2, False), _row("a", 8, True), _row("b", 20, False), _row("a", 8, False, 1)],  # in order behind hour 0; hour 8 twice
    [],
    [_row("a", 7, True), _row("b", 9, True), _row("a", 16, True), _row("d", 30, True)],       # hours 7 and 9 are late
    [_row("d", 29, False), _row("a", 40, False), _row("a", 41, None), _row("a", 42, True, lat=None)],
]
LATE = [("a", 7), ("b", 9)]


def _run(spark, root, batches=BATCHES):
    return [O.take_batch(spark.createDataFrame(b, SCHEMA), i, root, "b", 10 * HOUR) for i, b in enumerate(batches)]


def _want(spark):
    late = {(w, dt.datetime(2024, 1, 1) + h * HOUR) for w, h in LATE}
    flat = {}
    for b in BATCHES:
        for r in b:
            if r[0] and r[:2] not in late and r[2] is not None and r[3] is not None and (r[:2] not in flat or r[5] >= flat[r[:2]][5]):
                flat[r[:2]] = r
    return rows(detect_flight_events(spark.createDataFrame(list(flat.values()), SCHEMA), "b"))


def test_out_of_order_rows_give_the_batch_result_and_late_ones_are_kept(spark, tmp_path):
    root = str(tmp_path)
    marks = _run(spark, root)
    before = O.stream_events(spark, root).count()
    O.drain(spark, root, "b")
    assert rows(O.stream_events(spark, root)) == _want(spark) and before < len(_want(spark))
    assert [(m["rows"], m["late"]) for m in marks] == [(3, 0), (4, 0), (0, 0), (4, 2), (2, 0)]
    late = O.late_rows(spark, root).collect()
    assert sorted((r["icao24"], r["snapshot_time"].hour, r["epoch"]) for r in late) == [(w, h, 3) for w, h in LATE]
    # after the end everything older is late
    again = O.take_batch(spark.createDataFrame([_row("a", 39, True), _row("a", 50, True)], SCHEMA), 5, root, "b", 10 * HOUR)
    assert (again["rows"], again["late"]) == (2, 1)
    assert O.drain(spark, root, "b")["watermark"] is not None
    assert O.stream_events(spark, root).filter(F.col("event_time") == F.lit(dt.datetime(2024, 1, 3, 2))).count() == 1


@pytest.mark.parametrize("step", ["merge_rows", "publish_text"])
def test_a_batch_cut_short_is_repeated(spark, tmp_path, monkeypatch, step):
    root = str(tmp_path)
    for i, b in enumerate(BATCHES):
        df = spark.createDataFrame(b, SCHEMA)
        if i in (1, 3):
            real = getattr(O.V, step)

            def fails(*a, **k):
                if step == "publish_text" and "/marks/" not in a[1]:
                    return real(*a, **k)
                raise OSError("lost")
            monkeypatch.setattr(O.V, step, fails)
            with pytest.raises(OSError):
                O.take_batch(df, i, root, "b", 10 * HOUR)
            monkeypatch.undo()
        O.take_batch(df, i, root, "b", 10 * HOUR)
        assert O.take_batch(df, i, root, "b", 10 * HOUR)["epoch"] == i  # done: nothing happens
    O.drain(spark, root, "b")
    assert rows(O.stream_events(spark, root)) == _want(spark)
    assert O.late_rows(spark, root).count() == len(LATE)


def test_an_empty_stream_has_no_events(spark, tmp_path):
    root = str(tmp_path)
    assert O.take_batch(spark.createDataFrame([], SCHEMA), 0, root, "b")["watermark"] is None
    O.drain(spark, root, "b")
    assert O.stream_events(spark, root).count() == 0 and O.late_rows(spark, root).count() == 0
