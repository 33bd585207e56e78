import math

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from contrail.functions.geo import (
    box_cell, box_cells_touched, box_margin_deg, haversine_km, radius_key, radius_keys_reached,
)


def py_hav(lat1, lon1, lat2, lon2):
    r = 6371.0
    p1, p2 = math.radians(lat1), math.radians(lat2)
    dp, dl = math.radians(lat2 - lat1), math.radians(lon2 - lon1)
    a = math.sin(dp / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(dl / 2) ** 2
    return r * 2 * math.atan2(math.sqrt(a), math.sqrt(1 - a))


def test_haversine_matches_python_and_is_null_safe(spark):
    pts = [(51.47, -0.45, 49.0, 2.55), (40.0, 179.9, 40.0, -179.9), (0.0, 0.0, 0.0, 0.0),
           (None, 1.0, 2.0, 3.0)]
    df = spark.createDataFrame(pts, "a double, b double, c double, d double")
    got = [r[0] for r in df.select(haversine_km("a", "b", "c", "d")).collect()]
    for (a, b, c, d), g in zip(pts, got):
        if a is None:
            assert g is None
        else:
            assert abs(g - py_hav(a, b, c, d)) < 1e-9
    r3 = df.select(haversine_km("a", "b", "c", "d", 3)).first()[0]
    assert r3 == round(py_hav(*pts[0]), 3)


pair = st.tuples(st.floats(-89.9, 89.9), st.floats(-180, 180), st.floats(-1, 1), st.floats(-1, 1),
                 st.floats(0.0, 1.0))


@settings(max_examples=40, deadline=None)
@given(st.lists(pair, min_size=1, max_size=30))
def test_radius_grid_covers_every_pair_exactly_once(spark, pts):
    radius = 50.0
    rows = []
    for lat, lon, dy, dx, f in pts:
        # second point at up to ~radius away (scaled direction), wrapped in lon
        lat2 = max(-90.0, min(90.0, lat + dy * 0.45 * f))
        lon2 = lon + dx * 0.45 * f / max(0.05, math.cos(math.radians(lat)))
        lon2 = ((lon2 + 180.0) % 360.0) - 180.0
        rows.append((lat, lon, lat2, lon2))
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    out = df.select(
        haversine_km("a", "b", "c", "d", 2).alias("dist"),
        radius_key("a", "b", radius).alias("k"),
        radius_keys_reached("c", "d", radius).alias("ks"),
    ).collect()
    for r in out:
        if r.dist <= radius:
            assert sum(1 for k in r.ks if k == r.k) == 1, r
        assert len(set(r.ks)) == len(r.ks)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.floats(-80, 80), st.floats(-179, 179), st.floats(-1, 1), st.floats(-1, 1)),
                min_size=1, max_size=30))
def test_box_cells_cover_box(spark, pts):
    m = box_margin_deg(15.0)
    rows = [(a, b, a + dy * m, b + dx * m) for a, b, dy, dx in pts]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    out = df.select(box_cell("a", "b", m).alias("k"), box_cells_touched("c", "d", m).alias("ks"),
                    (F.col("c").between(F.col("a") - m, F.col("a") + m)
                     & F.col("d").between(F.col("b") - m, F.col("b") + m)).alias("inbox")).collect()
    for r in out:
        if r.inbox:
            assert r.k in r.ks
        assert len(r.ks) <= 4
