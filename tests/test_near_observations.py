"""NEAR observations: what is made per pair, and the distances it gives."""
import datetime as dt

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from contrail.functions.geo import haversine_km
from contrail.operators.near import near_observations

T = dt.datetime(2024, 1, 1, 6)
SCHEMA = "icao24 string, snapshot_time timestamp_ntz, latitude double, longitude double, on_ground boolean"


def _cloud(spark, n, spread, seed):
    r = np.random.default_rng(seed)
    at = np.round(r.uniform(-spread, spread, (n, 2)) + [51.0, 179.9], 4)
    at[:, 1] = (at[:, 1] + 180) % 360 - 180
    at[1] = at[0]
    return spark.createDataFrame([(f"a{i:03d}", T + dt.timedelta(hours=6 * (i % 2)), float(la), float(lo), None if i == 9 else False)
                                  for i, (la, lo) in enumerate(at)], SCHEMA)


def test_a_positions_columns_are_made_before_the_pairs(spark):
    plan = near_observations(_cloud(spark, 40, 0.2, 1), 50.0)._jdf.queryExecution().executedPlan().toString()
    top = plan[:plan.index("Join")]
    assert "date_format" not in top and "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    join = plan[plan.index("Join"):].split("\n")[0]
    # names first, and the distance only about the radius
    assert join.index("icao24_a") < join.index("icao24_b") < join.index("ATAN2") and join.count("ATAN2") == 1


@pytest.mark.parametrize("radius,spread", [(0.0, 0.001), (0.3, 0.01), (12.0, 0.1), (50.0, 0.8), (400.0, 4.0)])
def test_rows_equal_the_rounded_haversine_of_every_pair(spark, radius, spread):
    clean = _cloud(spark, 300, spread, int(radius)).cache()
    a = clean.filter("NOT on_ground").toDF("a", "t", "la", "lo", "_1").drop("_1")
    b = clean.filter("NOT on_ground").toDF("b", "u", "lb", "ob", "_2").drop("_2")
    want = (a.join(b, (F.col("t") == F.col("u")) & (F.col("a") < F.col("b")))
            .select("a", "b", "t", F.date_format("t", "yyyy-MM-dd'T'HH:mm:ss'Z'"),
                    haversine_km("la", "lo", "lb", "ob", 2).alias("d")).filter(F.col("d") <= radius))
    got = rows(near_observations(clean, radius))
    assert got == rows(want)
    assert len(got) > (0 if radius == 0 else 300)
