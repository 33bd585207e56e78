import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from contrail.session import local_session
    s = local_session("*", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def pipe001(spark):
    from contrail.plans.pipeline import pipeline_from_dir
    return pipeline_from_dir(spark, SF001)


@pytest.fixture(scope="session")
def pipe0001(spark):
    from contrail.plans.pipeline import pipeline_from_dir
    return pipeline_from_dir(spark, SF0001)


def rows(df, *cols):
    """Sorted list of tuples (optionally of selected columns)."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=lambda t: tuple((x is None, str(x)) for x in t))
