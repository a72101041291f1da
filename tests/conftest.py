import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import functions as F

from lamina.functions import exprs as x
from lamina.session import local_session

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8)
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def wkt(spark):
    """Layer from (fid, wkt) rows."""
    def build(*rows):
        return spark.createDataFrame(list(rows), "fid long, t string").select("fid", F.expr(x.from_wkt("t")).alias("geom"))

    return build


def pairs(df):
    return {(r.a_fid, r.b_fid) for r in df.select("a_fid", "b_fid").collect()}
