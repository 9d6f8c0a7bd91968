import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    ckpt = str(tmp_path_factory.mktemp("checkpoint"))
    s = (SparkSession.builder.master("local[*]")
         .appName("shelfline-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.checkpoint.dir", ckpt)
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    s.sparkContext.setCheckpointDir(ckpt)
    yield s


@pytest.fixture()
def workdir(tmp_path):
    return str(tmp_path)


def rows(df, order=None):
    """Collect as a sorted list of dicts (order-insensitive comparisons)."""
    out = [r.asDict(recursive=True) for r in df.collect()]
    key = order or sorted(df.columns)
    return sorted(out, key=lambda d: tuple((d[k] is None, str(d[k])) for k in key))


def explain(df) -> str:
    """The full formatted physical plan as text."""
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()
