import os
import sys
import tempfile
import uuid

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[8]")
        .appName("spoolwire-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    if not s.conf.get("spark.checkpoint.dir", None) and not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spoolwire-tests-"))
    yield s


@pytest.fixture()
def tmp(spark):
    """A fresh folder below the shared scratch root."""
    from spoolwire.workspace import scratch_path

    return scratch_path(spark, "test")


@pytest.fixture()
def local_dir():
    """A fresh local folder for hand-written input files."""
    d = os.path.join(tempfile.gettempdir(), "spoolwire-fixtures", uuid.uuid4().hex[:12])
    os.makedirs(d)
    return d


def write_bytes(folder: str, name: str, data) -> str:
    path = os.path.join(folder, name)
    with open(path, "wb") as f:
        f.write(data.encode("utf-8") if isinstance(data, str) else data)
    return path
