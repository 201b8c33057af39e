import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tablewright import build_session  # noqa: E402
from tablewright.workspace import scratch_namespace  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", "local[4]", **{
        "spark.sql.shuffle.partitions": 4,
        "spark.driver.memory": "4g",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.maxMetadataStringLength": 2000,
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def ns(spark):
    return scratch_namespace(spark, "test")


@pytest.fixture
def shuffled(spark, monkeypatch):
    """The way taken when no side is small enough to broadcast."""
    from tablewright.operators import incremental, merge, views

    for module in (merge, incremental, views):
        monkeypatch.setattr(module, "fits_broadcast", lambda *a, **k: False)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def rows(df, *columns):
    """The rows as a sorted list of tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
