import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from planledger.session import build_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("planledger-tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.enabled": "false",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def conf(spark):
    """Set session options for one test."""
    saved = {}

    def put(**options):
        for key, value in options.items():
            name = "spark.sql." + key.replace("__", ".")
            saved.setdefault(name, spark.conf.get(name, None))
            spark.conf.set(name, value)

    yield put
    for name, value in saved.items():
        if value is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, value)


def physical_plan(df, run=False):
    """The physical plan as text; ``run`` executes it first, so AQE has decided."""
    if run:
        df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    return physical_plan(df, run=True).split("== Initial Plan ==")[0]


def values(df, *order):
    return [tuple(row) for row in df.orderBy(*(order or df.columns)).collect()]
