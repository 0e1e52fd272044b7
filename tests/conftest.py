import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tarnwork.session import build_session

    session = build_session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "6g", "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def tables(spark):
    from tarnwork.session import Tables

    return Tables(spark, SF)


@pytest.fixture()
def settings(spark):
    """Set session options for one test."""
    touched = []

    def put(**conf):
        for key, value in conf.items():
            spark.conf.set(f"tarnwork.{key}", str(value))
            touched.append(f"tarnwork.{key}")

    yield put
    for key in touched:
        spark.conf.unset(key)


def rows(df, *cols):
    """Collected rows as sorted plain tuples."""
    picked = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in picked.collect()), key=str)
