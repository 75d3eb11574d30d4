import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from noticemill.session import build_session

    warehouse = tmp_path_factory.mktemp("warehouse")
    session = build_session("local[4]", "tests", **{
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "4g",
        "spark.sql.warehouse.dir": str(warehouse),
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("work")),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def column(df, name):
    return [r[name] for r in df.select(name).collect()]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()
