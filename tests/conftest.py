import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from taxaloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, memory="6g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def frame(spark):
    def build(rows, schema):
        return spark.createDataFrame(rows, schema)

    return build


def physical(df) -> str:
    """The physical plan as text."""
    return df._jdf.queryExecution().executedPlan().toString()


def unscalable(df) -> list[str]:
    """Operators that no plan of this library may hold."""
    plan = physical(df)
    banned = ["BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython"]
    return [name for name in banned if name in plan]
