import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bronzeflow.session import local_session, scratch_path  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = local_session(
        8,
        "tests",
        **{
            "spark.driver.memory": "6g",
            "spark.checkpoint.dir": str(folder / "shared"),
            "spark.sql.warehouse.dir": str(folder / "warehouse"),
        },
    )
    yield session
    session.stop()


@pytest.fixture
def target(spark):
    import uuid

    from bronzeflow.config import Target
    from bronzeflow.operators.sinks import ensure_namespace

    t = Target(f"t_{uuid.uuid4().hex}", location=scratch_path(spark, "test"))
    ensure_namespace(spark, t)
    return t
