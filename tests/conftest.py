import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from basinflow.session import get_session

    session = get_session(
        "tests", "local[4]",
        spark__sql__shuffle__partitions="2",
        spark__driver__extraJavaOptions="-XX:TieredStopAtLevel=1",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
        spark__driver__memory="4g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture
def broadcasts(spark):
    """Sets the size up to which Spark broadcasts a side, for one test."""
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = spark.conf.get(names[0])

    def to(limit):
        for name in names:
            spark.conf.set(name, str(limit))

    yield to
    spark.conf.set(names[0], before)
    spark.conf.unset(names[1])
