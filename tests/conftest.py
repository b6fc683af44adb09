import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from commentscope import schemas  # noqa: E402
from commentscope.session import create_session  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = create_session(
        "tests",
        master="local[*]",
        shuffle_partitions=8,
        extra={
            "spark.ui.enabled": "false",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def fixture_comments(spark, sf_dir):
    from commentscope import fixtures

    return fixtures.comments(spark, sf_dir)


@pytest.fixture(scope="session")
def stored_comments(spark, fixture_comments, tmp_path_factory):
    """The fixture comments as Parquet, the form that operators meet in a full run."""
    path = str(tmp_path_factory.mktemp("bronze") / "comments")
    fixture_comments.write.parquet(path)
    return spark.read.schema(schemas.COMMENTS).parquet(path)


@pytest.fixture(scope="session")
def make_comments(spark):
    """Comments from dicts; what a dict leaves out is NULL."""

    def make(rows):
        names = schemas.COMMENTS.fieldNames()
        return spark.createDataFrame(
            [tuple(row.get(name) for name in names) for row in rows], schemas.COMMENTS
        )

    return make
