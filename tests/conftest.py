import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from wellspring.session import build_session

    session = build_session(
        app="tests",
        master="local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def table(spark, sf_dir):
    from wellspring import fixtures

    return lambda name: fixtures.table(spark, sf_dir, name)


@pytest.fixture(scope="session")
def duck(sf_dir):
    from wellspring.fixtures import BASE

    connection = duckdb.connect()
    for name in BASE:
        connection.execute(f"create view {name} as from '{sf_dir}/{name}.parquet'")
    return connection


@pytest.fixture
def rows():
    """Rows of a DataFrame as sorted tuples."""

    def collect(df, *columns):
        chosen = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in chosen.collect()), key=repr)

    return collect
