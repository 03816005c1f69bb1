import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from shelfwise.session import local_session

    session = local_session(4, shuffle_partitions=4, app="tests", **{
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        "spark.driver.memory": "3g",
    })
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """frame(columns, *rows): a text-only DataFrame in the given row order, with row ids."""
    def make(columns, *rows, row_ids=True):
        names = [*columns, "_row_id"] if row_ids else list(columns)
        data = [(*r, i) if row_ids else r for i, r in enumerate(rows)]
        types = [f"`{c}` string" for c in columns] + (["_row_id bigint"] if row_ids else [])
        return spark.createDataFrame(data, ", ".join(types)).select(*[f"`{n}`" for n in names])
    return make
