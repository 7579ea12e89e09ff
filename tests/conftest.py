import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tillmetrics.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    folder = tempfile.mkdtemp(prefix="tillmetrics-tests-")
    session = local_session(
        4, 4, **{"spark.checkpoint.dir": folder, "spark.sql.warehouse.dir": f"{folder}/warehouse"}
    )
    yield session


@pytest.fixture
def rows(spark):
    """Collected rows as sorted tuples."""

    def collect(df, *columns):
        chosen = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in chosen.collect()), key=repr)

    return collect
