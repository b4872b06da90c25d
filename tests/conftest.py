import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from tools.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session("4", partitions=3)


@pytest.fixture
def tickets(spark):
    """Rows of the tickets table from (row_id, version, text, category, summary, date) tuples."""
    from qualitygate import TICKETS

    def make(rows):
        text = ", ".join(f"{c} string" for c in TICKETS.columns)
        return spark.createDataFrame(rows, text)

    return make


def rows(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


@pytest.fixture
def many_partitions(spark):
    """Keep tiny shuffle partitions apart, so that rows really lie in several."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    yield
    spark.conf.unset(name)
