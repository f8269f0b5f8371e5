import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tierflow.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("*", memory="8g", shuffle_partitions=2)
    # A handful of rows per test: compiling a class per stage would cost more than running it.
    session.conf.set("spark.sql.codegen.wholeStage", "false")
    session.conf.set("spark.sql.codegen.factoryMode", "NO_CODEGEN")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Build a DataFrame from tuples; NULLs are allowed in every column."""

    def build(schema: str, *data):
        return spark.createDataFrame(list(data), schema)

    return build


def values(df, *cols):
    """All rows as sorted tuples, NULLs last."""
    picked = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: [(v is None, str(v)) for v in r])
