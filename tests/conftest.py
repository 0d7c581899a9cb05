import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from statcube.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, shuffle_partitions=4)
    yield session
    session.stop()


def of_provider(df, provider="P"):
    """Rows of one provider."""
    return df.select(F.lit(provider).alias("provider"), *df.columns)


@pytest.fixture(scope="session")
def rows():
    """Rows of a DataFrame as sorted tuples."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=lambda t: [(v is not None, str(v)) for v in t])

    return collect
