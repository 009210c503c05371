import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from quaymark.session import build_session, drop_scratch  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[4]",
        shuffle_partitions=4,
        extra={"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    drop_scratch(session)
    session.stop()


@pytest.fixture(scope="session")
def rows():
    """Rows of a frame as plain dicts, decimals as floats."""
    from decimal import Decimal

    def collect(df):
        return [
            {k: float(v) if isinstance(v, Decimal) else v for k, v in r.asDict().items()} for r in df.collect()
        ]

    return collect
