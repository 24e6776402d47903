from __future__ import annotations

import sys
from datetime import date
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tellerframe.config import Rules  # noqa: E402
from tellerframe.session import build_session  # noqa: E402
from tellerframe.sources.storage import release  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    release(session)
    session.stop()


@pytest.fixture
def rules():
    return Rules(as_of=date(2024, 6, 30), run_at="2024-06-30T00:00:00")


@pytest.fixture
def rows():
    """Collected rows as plain tuples, in a stable order."""

    def collected(df, *columns):
        chosen = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in chosen.collect()), key=lambda r: [(v is not None, v) for v in r])

    return collected
