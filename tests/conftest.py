from __future__ import annotations

import os
import sys

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if REPO not in sys.path:
    sys.path.insert(0, REPO)

from tillandsia.session import build_session  # noqa: E402
from tillandsia.sources.tables import TABLES, table_path  # noqa: E402

TESTDATA = "/root/testdata"
SF_SMALL = f"{TESTDATA}/sf0.001"
SF_ORACLE = f"{TESTDATA}/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "local[*]",
        app_name="tillandsia-tests",
        conf={
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def duckdb_with_views(sf_dir: str):
    """A DuckDB connection with every driver table registered as a view."""
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        path = table_path(sf_dir, name)
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con
