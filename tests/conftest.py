from __future__ import annotations

import sys
from datetime import datetime
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from contrail import schemas  # noqa: E402
from contrail.session import get_session  # noqa: E402

T0 = datetime(2026, 6, 8, 7, 0)
NOW = datetime(2026, 6, 8, 8, 0)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "2",
            "spark.default.parallelism": "2",
            "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("scratch")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session


def frame(spark, schema, rows):
    """Rows given as dicts; missing fields are NULL."""
    return spark.createDataFrame([tuple(r.get(n) for n in schema.names) for r in rows], schema)


@pytest.fixture
def raw_rows(spark):
    def make(*rows):
        defaults = {"fetched_at": T0, "lat": 17.5, "lon": 78.9, "source_region": "delhi"}
        filled = [
            {**defaults, "ingestion_id": f"id{i:03}", "hex": "abc123", **r}
            for i, r in enumerate(rows)
        ]
        return frame(spark, schemas.RAW_N, filled)

    return make


@pytest.fixture
def raw_l_rows(spark):
    def make(*rows):
        defaults = {
            "hex": "abc123", "lat": 17.5, "lon": 78.9, "alt_baro": "35000", "gs": 450.0,
            "_region": "delhi", "_region_label": "Delhi", "_ingested_at": T0, "_loaded_at": T0,
        }
        return frame(spark, schemas.RAW_L, [{**defaults, **r} for r in rows])

    return make
