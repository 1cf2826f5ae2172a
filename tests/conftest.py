import os
import sys
from datetime import datetime, timedelta

import pytest
from pyspark.sql import SparkSession, functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from handbill.config import RunConfig  # noqa: E402
from handbill.schema import EVENT_FIELDS  # noqa: E402
from handbill.session import tuned  # noqa: E402

NOW = datetime(2026, 6, 5, 12, 0)


@pytest.fixture(scope="session")
def spark():
    session = (
        tuned(SparkSession.builder.master("local[4]").appName("tests"))
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def config():
    return RunConfig(NOW)


@pytest.fixture(scope="session")
def make_events(spark):
    """Canonical events from dicts; ``days``/``end_days`` are offsets from the run time."""
    schema = "seq BIGINT, force_category STRING, source_streams ARRAY<STRING>, " + ", ".join(
        f"{name} {dtype.simpleString()}" for name, dtype in EVENT_FIELDS
    )
    defaults = {"source": "trojmiasto", "source_url": "u", "title": "Wydarzenie",
                "national_scope": False, "scope_reason": "", "relevance_score": 0.0}

    def build(rows):
        out = []
        for seq, row in enumerate(rows):
            row = {**defaults, "seq": seq, **row}
            for key, name in (("days", "start_datetime"), ("end_days", "end_datetime")):
                if row.get(key) is not None:
                    row[name] = NOW + timedelta(days=row[key])
            names = [part.split()[0] for part in schema.split(", ")]
            out.append(tuple(row.get(n) for n in names))
        return spark.createDataFrame(out, schema)

    return build


def by_seq(df, column):
    return {r[0]: r[1] for r in df.select("seq", F.col(column)).collect()}
