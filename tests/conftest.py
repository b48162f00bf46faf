import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from dockflow.schemas import EVENT_SCHEMA, EVENT_FIELDS, READING_FIELDS, READING_SCHEMA  # noqa: E402
from dockflow.session import build_session  # noqa: E402
from pyspark.sql import types as T  # noqa: E402
from tables import RECORD, STATE  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    conf = {"spark__sql__shuffle__partitions": "4", "spark__ui__enabled": "false",
            "spark__ui__showConsoleProgress": "false"}
    session = build_session("local[8]", "tests", **conf)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make_readings(spark):
    """DataFrame of readings; each dict overrides fields of the base state."""
    def make(*rows):
        full = [{**STATE, "offset": i, "publish_ts": r.get("ts", STATE["ts"]), **r}
                for i, r in enumerate(rows)]
        names = [*READING_FIELDS, "offset", "publish_ts"]
        return spark.createDataFrame([tuple(r[n] for n in names) for r in full], READING_SCHEMA)

    return make


@pytest.fixture(scope="session")
def make_events(spark):
    """DataFrame of change events with record metadata."""
    def make(*rows):
        full = [{**STATE, "bikes_delta": 0, "offset": i, "publish_ts": r.get("ts", STATE["ts"]), **r}
                for i, r in enumerate(rows)]
        names = [*EVENT_FIELDS, "offset", "publish_ts"]
        return spark.createDataFrame([tuple(r[n] for n in names) for r in full],
                                     T.StructType(list(EVENT_SCHEMA.fields) + RECORD))

    return make
