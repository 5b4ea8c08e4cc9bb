from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from flightlake.contracts import RAW_COLUMNS  # noqa: E402
from flightlake.session import build_session  # noqa: E402

# one sound flight of the 48-column layout, as it would be read from a text file
FLIGHT = dict(
    YEAR="2024", QUARTER="1", MONTH="1", DAY_OF_MONTH="1", DAY_OF_WEEK="1",
    FL_DATE="01/01/2024 12:00:00 AM", OP_UNIQUE_CARRIER="B6", OP_CARRIER_AIRLINE_ID="20409",
    TAIL_NUM="N779JB", OP_CARRIER_FL_NUM="100", ORIGIN_AIRPORT_ID="10721", ORIGIN="BOS",
    ORIGIN_CITY_NAME="Boston, MA", ORIGIN_STATE_ABR="MA", ORIGIN_STATE_NM="Massachusetts",
    DEST_AIRPORT_ID="14747", DEST="SEA", DEST_CITY_NAME="Seattle, WA", DEST_STATE_ABR="WA",
    DEST_STATE_NM="Washington", CRS_DEP_TIME="800", DEP_TIME="805", DEP_DELAY="5",
    DEP_DELAY_NEW="5", DEP_DEL15="0", DEP_TIME_BLK="0800-0859", TAXI_OUT="17", TAXI_IN="6",
    CRS_ARR_TIME="1100", ARR_TIME="1058", ARR_DELAY="-2", ARR_DELAY_NEW="0", ARR_DEL15="0",
    ARR_TIME_BLK="1100-1159", CANCELLED="0", CANCELLATION_CODE=None, DIVERTED="0",
    CRS_ELAPSED_TIME="300", ACTUAL_ELAPSED_TIME="293", AIR_TIME="270", FLIGHTS="1",
    DISTANCE="2496", DISTANCE_GROUP="10", CARRIER_DELAY=None, WEATHER_DELAY=None, NAS_DELAY=None,
    SECURITY_DELAY=None, LATE_AIRCRAFT_DELAY=None,
)
RAW_SCHEMA = ", ".join(f"{c} string" for c in RAW_COLUMNS)


@pytest.fixture(scope="session")
def spark():
    session = build_session("flightlake-tests", 4, **{"spark.sql.shuffle.partitions": "3"})
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def raw(spark):
    """Factory: raw rows from overrides of the sound flight."""

    def make(*overrides: dict):
        rows = [{**FLIGHT, **o} for o in (overrides or ({},))]
        return spark.createDataFrame([tuple(r[c] for c in RAW_COLUMNS) for r in rows], RAW_SCHEMA)

    return make
