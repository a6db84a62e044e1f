import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from civicmart.session import fresh_path, get_session  # noqa: E402
from civicmart.sources.raw import RAW_COLUMNS, RAW_SCHEMA  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = get_session(
        "tests", "local[8]", spark__sql__shuffle__partitions=4, spark__driver__memory="6g",
        spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="run-", dir="/tmp"),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


GOOD = {
    "unique_key": "1",
    "created_date": "2024-05-20T07:14:00.000",
    "closed_date": "2024-05-24T09:00:00.000",
    "agency": "NYPD",
    "agency_name": "Police Dept",
    "complaint_type": "Noise - Residential",
    "descriptor": "Banging/Pounding",
    "location_type": "Commercial",
    "incident_zip": "11201",
    "incident_address": "1 MAIN ST",
    "city": "BROOKLYN",
    "borough": "BROOKLYN",
    "latitude": "40.694907",
    "longitude": "-73.989646",
    "status": "Closed",
    "resolution_description": "Done",
    "community_board": "02 BROOKLYN",
}


@pytest.fixture
def requests_of(spark):
    """Request rows from per-row changes to one good row."""

    def build(*changes: dict):
        rows = [tuple({**GOOD, **change}[n] for n in RAW_COLUMNS) for change in changes]
        return spark.createDataFrame(rows, RAW_SCHEMA)

    return build


@pytest.fixture
def folder(spark):
    return fresh_path(spark, "test")


def column(df, *names):
    rows = df.select(*names).collect()
    return [r[0] for r in rows] if len(names) == 1 else [tuple(r) for r in rows]
