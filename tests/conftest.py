import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from hourtide.session import build_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        spark__sql__shuffle__partitions=4,
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="4g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("cuts")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


RAW = (
    "seq bigint, holiday string, temp double, rain_1h double, snow_1h double, clouds_all int, "
    "weather_main string, weather_description string, date_time timestamp_ntz, traffic_volume int"
)


@pytest.fixture(scope="session")
def raw(spark):
    """Raw rows from dictionaries with defaults for what a test does not care about."""

    def make(*rows):
        filled = []
        for i, row in enumerate(rows):
            base = {
                "seq": i,
                "holiday": None,
                "temp": 280.0,
                "rain_1h": 0.0,
                "snow_1h": 0.0,
                "clouds_all": 50,
                "weather_main": "Clear",
                "weather_description": "sky",
                "date_time": dt.datetime(2000, 1, 1),
                "traffic_volume": 1000,
            }
            base.update(row)
            filled.append(tuple(base.values()))
        return spark.createDataFrame(filled, RAW)

    return make


@pytest.fixture(scope="session")
def rows():
    """Rows of a frame as sorted tuples."""

    def collect(df, *columns):
        chosen = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in chosen.collect()), key=lambda t: tuple((x is None, str(type(x)), x) for x in t))

    return collect
