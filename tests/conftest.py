from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from clickloom.session import local_session, prepare  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = prepare(local_session(cores="4", memory="4g"))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def samples_folder() -> str:
    return os.environ.get("SAMPLES_DIR", "/root/testdata/sf0.001")


@pytest.fixture
def raw_rows(spark):
    """Builds a raw DataFrame from dictionaries; columns left out get the values of one plain event."""
    from pyspark.sql import functions as F

    from clickloom.schemas import RAW

    plain = {
        "event_time": "2020-01-05 10:20:30",
        "event_type": "view",
        "product_id": 1,
        "category_id": "7",
        "category_code": "nails",
        "brand": "acme",
        "price": 5.0,
        "user_id": 2,
        "user_session": "s1",
    }

    def build(*rows: dict):
        values = [[{**plain, **row}[name] for name in RAW.names] for row in rows]
        text = "event_time string, event_type string, product_id bigint, category_id string, category_code string, "
        text += "brand string, price double, user_id bigint, user_session string"
        frame = spark.createDataFrame(values, text)
        return frame.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in RAW.fields])

    return build
