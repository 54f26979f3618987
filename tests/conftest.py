import json
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tripflow.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = local_session(cores="*", shuffle_partitions=8, app="tripflow-tests")
    yield s
    s.stop()


# Trip A of FIXTURES §4, the base record of the edge cases.
BASE = {
    "VendorID": "1",
    "tpep_pickup_datetime": "2024-01-01 08:00:00",
    "tpep_dropoff_datetime": "2024-01-01 08:30:00",
    "passenger_count": 1.0,
    "trip_distance": 10.0,
    "RatecodeID": 1.0,
    "store_and_fwd_flag": "N",
    "PULocationID": 1.0,
    "DOLocationID": 2.0,
    "payment_type": 1.0,
    "fare_amount": 20.0,
    "extra": 0.5,
    "mta_tax": 0.5,
    "tip_amount": 5.0,
    "tolls_amount": 0.0,
    "improvement_surcharge": 1.0,
    "total_amount": 30.0,
    "congestion_surcharge": 2.5,
    "airport_fee": 0.0,
}


def trip(**changes):
    rec = dict(BASE)
    for k, v in changes.items():
        if v is ...:
            rec.pop(k, None)
        else:
            rec[k] = v
    return rec


def payloads(spark, texts):
    """A DataFrame with a binary ``value`` column from JSON texts (None → null)."""
    from pyspark.sql.types import BinaryType, StructField, StructType

    rows = [(None if t is None else (t if isinstance(t, str) else json.dumps(t)).encode("utf-8"),) for t in texts]
    return spark.createDataFrame(rows, StructType([StructField("value", BinaryType())]))
