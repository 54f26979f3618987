"""Trip records derived from the driver's ``events`` table.

The test data holds no taxi trips, so bronze-shaped trips are derived, one
per event, by pure column arithmetic (no filter, no join, no shuffle): the
derivation is a projection over the Parquet scan and stays map-only at any
scale. The same rules are written as SQL for the DuckDB oracle
(``tripflow.plans.oracle.TRIPS``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow import schema as S


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_events(spark: SparkSession, sf_dir: str, with_position: bool = False) -> DataFrame:
    df = spark.read.parquet(table_path(sf_dir, "events"))
    if with_position:
        # File name + row index inside the file: the row's place in file order.
        df = df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    return df


# --- Fixed values: the derivation rules of FIXTURES §2, as SQL expressions. --
_BASE_EXPRS = [
    "CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS _k",
    "CAST(FLOOR(value * 30) AS BIGINT) + 250 AS _fare_c",
]
_TIP_EXPR = "CAST(FLOOR(CAST(_fare_c * ((event_id * 13) % 35) AS DOUBLE) / 100) AS BIGINT) AS _tip_c"
_TS = "'yyyy-MM-dd HH:mm:ss'"
_TRIP_EXPRS = {
    "VendorID": "CAST(1 + event_id % 2 AS STRING)",
    "tpep_pickup_datetime": f"date_format(ts, {_TS})",
    "tpep_dropoff_datetime": f"CASE WHEN event_id % 97 = 0 THEN NULL ELSE date_format(timestampadd(SECOND, 60 + event_id * 37 % 5400, ts), {_TS}) END",
    "passenger_count": "CASE WHEN _k % 11 = 0 THEN NULL ELSE CAST(_k % 7 AS DOUBLE) END",
    "trip_distance": "value / 10.0D",
    "RatecodeID": "1.0D",
    "store_and_fwd_flag": "CASE WHEN event_type = 'error' THEN 'Y' ELSE 'N' END",
    "PULocationID": "CAST(1 + user_id % 4 AS DOUBLE)",
    "DOLocationID": "CAST(1 + (user_id + event_id) % 3 AS DOUBLE)",
    "payment_type": "CAST(1 + event_id % 4 AS DOUBLE)",
    "fare_amount": "CAST(CASE WHEN event_id % 50 = 0 THEN -_fare_c ELSE _fare_c END AS DOUBLE) / 100.0D",
    "extra": "0.5D",
    "mta_tax": "0.5D",
    "tip_amount": "CAST(_tip_c AS DOUBLE) / 100.0D",
    "tolls_amount": "0.0D",
    "improvement_surcharge": "1.0D",
    "total_amount": "CAST(_fare_c + _tip_c + 450 AS DOUBLE) / 100.0D",
    "congestion_surcharge": "2.5D",
    "airport_fee": "CASE WHEN event_id % 13 = 0 THEN NULL ELSE 0.0D END",
}


def trips_from_events(events: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One bronze trip per event; ``keep`` carries extra event columns along.

    Written as SQL expressions: three projections, each sent to the JVM in
    one call, which Catalyst collapses into the scan's generated code.
    """
    base = events.selectExpr(*keep, "event_id", "ts", "user_id", "event_type", "value", *_BASE_EXPRS)
    return base.selectExpr("*", _TIP_EXPR).selectExpr(*keep, *[f"CAST({_TRIP_EXPRS[f.name]} AS {f.dataType.simpleString()}) AS {f.name}" for f in S.TRIP.fields])


def read_trips(spark: SparkSession, sf_dir: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Bronze-shaped trips over ``events`` at ``sf_dir``."""
    events = read_events(spark, sf_dir, with_position=any(c in ("_file", "_row") for c in keep))
    return trips_from_events(events, keep=keep)


def read_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone dimension: zone id, zone name and borough (nation ⋈ region)."""
    nation = spark.read.parquet(table_path(sf_dir, "nation")).select("n_nationkey", "n_name", "n_regionkey")
    region = spark.read.parquet(table_path(sf_dir, "region")).select("r_regionkey", "r_name")
    return nation.join(region, nation.n_regionkey == region.r_regionkey, "left").select(
        F.col("n_nationkey").cast("int").alias("zone_id"),
        F.col("n_name").alias("zone"),
        F.col("r_name").alias("borough"),
    )
