"""Table contracts for the three layers and the fixed thresholds.

Bronze is the wire record as it arrives; silver is the cleaned, typed and
enriched trip; gold is one row per (date parts, hour, route). The column
lists below are the warehouse contract and must not be renamed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# --- Fixed values: bronze column names and types, in wire order. ----------
TRIP = StructType(
    [
        StructField("VendorID", StringType()),
        StructField("tpep_pickup_datetime", StringType()),
        StructField("tpep_dropoff_datetime", StringType()),
        StructField("passenger_count", DoubleType()),
        StructField("trip_distance", DoubleType()),
        StructField("RatecodeID", DoubleType()),
        StructField("store_and_fwd_flag", StringType()),
        StructField("PULocationID", DoubleType()),
        StructField("DOLocationID", DoubleType()),
        StructField("payment_type", DoubleType()),
        StructField("fare_amount", DoubleType()),
        StructField("extra", DoubleType()),
        StructField("mta_tax", DoubleType()),
        StructField("tip_amount", DoubleType()),
        StructField("tolls_amount", DoubleType()),
        StructField("improvement_surcharge", DoubleType()),
        StructField("total_amount", DoubleType()),
        StructField("congestion_surcharge", DoubleType()),
        StructField("airport_fee", DoubleType()),
    ]
)

PICKUP_TS = "tpep_pickup_datetime"
DROPOFF_TS = "tpep_dropoff_datetime"
# Timestamp text format on the wire.
TS_FORMAT = "yyyy-MM-dd HH:mm:ss"

# Measures that untyped (inferred) bronze may carry as text.
CAST_MEASURES = ["passenger_count", "trip_distance", "fare_amount", "total_amount", "tip_amount"]
ZONE_IDS = ["PULocationID", "DOLocationID"]

# Columns added by the silver enrichment, in order.
# --- Fixed values: columns and types of silver and gold. --------------------
SILVER_DERIVED = StructType(
    [
        StructField("trip_duration_minutes", DoubleType()),
        StructField("tip_pct", DoubleType()),
        StructField("pickup_hour", IntegerType()),
        StructField("pickup_day_of_week", IntegerType()),
        StructField("pickup_day_of_month", IntegerType()),
        StructField("is_long_trip", IntegerType()),
        StructField("is_short_trip", IntegerType()),
        StructField("high_tip_flag", IntegerType()),
        StructField("pickup_year", IntegerType()),
        StructField("pickup_month", IntegerType()),
        StructField("pickup_day", IntegerType()),
    ]
)

SILVER = StructType(
    [
        StructField(f.name, TimestampType()) if f.name in (PICKUP_TS, DROPOFF_TS) else f
        for f in TRIP.fields
    ]
    + SILVER_DERIVED.fields
)

PARTITION_COLS = ["pickup_year", "pickup_month", "pickup_day"]

GOLD_KEYS = [
    "pickup_year",
    "pickup_month",
    "pickup_day",
    "pickup_hour",
    "pickup_day_of_week",
    "pickup_day_of_month",
    "PULocationID",
    "DOLocationID",
]

GOLD = StructType(
    [StructField(k, IntegerType()) for k in GOLD_KEYS]
    + [
        StructField("total_rides", LongType()),
        StructField("total_fare", DoubleType()),
        StructField("total_tip", DoubleType()),
        StructField("total_revenue", DoubleType()),
        StructField("avg_fare", DoubleType()),
        StructField("avg_tip_pct", DoubleType()),
        StructField("num_high_tip_trips", LongType()),
        StructField("avg_trip_distance", DoubleType()),
        StructField("avg_trip_duration", DoubleType()),
        StructField("sum_trip_distance", DoubleType()),
        StructField("num_long_trips", LongType()),
        StructField("num_short_trips", LongType()),
        StructField("num_rush_hour_rides", LongType()),
        StructField("revenue_per_mile", DoubleType()),
        StructField("avg_revenue_per_ride", DoubleType()),
        StructField("avg_speed_mph", DoubleType()),
        StructField("tip_per_mile", DoubleType()),
    ]
)

# Warehouse column types for the gold table (JDBC ``createTableColumnTypes``,
# Spark type names; the JDBC dialect maps DOUBLE to e.g. DOUBLE PRECISION).
GOLD_DDL = ", ".join(f"{f.name} {f.dataType.simpleString().upper()}" for f in GOLD.fields)

# --- Fixed values: thresholds (strict unless stated). ----------------------
LONG_TRIP_MILES = 20  # is_long_trip: distance > 20
SHORT_TRIP_MILES = 1  # is_short_trip: distance < 1
HIGH_TIP_PCT = 20  # high_tip_flag: tip_pct > 20
# Rush hours, inclusive ranges of the pickup hour: 7..10 and 16..19.
RUSH_HOURS = ((7, 10), (16, 19))


def check_contract(df: DataFrame, contract: StructType) -> DataFrame:
    """Compare a table with a contract (L7): one row per column of either.

    (position in the contract or null, column_name, expected_type,
    actual_type, n_nulls, ok). Nulls of all columns are counted in one pass,
    one row per task before the merge.
    """
    found, expected = dict(df.dtypes), {f.name: f.dataType.simpleString() for f in contract.fields}
    names = [*expected, *[c for c in found if c not in expected]]
    counts = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in found])
    places = list(expected)
    rows = [
        F.struct(
            F.lit(places.index(c) if c in expected else None).cast("int").alias("position"),
            F.lit(c).alias("column_name"),
            F.lit(expected.get(c)).cast("string").alias("expected_type"),
            F.lit(found.get(c)).cast("string").alias("actual_type"),
            (F.col(f"`{c}`") if c in found else F.lit(None).cast("bigint")).alias("n_nulls"),
            F.lit(expected.get(c) == found.get(c)).alias("ok"),
        )
        for c in names
    ]
    return counts.select(F.inline(F.array(*rows)))
