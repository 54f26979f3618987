"""Silver → gold: one row per (date parts, hour, weekday, route).

The plan is scan → project → partial hash aggregate → one hash exchange on the
eight keys → final aggregate → project. All aggregates are algebraic (count,
sum, avg), so the partial aggregate collapses each task's rows to one row per
key before the shuffle: a hot key costs one row per task, not a third of the
table in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow import schema as S
from tripflow.functions import columns as C


def cast_zone_ids(df: DataFrame, on_bad_value: str = "fail") -> DataFrame:
    """Zone ids double → int (P9); null stays null and forms its own group."""
    return df.withColumns({c: C.cast_to(c, "int", on_bad_value) for c in S.ZONE_IDS})


def add_rush_hour(df: DataFrame, hour_col: str = "pickup_hour") -> DataFrame:
    """rush_hour_flag: 1 if the pickup hour is in 7..10 or 16..19."""
    return df.withColumn("rush_hour_flag", C.in_hour_ranges(hour_col))


# Measure -> (trip column, what it is): all are sums, counts, or a sum over the
# count of the column's non-null values.
_SUMS = {"total_fare": "fare_amount", "total_tip": "tip_amount", "total_revenue": "total_amount", "sum_trip_distance": "trip_distance"}
_FLAGS = {"num_high_tip_trips": "high_tip_flag", "num_long_trips": "is_long_trip", "num_short_trips": "is_short_trip", "num_rush_hour_rides": "rush_hour_flag"}
_AVERAGES = {"avg_fare": "fare_amount", "avg_tip_pct": "tip_pct", "avg_trip_distance": "trip_distance", "avg_trip_duration": "trip_duration_minutes"}


def aggregate(df: DataFrame, keys=S.GOLD_KEYS) -> DataFrame:
    """Group by the gold keys with the 13 measures (A1–A5)."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_rides"),
        *[F.sum(c).alias(m) for m, c in _SUMS.items()],
        *[F.avg(c).alias(m) for m, c in _AVERAGES.items()],
        *[F.sum(c).cast("bigint").alias(m) for m, c in _FLAGS.items()],
    )


def partial_aggregate(df: DataFrame, keys=S.GOLD_KEYS) -> DataFrame:
    """The same groups as mergeable parts: sums, counts, and a sum and a
    non-null count per average (``n_*``, ``s_*``)."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_rides"),
        *[F.sum(c).alias(m) for m, c in _SUMS.items()],
        *[F.sum(c).alias(f"s_{m}") for m, c in _AVERAGES.items()],
        *[F.count(c).alias(f"n_{m}") for m, c in _AVERAGES.items()],
        *[F.sum(c).cast("bigint").alias(m) for m, c in _FLAGS.items()],
    )


def combine_partials(parts: DataFrame, keys=S.GOLD_KEYS) -> DataFrame:
    """Parts over disjoint trips → one part over all of them."""
    measures = ["total_rides", *_SUMS, *_FLAGS, *[f"{x}_{m}" for m in _AVERAGES for x in "sn"]]
    return parts.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in measures])


def merge_partials(parts: DataFrame, keys=S.GOLD_KEYS) -> DataFrame:
    """Parts of ``partial_aggregate`` over disjoint trips → what ``aggregate``
    gives over all of them."""
    whole = ["total_rides", *_SUMS, *_FLAGS]
    summed = combine_partials(parts, keys)
    averages = {m: F.when(F.col(f"n_{m}") > 0, F.col(f"s_{m}") / F.col(f"n_{m}")) for m in _AVERAGES}
    return summed.select(*keys, *whole, *[c.alias(m) for m, c in averages.items()])


def add_kpis(agg: DataFrame) -> DataFrame:
    """Derived KPIs over the aggregates, guarded as in the contract (M1–M4)."""
    return agg.withColumns(
        {
            "revenue_per_mile": C.guarded_ratio("total_revenue", "sum_trip_distance"),
            "avg_revenue_per_ride": F.col("total_revenue") / F.col("total_rides"),
            "avg_speed_mph": F.when(
                F.col("avg_trip_duration") > 0, F.col("avg_trip_distance") / (F.col("avg_trip_duration") / 60)
            ).otherwise(F.lit(0.0)),
            "tip_per_mile": C.guarded_ratio("total_tip", "sum_trip_distance"),
        }
    )


def gold_input(silver: DataFrame, on_bad_value: str = "fail") -> DataFrame:
    """The 17 silver columns gold needs, with zone ids as int, and the rush flag."""
    needed = [
        *S.GOLD_KEYS,
        "fare_amount",
        "tip_amount",
        "total_amount",
        "tip_pct",
        "high_tip_flag",
        "trip_distance",
        "trip_duration_minutes",
        "is_long_trip",
        "is_short_trip",
    ]
    return add_rush_hour(cast_zone_ids(silver.select(*needed), on_bad_value))


def finish_gold(agg: DataFrame) -> DataFrame:
    """Aggregates → gold rows (25 columns, see ``schema.GOLD``)."""
    return add_kpis(agg).select(*[F.col(f.name).cast(f.dataType) for f in S.GOLD.fields])


def build_gold(silver: DataFrame, on_bad_value: str = "fail") -> DataFrame:
    """Silver rows → gold rows."""
    return finish_gold(aggregate(gold_input(silver, on_bad_value)))
