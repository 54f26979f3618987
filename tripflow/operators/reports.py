"""Analyses over silver and gold.

Gold stores averages; re-aggregations here always re-derive ratios from sums
and counts (never average averages). Every report first aggregates, with a
partial aggregate before its shuffle, so hot keys cost one row per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripflow.functions import columns as C


def _rollup(gold: DataFrame, keys: list[str]) -> DataFrame:
    return gold.groupBy(*keys).agg(
        F.sum("total_rides").alias("rides"),
        F.sum("total_fare").alias("fare"),
        F.sum("total_revenue").alias("revenue"),
        F.sum("total_tip").alias("tips"),
        F.sum("sum_trip_distance").alias("distance"),
    )


def map_boroughs(trips: DataFrame, zones: DataFrame, pu: str = "PULocationID", do: str = "DOLocationID") -> DataFrame:
    """Row-level borough mapping: adds pickup/dropoff zone and borough (B1).

    ``zones`` is (zone_id, zone, borough). No hint: Spark broadcasts it while
    its bytes are below the threshold. Left joins keep unmapped trips.
    """
    z = zones.select("zone_id", "zone", "borough")
    pz = z.select(F.col("zone_id").alias("_pz"), F.col("zone").alias("pickup_zone"), F.col("borough").alias("pickup_borough"))
    dz = z.select(F.col("zone_id").alias("_dz"), F.col("zone").alias("dropoff_zone"), F.col("borough").alias("dropoff_borough"))
    out = trips.join(pz, F.col(pu).cast("int") == F.col("_pz"), "left")
    out = out.join(dz, F.col(do).cast("int") == F.col("_dz"), "left")
    return out.drop("_pz", "_dz")


def borough_routes(gold: DataFrame, zones: DataFrame) -> DataFrame:
    """Rides and revenue per route with zone and borough names (B1).

    Aggregates gold to routes first, then maps the (few) routes: the join
    input is the number of routes, not the number of trips.
    """
    routes = gold.groupBy("PULocationID", "DOLocationID").agg(
        F.sum("total_rides").alias("rides"), F.sum("total_revenue").alias("revenue")
    )
    return map_boroughs(routes, zones)


def peak_hours(gold: DataFrame, k: int = 5) -> DataFrame:
    """Top-k pickup hours by rides, ties broken by hour (B2)."""
    agg = _rollup(gold, ["pickup_hour"])
    return agg.orderBy(F.desc("rides"), F.asc("pickup_hour")).limit(k).select(
        "pickup_hour", "rides", "revenue", C.guarded_ratio("revenue", "distance").alias("revenue_per_mile")
    )


def busiest_zones(gold: DataFrame, k: int = 3) -> DataFrame:
    """Pickup zones whose rank by rides is ≤ k, with rank() ties.

    Gold is aggregated to one row per pickup zone. A top-k (each task keeps k
    rows) gives the k largest counts; a count's rank is one more than the
    number of larger ones, all of which are among those k. Zones then join
    the ranks by count: at most k rows are ever ranked in one task, however
    many zones share a count.
    """
    agg = _rollup(gold, ["PULocationID"])
    top = agg.select("rides").orderBy(F.desc("rides")).limit(k)
    ranks = top.select("rides", F.rank().over(Window.orderBy(F.desc("rides"))).alias("rank")).distinct()
    return agg.join(F.broadcast(ranks), "rides").select(  # at most k rows
        "rank",
        "PULocationID",
        "rides",
        "revenue",
        (F.col("revenue") / F.col("rides")).alias("revenue_per_ride"),
    )


def revenue_daily(gold: DataFrame) -> DataFrame:
    """Daily rides, fare, revenue, tips and per-mile / per-ride ratios."""
    agg = _rollup(gold, ["pickup_year", "pickup_month", "pickup_day"])
    return agg.select(
        "pickup_year",
        "pickup_month",
        "pickup_day",
        "rides",
        "fare",
        "revenue",
        "tips",
        (F.col("fare") / F.col("rides")).alias("avg_fare"),
        (F.col("revenue") / F.col("rides")).alias("avg_revenue_per_ride"),
        C.guarded_ratio("revenue", "distance").alias("revenue_per_mile"),
    )


def tip_patterns(silver: DataFrame) -> DataFrame:
    """High-tip share and ride-weighted mean tip % by hour and weekday.

    Computed from silver: gold does not keep the count of non-null tip_pct
    that a correct re-weighting of ``avg_tip_pct`` would need.
    """
    agg = silver.groupBy("pickup_day_of_week", "pickup_hour").agg(
        F.count(F.lit(1)).alias("rides"),
        F.sum("high_tip_flag").cast("bigint").alias("high_tip_rides"),
        F.avg("tip_pct").alias("avg_tip_pct"),
        F.sum("tip_amount").alias("tips"),
    )
    return agg.withColumn("high_tip_share", F.col("high_tip_rides") / F.col("rides"))


def route_heatmap(gold: DataFrame, hours: list[int] | None = None) -> DataFrame:
    """Rides by (pickup zone, dropoff zone), long form.

    With ``hours``, one column of rides per listed hour as well (a pivot with
    fixed values, so no extra job to find them).
    """
    if hours is None:
        agg = _rollup(gold, ["PULocationID", "DOLocationID"])
        return agg.select(
            "PULocationID",
            "DOLocationID",
            "rides",
            "revenue",
            C.guarded_ratio("revenue", "distance").alias("revenue_per_mile"),
        )
    return gold.groupBy("PULocationID", "DOLocationID").pivot("pickup_hour", hours).agg(F.sum("total_rides"))
