"""Bronze → silver: cast, clean, enrich.

All steps are narrow projections and filters: Catalyst collapses them into a
single generated-code stage over the scan, and no step shuffles.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from tripflow import schema as S
from tripflow.functions import columns as C

_NAN_POLICIES = ("keep", "null")


def cast_measures(df: DataFrame, columns=S.CAST_MEASURES, on_bad_value: str = "fail") -> DataFrame:
    """Cast measures to double (P8). A no-op, removed by Catalyst, on typed input."""
    return df.withColumns(
        {c: (F.col(c) if isinstance(df.schema[c].dataType, DoubleType) else C.cast_to(c, "double", on_bad_value)) for c in columns}
    )


def nan_to_null(df: DataFrame, policy: str = "keep") -> DataFrame:
    """``policy="null"`` turns NaN doubles and the text "NaN" into null."""
    if policy not in _NAN_POLICIES:
        raise ValueError(f"nan_policy must be one of {_NAN_POLICIES}")
    if policy == "keep":
        return df
    repl = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, DoubleType):
            repl[f.name] = F.when(F.isnan(f.name), F.lit(None).cast("double")).otherwise(F.col(f.name))
        elif f.dataType.simpleString() == "string":
            repl[f.name] = F.when(F.col(f.name).isin("NaN", '"NaN"'), F.lit(None).cast("string")).otherwise(F.col(f.name))
    return df.withColumns(repl)


# --- Fixed values: the six quality rules, in order. -----------------------
def quality_rules() -> dict[str, Column]:
    """Rule name → predicate a clean trip satisfies (F1, F2)."""
    return {
        "passenger_count_positive": F.col("passenger_count") > 0,
        "trip_distance_positive": F.col("trip_distance") > 0,
        "fare_amount_positive": F.col("fare_amount") > 0,
        "total_amount_positive": F.col("total_amount") > 0,
        "pickup_present": F.col(S.PICKUP_TS).isNotNull(),
        "dropoff_present": F.col(S.DROPOFF_TS).isNotNull(),
    }


def clean_predicate(rules: dict[str, Column] | None = None) -> Column:
    """Conjunction of all rules (F3); null counts as failed."""
    rules = rules or quality_rules()
    return reduce(and_, rules.values())


def filter_positive(df: DataFrame) -> DataFrame:
    r = quality_rules()
    return df.filter(reduce(and_, [r[k] for k in list(r)[:4]]))


def filter_required(df: DataFrame) -> DataFrame:
    r = quality_rules()
    return df.filter(r["pickup_present"] & r["dropoff_present"])


def clean(df: DataFrame) -> DataFrame:
    return df.filter(clean_predicate())


def reject_report(df: DataFrame) -> DataFrame:
    """Rows failing each rule, and in total, in one pass: (rule, rejected).

    One global aggregate (partial per task, one row to merge), then the single
    row is unpivoted: no shuffle of trip rows.
    """
    rules = quality_rules()
    aggs = [F.count_if(~F.coalesce(p, F.lit(False))).alias(name) for name, p in rules.items()]
    aggs.append(F.count_if(~F.coalesce(clean_predicate(rules), F.lit(False))).alias("any_rule"))
    aggs.append(F.count(F.lit(1)).alias("rows_in"))
    one = df.agg(*aggs)
    names = list(rules) + ["any_rule", "rows_in"]
    return one.unpivot([], names, "rule", "rejected")


def enrich(df: DataFrame, on_bad_value: str = "fail") -> DataFrame:
    """Parse times, add duration, tip %, calendar parts and flags."""
    parsed = df.withColumns(
        {
            S.PICKUP_TS: C.parse_ts(S.PICKUP_TS, on_bad_value=on_bad_value),
            S.DROPOFF_TS: C.parse_ts(S.DROPOFF_TS, on_bad_value=on_bad_value),
        }
    )
    derived = {
        "trip_duration_minutes": C.duration_minutes(S.PICKUP_TS, S.DROPOFF_TS),
        "tip_pct": C.tip_pct("tip_amount", "fare_amount"),
        **C.date_parts(S.PICKUP_TS),
        "is_long_trip": C.flag(F.col("trip_distance") > S.LONG_TRIP_MILES),
        "is_short_trip": C.flag(F.col("trip_distance") < S.SHORT_TRIP_MILES),
        # high_tip_flag reads tip_pct, so it is computed from the same expression.
        "high_tip_flag": C.flag(C.tip_pct("tip_amount", "fare_amount") > S.HIGH_TIP_PCT),
        **C.partition_parts(S.PICKUP_TS),
    }
    return parsed.select(*[F.col(f.name) for f in S.TRIP.fields], *[derived[f.name].cast(f.dataType).alias(f.name) for f in S.SILVER_DERIVED.fields])


def build_silver(bronze: DataFrame, on_bad_value: str = "fail", nan_policy: str = "keep") -> DataFrame:
    """Bronze (typed or inferred) → silver rows (30 columns, see ``schema.SILVER``)."""
    bronze = bronze.select(*[F.col(f.name) for f in S.TRIP.fields])
    typed = nan_to_null(cast_measures(bronze, on_bad_value=on_bad_value), nan_policy)
    return enrich(clean(typed), on_bad_value=on_bad_value)


def divert_unparsable(bronze: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split bronze rows by whether both datetimes parse (D4, "null" mode).

    Returns (parsable, unparsable); a missing datetime is not unparsable (the
    quality rules deal with it).
    """

    def bad(column: str) -> Column:
        return F.col(column).isNotNull() & C.parse_ts(column, on_bad_value="null").isNull()

    garbled = bad(S.PICKUP_TS) | bad(S.DROPOFF_TS)
    return bronze.filter(~garbled), bronze.filter(garbled)


def split_silver(bronze: DataFrame, nan_policy: str = "keep") -> tuple[DataFrame, DataFrame]:
    """(silver rows, diverted trips) of "null" mode: a clean trip with a datetime
    that does not parse is diverted with its text, not kept with nulls."""
    bronze = bronze.select(*[F.col(f.name) for f in S.TRIP.fields])
    typed = nan_to_null(cast_measures(bronze, on_bad_value="null"), nan_policy)
    good, bad = divert_unparsable(clean(typed))
    return enrich(good, on_bad_value="null"), bad
