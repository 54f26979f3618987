"""Column expressions used by the silver and gold steps.

Every function returns a ``Column`` built from ``pyspark.sql.functions``, so
the whole enrichment stays inside whole-stage code generation. ``on_bad_value``
selects the error behaviour for parsing and casting: ``"fail"`` keeps Spark's
ANSI behaviour (a bad value stops the job), ``"null"`` turns it into null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripflow import schema as S

_BAD_VALUE_MODES = ("fail", "null")


def _check_mode(on_bad_value: str) -> None:
    if on_bad_value not in _BAD_VALUE_MODES:
        raise ValueError(f"on_bad_value must be one of {_BAD_VALUE_MODES}, got {on_bad_value!r}")


def cast_to(c: Column | str, data_type: str, on_bad_value: str = "fail") -> Column:
    """``cast`` (ANSI: raises on bad input) or ``try_cast`` (null)."""
    _check_mode(on_bad_value)
    c = F.col(c) if isinstance(c, str) else c
    return c.cast(data_type) if on_bad_value == "fail" else c.try_cast(data_type)


def parse_ts(c: Column | str, fmt: str = S.TS_FORMAT, on_bad_value: str = "fail") -> Column:
    """Text → timestamp with a strict pattern."""
    _check_mode(on_bad_value)
    c = F.col(c) if isinstance(c, str) else c
    if on_bad_value == "fail":
        return F.to_timestamp(c, fmt)
    return F.try_to_timestamp(c, F.lit(fmt))


def duration_minutes(start: Column | str, end: Column | str) -> Column:
    """Whole-second difference of two timestamps, in minutes, as double."""
    start = F.col(start) if isinstance(start, str) else start
    end = F.col(end) if isinstance(end, str) else end
    return (F.unix_timestamp(end) - F.unix_timestamp(start)).cast("double") / F.lit(60.0)


def tip_pct(tip: Column | str = "tip_amount", fare: Column | str = "fare_amount") -> Column:
    """Tip as a percentage of the fare; 0.0 when the fare is not positive."""
    tip = F.col(tip) if isinstance(tip, str) else tip
    fare = F.col(fare) if isinstance(fare, str) else fare
    return F.when(fare > 0, tip / fare * 100).otherwise(F.lit(0.0))


def flag(cond: Column) -> Column:
    """0/1 integer flag; a null condition gives 0."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def in_hour_ranges(hour: Column | str, ranges=S.RUSH_HOURS) -> Column:
    """1 if the hour falls in any inclusive range, else 0."""
    hour = F.col(hour) if isinstance(hour, str) else hour
    expr = None
    for lo, hi in ranges:
        expr = (F.when(hour.between(lo, hi), F.lit(1))) if expr is None else expr.when(hour.between(lo, hi), F.lit(1))
    return expr.otherwise(F.lit(0))


def guarded_ratio(num: Column | str, den: Column | str) -> Column:
    """num / den, or 0.0 when den is not positive (M1, M4)."""
    num = F.col(num) if isinstance(num, str) else num
    den = F.col(den) if isinstance(den, str) else den
    return F.when(den > 0, num / den).otherwise(F.lit(0.0))


def date_parts(ts: Column | str) -> dict[str, Column]:
    """Calendar parts of the pickup time (E4–E7); day of week 1 = Sunday."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return {
        "pickup_hour": F.hour(ts),
        "pickup_day_of_week": F.dayofweek(ts),
        "pickup_day_of_month": F.dayofmonth(ts),
    }


def partition_parts(ts: Column | str) -> dict[str, Column]:
    ts = F.col(ts) if isinstance(ts, str) else ts
    return {
        "pickup_year": F.year(ts),
        "pickup_month": F.month(ts),
        "pickup_day": F.dayofmonth(ts),
    }


def round_doubles(df, places: int = 6):
    """Round every double column (for comparisons across engines only).

    Tie-safe: the value is first snapped to a decimal with three more
    places, which absorbs summation-order noise of the last bits, and that
    decimal is rounded half away from zero. A plain double ``round`` can go
    either way on an exact tie (432.95 / 32 = 13.5296875), depending on
    whether the summed double lands just below or above it. NaN and
    infinities, which have no decimal form, pass through.
    """
    from pyspark.sql.types import DoubleType

    snap = f"decimal(38,{places + 3})"

    def r(c):
        return F.coalesce(F.round(F.col(c).try_cast(snap), places).cast("double"), F.col(c))

    return df.select(*[r(f.name).alias(f.name) if isinstance(f.dataType, DoubleType) else F.col(f.name) for f in df.schema.fields])
