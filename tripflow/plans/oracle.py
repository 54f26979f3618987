"""Independent DuckDB SQL for the correctness gate.

Each query in ``tripflow.plans.catalog`` has an equivalent here, written from
the definitions (not from the Spark code): DuckDB runs it on the same Parquet
tables, pre-registered as views. Doubles are rounded to 6 places on both
sides, as sums of doubles depend on order. DuckDB returns BIGINT for calendar
parts and HUGEINT for sums of integers, so both are cast to the Spark types.
"""

from __future__ import annotations

from tripflow import schema as S

# Trips over events: the rules of FIXTURES §2, verbatim.
TRIPS = """
trips_e AS (
  SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k,
         CAST(FLOOR(value * 30) AS BIGINT) + 250 AS fare_c
  FROM events),
trips_f AS (SELECT *, CAST(FLOOR(CAST(fare_c * ((event_id * 13) % 35) AS DOUBLE) / 100) AS BIGINT) AS tip_c FROM trips_e),
trips AS (
SELECT
  event_id,
  CAST(1 + event_id % 2 AS VARCHAR) AS VendorID,
  CAST(date_trunc('second', ts) AS VARCHAR) AS tpep_pickup_datetime,
  CASE WHEN event_id % 97 = 0 THEN NULL ELSE
    CAST(date_trunc('second', ts) + (60 + event_id * 37 % 5400) * INTERVAL '1' SECOND AS VARCHAR)
  END AS tpep_dropoff_datetime,
  CASE WHEN k % 11 = 0 THEN NULL ELSE CAST(k % 7 AS DOUBLE) END AS passenger_count,
  value / CAST(10 AS DOUBLE) AS trip_distance,
  CAST(1 AS DOUBLE) AS RatecodeID,
  CASE WHEN event_type = 'error' THEN 'Y' ELSE 'N' END AS store_and_fwd_flag,
  CAST(1 + user_id % 4 AS DOUBLE) AS PULocationID,
  CAST(1 + (user_id + event_id) % 3 AS DOUBLE) AS DOLocationID,
  CAST(1 + event_id % 4 AS DOUBLE) AS payment_type,
  CAST(CASE WHEN event_id % 50 = 0 THEN -fare_c ELSE fare_c END AS DOUBLE) / CAST(100 AS DOUBLE) AS fare_amount,
  CAST(0.5 AS DOUBLE) AS extra,
  CAST(0.5 AS DOUBLE) AS mta_tax,
  CAST(tip_c AS DOUBLE) / CAST(100 AS DOUBLE) AS tip_amount,
  CAST(0 AS DOUBLE) AS tolls_amount,
  CAST(1 AS DOUBLE) AS improvement_surcharge,
  CAST(fare_c + tip_c + 450 AS DOUBLE) / CAST(100 AS DOUBLE) AS total_amount,
  CAST(2.5 AS DOUBLE) AS congestion_surcharge,
  CASE WHEN event_id % 13 = 0 THEN NULL ELSE CAST(0 AS DOUBLE) END AS airport_fee
FROM trips_f)"""

TRIP_COLS = ", ".join(f.name for f in S.TRIP.fields)

CLEAN_WHERE = """passenger_count > 0 AND trip_distance > 0 AND fare_amount > 0 AND total_amount > 0
  AND tpep_pickup_datetime IS NOT NULL AND tpep_dropoff_datetime IS NOT NULL"""

SILVER = f"""
silver_p AS (
  SELECT * REPLACE (
    strptime(tpep_pickup_datetime, '%Y-%m-%d %H:%M:%S') AS tpep_pickup_datetime,
    strptime(tpep_dropoff_datetime, '%Y-%m-%d %H:%M:%S') AS tpep_dropoff_datetime)
  FROM trips WHERE {CLEAN_WHERE}),
silver_x AS (
  SELECT event_id, {TRIP_COLS},
    CAST(epoch(tpep_dropoff_datetime) - epoch(tpep_pickup_datetime) AS DOUBLE) / 60 AS trip_duration_minutes,
    CASE WHEN fare_amount > 0 THEN tip_amount / fare_amount * 100 ELSE 0.0 END AS tip_pct,
    CAST(hour(tpep_pickup_datetime) AS INTEGER) AS pickup_hour,
    CAST(dayofweek(tpep_pickup_datetime) + 1 AS INTEGER) AS pickup_day_of_week,
    CAST(day(tpep_pickup_datetime) AS INTEGER) AS pickup_day_of_month,
    CAST(CASE WHEN trip_distance > 20 THEN 1 ELSE 0 END AS INTEGER) AS is_long_trip,
    CAST(CASE WHEN trip_distance < 1 THEN 1 ELSE 0 END AS INTEGER) AS is_short_trip,
    CAST(year(tpep_pickup_datetime) AS INTEGER) AS pickup_year,
    CAST(month(tpep_pickup_datetime) AS INTEGER) AS pickup_month,
    CAST(day(tpep_pickup_datetime) AS INTEGER) AS pickup_day
  FROM silver_p),
silver AS (
  SELECT event_id, {TRIP_COLS}, trip_duration_minutes, tip_pct, pickup_hour, pickup_day_of_week,
    pickup_day_of_month, is_long_trip, is_short_trip,
    CAST(CASE WHEN tip_pct > 20 THEN 1 ELSE 0 END AS INTEGER) AS high_tip_flag,
    pickup_year, pickup_month, pickup_day
  FROM silver_x)"""

SILVER_COLS = ", ".join(f.name for f in S.SILVER.fields)

GOLD = """
gold_in AS (
  SELECT *, CAST(TRUNC(PULocationID) AS INTEGER) AS pu, CAST(TRUNC(DOLocationID) AS INTEGER) AS dz,
    CASE WHEN pickup_hour BETWEEN 7 AND 10 THEN 1 WHEN pickup_hour BETWEEN 16 AND 19 THEN 1 ELSE 0 END AS rush_hour_flag
  FROM silver),
gold_a AS (
  SELECT pickup_year, pickup_month, pickup_day, pickup_hour, pickup_day_of_week, pickup_day_of_month,
    pu AS PULocationID, dz AS DOLocationID,
    COUNT(*) AS total_rides,
    SUM(fare_amount) AS total_fare,
    SUM(tip_amount) AS total_tip,
    SUM(total_amount) AS total_revenue,
    AVG(fare_amount) AS avg_fare,
    AVG(tip_pct) AS avg_tip_pct,
    CAST(SUM(high_tip_flag) AS BIGINT) AS num_high_tip_trips,
    AVG(trip_distance) AS avg_trip_distance,
    AVG(trip_duration_minutes) AS avg_trip_duration,
    SUM(trip_distance) AS sum_trip_distance,
    CAST(SUM(is_long_trip) AS BIGINT) AS num_long_trips,
    CAST(SUM(is_short_trip) AS BIGINT) AS num_short_trips,
    CAST(SUM(rush_hour_flag) AS BIGINT) AS num_rush_hour_rides
  FROM gold_in
  GROUP BY pickup_year, pickup_month, pickup_day, pickup_hour, pickup_day_of_week, pickup_day_of_month, pu, dz),
gold AS (
  SELECT *,
    CASE WHEN sum_trip_distance > 0 THEN total_revenue / sum_trip_distance ELSE 0.0 END AS revenue_per_mile,
    total_revenue / total_rides AS avg_revenue_per_ride,
    CASE WHEN avg_trip_duration > 0 THEN avg_trip_distance / (avg_trip_duration / 60) ELSE 0.0 END AS avg_speed_mph,
    CASE WHEN sum_trip_distance > 0 THEN total_tip / sum_trip_distance ELSE 0.0 END AS tip_per_mile
  FROM gold_a)"""

GOLD_COLS = [f.name for f in S.GOLD.fields]
GOLD_DOUBLES = {f.name for f in S.GOLD.fields if f.dataType.simpleString() == "double"}
SILVER_DOUBLES = {f.name for f in S.SILVER.fields if f.dataType.simpleString() == "double"}
TRIP_DOUBLES = {f.name for f in S.TRIP.fields if f.dataType.simpleString() == "double"}


def with_ctes(body: str, *ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n" + body


def r6(cols, doubles) -> str:
    """Select list with doubles rounded to 6 places."""
    return ", ".join(f"round({c}, 6) AS {c}" if c in doubles else c for c in cols)


def on_trips(body: str) -> str:
    return with_ctes(body, TRIPS)


def on_silver(body: str) -> str:
    return with_ctes(body, TRIPS, SILVER)


def on_gold(body: str) -> str:
    return with_ctes(body, TRIPS, SILVER, GOLD)


def _trips_r6(where: str = "", order_limit: str = "") -> str:
    return on_trips(f"SELECT {r6(S.TRIP.names, TRIP_DOUBLES)} FROM trips {where} {order_limit}")


def _gold_r6(cols=None, where: str = "", tail: str = "") -> str:
    cols = cols or GOLD_COLS
    return on_gold(f"SELECT {r6(cols, GOLD_DOUBLES)} FROM gold {where} {tail}")


def _silver_r6(cols=None, where: str = "") -> str:
    cols = cols or S.SILVER.names
    return on_silver(f"SELECT {r6(cols, SILVER_DOUBLES)} FROM silver {where}")


ZONES = """
zones AS (
  SELECT CAST(n_nationkey AS INTEGER) AS zone_id, n_name AS zone, r_name AS borough
  FROM nation LEFT JOIN region ON n_regionkey = r_regionkey)"""

REJECT_RULES = [
    ("passenger_count_positive", "passenger_count > 0"),
    ("trip_distance_positive", "trip_distance > 0"),
    ("fare_amount_positive", "fare_amount > 0"),
    ("total_amount_positive", "total_amount > 0"),
    ("pickup_present", "tpep_pickup_datetime IS NOT NULL"),
    ("dropoff_present", "tpep_dropoff_datetime IS NOT NULL"),
]


def _reject_report() -> str:
    counts = ",\n    ".join(f"CAST(count_if(NOT coalesce({p}, false)) AS BIGINT) AS {n}" for n, p in REJECT_RULES)
    all_ok = " AND ".join(f"coalesce({p}, false)" for _, p in REJECT_RULES)
    rr = f"rr AS (SELECT {counts},\n    CAST(count_if(NOT ({all_ok})) AS BIGINT) AS any_rule,\n    CAST(count(*) AS BIGINT) AS rows_in FROM trips)"
    names = [n for n, _ in REJECT_RULES] + ["any_rule", "rows_in"]
    body = "\nUNION ALL ".join(f"SELECT '{n}' AS rule, {n} AS rejected FROM rr" for n in names)
    return with_ctes(body, TRIPS, rr)


def _profile() -> str:
    parts = []
    for c in ["trip_distance", "fare_amount", "trip_duration_minutes", "tip_pct"]:
        parts.append(
            f"SELECT '{c}' AS column_name, count({c}) AS n_values, round(avg({c}), 6) AS mean, "
            f"round(stddev_samp({c}), 6) AS stddev, round(min({c}), 6) AS min_value, round(max({c}), 6) AS max_value FROM silver"
        )
    return on_silver("\nUNION ALL ".join(parts))


def _profile_range() -> str:
    """The profile of the range's trips; the stored estimates are to be close to the exact values."""
    from tripflow.plans import catalog as K

    (y, m, a), (_, _, b) = K.PROFILE_RANGE
    parts = []
    for c in ["trip_distance", "fare_amount", "trip_duration_minutes", "tip_pct"]:
        parts.append(
            f"SELECT '{c}' AS column_name, count({c}) AS n_values, round(avg({c}), 6) AS mean, "
            f"round(stddev_samp({c}), 6) AS stddev, round(min({c}), 6) AS min_value, round(max({c}), 6) AS max_value, "
            f"true AS distinct_close, true AS median_close FROM silver WHERE pickup_year = {y} AND pickup_month = {m} AND pickup_day BETWEEN {a} AND {b}"
        )
    return on_silver("\nUNION ALL ".join(parts))


def _rollup(keys: str) -> str:
    return f"""SELECT {keys}, CAST(sum(total_rides) AS BIGINT) AS rides, sum(total_fare) AS fare,
      sum(total_revenue) AS revenue, sum(total_tip) AS tips, sum(sum_trip_distance) AS distance
    FROM gold GROUP BY {keys}"""


def _sample_spread(size: int, chunks: int, seed: int) -> str:
    """Rows drawn in MD5 order per chunk; the shortfall, one each, in the operator's order."""
    return f"""WITH {TRIPS.strip()},
c AS (SELECT count(*) AS n FROM events),
p AS (SELECT n, CAST(least({size}, n) AS BIGINT) AS size, CAST(least({size}, n) // {chunks} AS BIGINT) AS per FROM c),
t AS (SELECT *, row_number() OVER (ORDER BY event_id) - 1 AS position FROM trips),
k AS (SELECT t.*, CAST(((position + 1) * {chunks} - 1) // n AS INTEGER) AS i, per, size, n, md5('{seed}:' || CAST(position AS VARCHAR)) AS h FROM t, p),
r AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY h, position) AS rk FROM k),
extra(i, turn) AS (VALUES {_turns(chunks, seed)})
SELECT position, CAST(CASE WHEN rk <= per THEN r.i ELSE {chunks} END AS INTEGER) AS chunk, {r6(S.TRIP.names, TRIP_DOUBLES)}
FROM r JOIN extra ON r.i = extra.i
WHERE rk <= per + CASE WHEN size = n THEN n WHEN turn < size - per * {chunks} THEN 1 ELSE 0 END"""


def _turns(chunks: int, seed: int) -> str:
    """(chunk, its turn for an extra row); a table of no more rows than the sample is taken whole."""
    import random

    order = list(range(chunks))
    random.Random(seed).shuffle(order)
    return ", ".join(f"({i}, {t})" for t, i in enumerate(order))


# Trips with the dirt of the catalog's dirty bronze; NaN already null, as the policy has it.
DIRTY = """
trips_0 AS (SELECT * FROM trips),
dirty AS (
  SELECT * REPLACE (
    CASE WHEN event_id % 29 = 0 THEN 'not a time' ELSE tpep_pickup_datetime END AS tpep_pickup_datetime,
    CASE WHEN event_id % 43 = 0 THEN '2023-12-31 00:00:00' ELSE tpep_dropoff_datetime END AS tpep_dropoff_datetime,
    CASE WHEN event_id % 31 = 0 THEN NULL ELSE trip_distance END AS trip_distance,
    CASE WHEN event_id % 37 = 0 THEN NULL ELSE PULocationID END AS PULocationID,
    CASE WHEN event_id % 41 = 0 THEN NULL ELSE DOLocationID END AS DOLocationID)
  FROM trips_0)"""


# Trips as the catalog's drifting producers write them, read to the contract.
DRIFTED = """
drifted AS (
  SELECT * REPLACE (
    CASE WHEN event_id % 3 = 1 THEN NULL ELSE airport_fee END AS airport_fee,
    CASE WHEN event_id % 3 = 2 AND event_id % 31 = 0 THEN NULL ELSE trip_distance END AS trip_distance)
  FROM trips)"""

# What is wrong with a message of the catalog's faulty ones.
FAULT = "CASE WHEN event_id % 17 = 0 THEN 'no payload' WHEN event_id % 19 = 0 THEN 'not a record' WHEN event_id % 23 = 0 THEN 'wrong type' ELSE 'good' END"


def _on_dirty(body: str, *ctes: str) -> str:
    silver = SILVER.replace("FROM trips WHERE", "FROM dirty WHERE event_id % 29 <> 0 AND")
    return with_ctes(body, TRIPS, DIRTY, silver, *ctes)


def _gold_corrected() -> str:
    """Gold rebuilt over silver with day 11 emptied and trips of day 12 without a day."""
    lost = "pickup_day = 12 AND pickup_hour < 6"
    nulled = ", ".join(f"CASE WHEN {lost} THEN NULL ELSE {c} END AS {c}" for c in S.PARTITION_COLS)
    corrected = f"""
corrected AS (SELECT * REPLACE ({nulled}) FROM silver WHERE pickup_day <> 11)"""
    return with_ctes(f"SELECT {r6(GOLD_COLS, GOLD_DOUBLES)} FROM gold", TRIPS, SILVER, corrected, GOLD.replace("FROM silver)", "FROM corrected)"))


def _schema_check() -> str:
    parts = []
    for table, contract in (("silver", S.SILVER), ("gold", S.GOLD)):
        for i, f in enumerate(contract.fields):
            kind = f.dataType.simpleString()
            parts.append(f"SELECT '{table}' AS table_name, {i} AS position, '{f.name}' AS column_name, '{kind}' AS expected_type, '{kind}' AS actual_type, count(*) - count({f.name}) AS n_nulls, true AS ok FROM {table}")
    return on_gold("\nUNION ALL ".join(parts))


def _snap_rounds(sql: str, places: int = 6) -> str:
    """Rewrite every ``round(x, 6)`` as the tie-safe rounding of
    ``tripflow.functions.columns.round_doubles``: snap to a 9-place decimal,
    round that decimal half away from zero, back to double (NaN and
    infinities pass through). A plain double ``round`` splits the two
    engines on exact ties such as 432.95 / 32 = 13.5296875, whose summed
    double lands just below or above the tie depending on summation order."""
    tail, out, i = f", {places})", [], 0
    while True:
        j = sql.find("round(", i)
        if j < 0:
            return "".join(out) + sql[i:]
        depth, k = 0, j + len("round")
        while True:  # the matching closing parenthesis
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            if depth == 0:
                break
            k += 1
        call = sql[j : k + 1]
        if not call.endswith(tail):
            out.append(sql[i : j + len("round(")])
            i = j + len("round(")
            continue
        x = _snap_rounds(call[len("round(") : -len(tail)], places)
        scale = places + 3
        out.append(sql[i:j] + f"COALESCE(CAST(round(TRY_CAST({x} AS DECIMAL(38, {scale})), {places}) AS DOUBLE), {x})")
        i = k + 1


def oracle_sql() -> dict[str, str]:
    return {name: _snap_rounds(sql) for name, sql in _oracle_sql().items()}


def _oracle_sql() -> dict[str, str]:
    from tripflow.plans import catalog as K

    trip_all = _trips_r6()
    gold_all = _gold_r6()
    silver_all = _silver_r6()
    measures = ", ".join(f"round({c}, 6) AS {c}" for c in S.CAST_MEASURES)
    # Store-and-forward messages arrive garbled: every field null, flagged.
    garbled = "store_and_fwd_flag = 'Y'"
    wire_bad = ", ".join(
        (f"round(CASE WHEN {garbled} THEN NULL ELSE {c} END, 6) AS {c}" if c in TRIP_DOUBLES else f"CASE WHEN {garbled} THEN NULL ELSE {c} END AS {c}")
        for c in S.TRIP.names
    )
    y, m, d = K.ONE_DAY
    head = _trips_r6(order_limit=f"ORDER BY event_id LIMIT {K.HEAD_ROWS}")
    keys = ", ".join(S.GOLD_KEYS)
    return {
        "gold_trip_kpis": gold_all,
        "silver_trips": silver_all,
        "cast_measures": on_trips(f"SELECT tpep_pickup_datetime, {measures} FROM trips"),
        "cast_zone_ids": on_trips(
            "SELECT tpep_pickup_datetime, CAST(TRUNC(PULocationID) AS INTEGER) AS PULocationID, "
            "CAST(TRUNC(DOLocationID) AS INTEGER) AS DOLocationID FROM trips"
        ),
        "filter_positive": _trips_r6("WHERE passenger_count > 0 AND trip_distance > 0 AND fare_amount > 0 AND total_amount > 0"),
        "filter_required": _trips_r6("WHERE tpep_pickup_datetime IS NOT NULL AND tpep_dropoff_datetime IS NOT NULL"),
        "silver_clean": _trips_r6(f"WHERE {CLEAN_WHERE}"),
        "reject_report": _reject_report(),
        "rush_hour_flag": on_gold(
            "SELECT pickup_hour, CAST(rush_hour_flag AS INTEGER) AS rush_hour_flag, count(*) AS n_rides FROM gold_in GROUP BY 1, 2"
        ),
        "parse_timestamps": on_trips(
            "SELECT strptime(tpep_pickup_datetime, '%Y-%m-%d %H:%M:%S') AS pickup_ts, "
            "strptime(tpep_dropoff_datetime, '%Y-%m-%d %H:%M:%S') AS dropoff_ts FROM trips"
        ),
        "trip_duration": _silver_r6(["tpep_pickup_datetime", "tpep_dropoff_datetime", "trip_duration_minutes"]),
        "tip_percentage": on_trips(
            "SELECT round(fare_amount, 6) AS fare_amount, round(tip_amount, 6) AS tip_amount, "
            "round(CASE WHEN fare_amount > 0 THEN tip_amount / fare_amount * 100 ELSE 0.0 END, 6) AS tip_pct FROM trips"
        ),
        "date_parts": _silver_r6(
            ["tpep_pickup_datetime", "pickup_hour", "pickup_day_of_week", "pickup_day_of_month", "pickup_year", "pickup_month", "pickup_day"]
        ),
        "trip_flags": _silver_r6(["trip_distance", "tip_pct", "is_long_trip", "is_short_trip", "high_tip_flag"]),
        "conform_schema": trip_all,
        "agg_rides": _gold_r6(S.GOLD_KEYS + ["total_rides"]),
        "agg_financial": _gold_r6(S.GOLD_KEYS + ["total_fare", "total_tip", "total_revenue", "sum_trip_distance"]),
        "agg_averages": _gold_r6(S.GOLD_KEYS + ["avg_fare", "avg_tip_pct", "avg_trip_distance", "avg_trip_duration"]),
        "agg_flag_counts": _gold_r6(S.GOLD_KEYS + ["num_high_tip_trips", "num_long_trips", "num_short_trips", "num_rush_hour_rides"]),
        "table_counts": on_gold(
            "SELECT 'bronze' AS stage, count(*) AS n_rows FROM trips UNION ALL "
            "SELECT 'silver', count(*) FROM silver UNION ALL SELECT 'gold', count(*) FROM gold"
        ),
        "silver_profile": _profile(),
        "profile_day_range": _profile_range(),
        "sample_half": _sample_spread("n // 2", K.SPREAD_CHUNKS, K.SPREAD_SEED),
        "limit_ordered": _gold_r6(tail=f"ORDER BY {keys} LIMIT 10"),
        "sample_head": head,
        "sample_spread": _sample_spread(K.SPREAD_ROWS, K.SPREAD_CHUNKS, K.SPREAD_SEED),
        "sample_spread_7": _sample_spread(K.SPREAD_ROWS, 7, K.SPREAD_SEED),
        "preview": on_gold(f"SELECT least({K.PREVIEW_ROWS}, count(*)) AS n_rows, least({K.PREVIEW_ROWS}, count(*)) AS n_in_gold FROM gold"),
        "gold_refresh_corrections": _gold_corrected(),
        "silver_dirty": _on_dirty(f"SELECT {r6(S.SILVER.names, SILVER_DOUBLES)} FROM silver"),
        "silver_rejects": _on_dirty(f"SELECT {r6(S.TRIP.names, TRIP_DOUBLES)} FROM dirty WHERE event_id % 29 = 0 AND {CLEAN_WHERE}"),
        "gold_dirty": _on_dirty(f"SELECT {r6(GOLD_COLS, GOLD_DOUBLES)} FROM gold", GOLD),
        "schema_check": _schema_check(),
        "bronze_drift": with_ctes(f"SELECT {r6(S.TRIP.names, TRIP_DOUBLES)} FROM drifted", TRIPS, DRIFTED),
        # Of the three producers' schemas, what is not the contract's.
        "drift_report": """SELECT * FROM (VALUES
  ('VendorID', 'int', 'string', 'print', CAST(1 AS BIGINT), true), ('passenger_count', 'int', 'double', 'widen', 1, true),
  ('payment_type', 'bigint', 'double', 'widen', 1, true), ('airport_fee', NULL, 'double', 'missing', 1, true),
  ('trip_distance', 'string', 'double', 'parse', 1, true), ('note', 'string', NULL, 'extra', 1, false)
) r(column_name, found_type, expected_type, action, n_folders, ok)""",
        "csv_export_full": trip_all,
        "wire_from_csv": trip_all,
        "warehouse_append": gold_all,
        "warehouse_balanced": gold_all,
        "warehouse_refresh_days": _gold_corrected(),
        "scan_bronze_json": trip_all,
        "scan_silver_partitioned": silver_all,
        "scan_gold_one_day": _gold_r6(where=f"WHERE pickup_year = {y} AND pickup_month = {m} AND pickup_day = {d}"),
        "list_partitions": on_silver("SELECT DISTINCT pickup_year, pickup_month, pickup_day FROM silver"),
        "scan_csv": trip_all,
        "scan_raw_parquet": trip_all,
        "silver_roundtrip": silver_all,
        "gold_roundtrip": gold_all,
        "gold_refresh_days": gold_all,
        "silver_gold_incremental": gold_all,
        "gold_tiered": gold_all,
        "silver_gold_restart_new_checkpoint": silver_all,
        "csv_roundtrip": head,
        "wire_encode": trip_all,
        "wire_encode_keyed": on_trips("SELECT VendorID AS key, count(*) AS n_messages FROM trips GROUP BY VendorID"),
        "wire_decode": on_trips(f"SELECT {wire_bad}, ({garbled}) AS is_malformed FROM trips"),
        "ingest_stream": trip_all,
        "ingest_stream_parquet": trip_all,
        "ingest_foreach_batch": trip_all,
        "ingest_restart": trip_all,
        "ingest_redelivered": trip_all,
        "bronze_compacted": trip_all,
        # Four payload files, one a batch, whatever they hold.
        "checkpoint_report": "SELECT i AS batch_id, 'files' AS kind, true AS committed, i + 1 AS position, CAST(1 AS BIGINT) AS advance, true AS in_order FROM range(4) r(i)",
        "ingest_quarantine": on_trips(
            f"SELECT {FAULT} AS outcome, count(*) AS n_messages, round(CASE WHEN {FAULT} = 'good' THEN sum(total_amount) END, 6) AS revenue FROM trips GROUP BY 1"
        ),
        "quarantine_payloads": on_trips(
            f"SELECT {FAULT} AS reason, CASE WHEN event_id % 17 = 0 THEN NULL ELSE coalesce(tpep_pickup_datetime, '') END AS pickup, count(*) AS n FROM trips WHERE {FAULT} <> 'good' GROUP BY 1, 2"
        ),
        "warehouse_roundtrip": gold_all,
        "warehouse_truncate_reload": gold_all,
        "load_summary": on_gold("SELECT pickup_year, pickup_month, pickup_day, count(*) AS n_rows FROM gold GROUP BY 1, 2, 3"),
        "borough_mapping": with_ctes(
            """SELECT r.PULocationID, r.DOLocationID, r.rides, round(r.revenue, 6) AS revenue,
  pz.zone AS pickup_zone, pz.borough AS pickup_borough, dz.zone AS dropoff_zone, dz.borough AS dropoff_borough
FROM routes r LEFT JOIN zones pz ON r.PULocationID = pz.zone_id LEFT JOIN zones dz ON r.DOLocationID = dz.zone_id""",
            TRIPS,
            SILVER,
            GOLD,
            ZONES,
            """
routes AS (SELECT PULocationID, DOLocationID, CAST(sum(total_rides) AS BIGINT) AS rides, sum(total_revenue) AS revenue
  FROM gold GROUP BY 1, 2)""",
        ),
        "peak_hours": on_gold(
            f"""SELECT pickup_hour, rides, round(revenue, 6) AS revenue,
  round(CASE WHEN distance > 0 THEN revenue / distance ELSE 0.0 END, 6) AS revenue_per_mile
FROM ({_rollup('pickup_hour')}) ORDER BY rides DESC, pickup_hour LIMIT {K.TOP_HOURS}"""
        ),
        "busiest_zones": on_gold(
            f"""SELECT * FROM (
  SELECT CAST(rank() OVER (ORDER BY rides DESC) AS INTEGER) AS rank, PULocationID, rides, round(revenue, 6) AS revenue,
    round(revenue / rides, 6) AS revenue_per_ride
  FROM ({_rollup('PULocationID')})) WHERE rank <= {K.TOP_ZONES}"""
        ),
        "revenue_daily": on_gold(
            f"""SELECT pickup_year, pickup_month, pickup_day, rides, round(fare, 6) AS fare, round(revenue, 6) AS revenue,
  round(tips, 6) AS tips, round(fare / rides, 6) AS avg_fare, round(revenue / rides, 6) AS avg_revenue_per_ride,
  round(CASE WHEN distance > 0 THEN revenue / distance ELSE 0.0 END, 6) AS revenue_per_mile
FROM ({_rollup('pickup_year, pickup_month, pickup_day')})"""
        ),
        "tip_patterns": on_silver(
            """SELECT pickup_day_of_week, pickup_hour, count(*) AS rides,
  CAST(sum(high_tip_flag) AS BIGINT) AS high_tip_rides, round(avg(tip_pct), 6) AS avg_tip_pct,
  round(sum(tip_amount), 6) AS tips, round(CAST(sum(high_tip_flag) AS DOUBLE) / count(*), 6) AS high_tip_share
FROM silver GROUP BY 1, 2"""
        ),
        "route_heatmap": on_gold(
            f"""SELECT PULocationID, DOLocationID, rides, round(revenue, 6) AS revenue,
  round(CASE WHEN distance > 0 THEN revenue / distance ELSE 0.0 END, 6) AS revenue_per_mile
FROM ({_rollup('PULocationID, DOLocationID')})"""
        ),
    }
