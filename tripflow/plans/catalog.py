"""Registered queries: one per operator of the blueprint.

Every query takes ``(spark, sf_dir)``, reads the driver's tables (trips are
derived from ``events``, zones from ``nation``/``region``) over the whole
table, and returns a DataFrame. Queries that exercise a sink write to a new
folder under the session's checkpoint directory and return a read-back of
what was written. Doubles are rounded to 6 places for the cross-engine check
only (``_r``); the operators themselves never round.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow import schema as S
from tripflow.functions import columns as C
from tripflow.functions.columns import round_doubles as _r
from tripflow.operators import gold as G
from tripflow.operators import profile as P
from tripflow.operators import reports as R
from tripflow.operators import sample as SM
from tripflow.operators import silver as SV
from tripflow.operators import wire as W
from tripflow.plans import jobs as J
from tripflow.session import scratch_path
from tripflow.sinks.files import write_csv, write_partitioned, write_table
from tripflow.sinks.warehouse import load_warehouse, refresh_warehouse_days, write_warehouse
from tripflow.sources import files as SF
from tripflow.sources.drift import drift_report, read_drifted
from tripflow.sources.trips import read_trips, read_zones, table_path, trips_from_events
from tripflow.sources.warehouse import read_warehouse
from tripflow.streaming import ingest as I
from tripflow.streaming import quarantine as Q
from tripflow.streaming.compact import compact_batches, read_batches, vacuum_batches
from tripflow.streaming.incremental import silver_gold_incremental
from tripflow.streaming.report import checkpoint_report

TRIP_COLS = [f.name for f in S.TRIP.fields]
# Fixed day read by the single-partition scan.
ONE_DAY = (2024, 1, 15)
# Parameters of the registered sample queries.
HEAD_ROWS = 1000
SPREAD_ROWS = 1005
SPREAD_CHUNKS = 10
SPREAD_SEED = 42
PREVIEW_ROWS = 5
# Days of the stored profiles that are merged.
PROFILE_RANGE = ((2024, 1, 5), (2024, 1, 20))
TOP_HOURS = 5
TOP_ZONES = 3
# The ingest restart query stops the stream at this pickup time.
RESTART_AT = "2024-01-16 00:00:00"


# --- shared building blocks -------------------------------------------------
def trips(spark: SparkSession, sf: str) -> DataFrame:
    return read_trips(spark, sf)


def silver(spark: SparkSession, sf: str) -> DataFrame:
    return SV.build_silver(trips(spark, sf))


def gold(spark: SparkSession, sf: str) -> DataFrame:
    return G.build_gold(silver(spark, sf))


def positioned_trips(spark: SparkSession, sf: str) -> SM.Positioned:
    return SM.with_position(read_trips(spark, sf, keep=("_file", "_row")))


def _written_silver(spark: SparkSession, sf: str) -> str:
    path = scratch_path(spark, "silver")
    # As the silver job writes it: map-only, no shuffle.
    write_partitioned(silver(spark, sf), path, rebalance=False)
    return path


def _written_gold(spark: SparkSession, sf: str) -> str:
    path = scratch_path(spark, "gold")
    write_partitioned(gold(spark, sf), path)
    return path


def _derby_url(spark: SparkSession) -> tuple[str, dict]:
    """Embedded Derby (ships with Spark, opens no port) as a test warehouse."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(scratch_path(spark, "warehouse")).toUri()
    # Derby takes a local path, and refuses the file: of a checkpoint directory given as a URI.
    folder = at.getPath() if at.getScheme() in (None, "file") else at.toString()
    return f"jdbc:derby:{folder}/db;create=true", {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


# --- layers -----------------------------------------------------------------
def q_gold_trip_kpis(spark, sf):
    return _r(gold(spark, sf))


def q_silver_trips(spark, sf):
    return _r(silver(spark, sf))


# --- projections, casts, filters, scalar functions ----------------------------
def q_cast_measures(spark, sf):
    # Untyped bronze: the measures arrive as text, as after inference (D3).
    untyped = trips(spark, sf).withColumns({c: F.col(c).cast("string") for c in S.CAST_MEASURES})
    return _r(SV.cast_measures(untyped).select("tpep_pickup_datetime", *S.CAST_MEASURES))


def q_cast_zone_ids(spark, sf):
    return G.cast_zone_ids(trips(spark, sf)).select("tpep_pickup_datetime", *S.ZONE_IDS)


def q_filter_positive(spark, sf):
    return _r(SV.filter_positive(trips(spark, sf)))


def q_filter_required(spark, sf):
    return _r(SV.filter_required(trips(spark, sf)))


def q_silver_clean(spark, sf):
    return _r(SV.clean(trips(spark, sf)))


def q_reject_report(spark, sf):
    return SV.reject_report(trips(spark, sf))


def q_rush_hour_flag(spark, sf):
    flagged = G.add_rush_hour(silver(spark, sf))
    return flagged.groupBy("pickup_hour", "rush_hour_flag").agg(F.count(F.lit(1)).alias("n_rides"))


def q_parse_timestamps(spark, sf):
    t = trips(spark, sf)
    return t.select(C.parse_ts(S.PICKUP_TS).alias("pickup_ts"), C.parse_ts(S.DROPOFF_TS).alias("dropoff_ts"))


def q_trip_duration(spark, sf):
    return _r(silver(spark, sf).select(S.PICKUP_TS, S.DROPOFF_TS, "trip_duration_minutes"))


def q_tip_percentage(spark, sf):
    t = trips(spark, sf)
    return _r(t.select("fare_amount", "tip_amount", C.tip_pct().alias("tip_pct")))


def q_date_parts(spark, sf):
    return silver(spark, sf).select(
        S.PICKUP_TS, "pickup_hour", "pickup_day_of_week", "pickup_day_of_month", "pickup_year", "pickup_month", "pickup_day"
    )


def q_trip_flags(spark, sf):
    return _r(silver(spark, sf).select("trip_distance", "tip_pct", "is_long_trip", "is_short_trip", "high_tip_flag"))


def q_conform_schema(spark, sf):
    shuffled = trips(spark, sf).select(*reversed(TRIP_COLS))
    return _r(W.conform(shuffled, S.TRIP, strict=True))


# --- aggregations -----------------------------------------------------------
def _gold_subset(spark, sf, cols):
    return _r(gold(spark, sf).select(*S.GOLD_KEYS, *cols))


def q_agg_rides(spark, sf):
    return _gold_subset(spark, sf, ["total_rides"])


def q_agg_financial(spark, sf):
    return _gold_subset(spark, sf, ["total_fare", "total_tip", "total_revenue", "sum_trip_distance"])


def q_agg_averages(spark, sf):
    return _gold_subset(spark, sf, ["avg_fare", "avg_tip_pct", "avg_trip_distance", "avg_trip_duration"])


def q_agg_flag_counts(spark, sf):
    return _gold_subset(spark, sf, ["num_high_tip_trips", "num_long_trips", "num_short_trips", "num_rush_hour_rides"])


def q_table_counts(spark, sf):
    layers = P.layer_counts(trips(spark, sf), SV.clean_predicate())
    return layers.unionByName(P.stage_counts({"gold": gold(spark, sf)}))


def q_silver_profile(spark, sf):
    return _r(P.profile(silver(spark, sf)))


def q_profile_day_range(spark, sf):
    # Profiles are stored per day, from silver that comes in two parts; the
    # range is read from the parts alone. Estimates are held against exact values.
    root, parts = _written_silver(spark, sf), scratch_path(spark, "profiles")
    stored = SF.read_table(spark, root)
    early = F.col("pickup_hour") < 12
    P.write_day_profiles(stored.filter(early), parts, part="morning")
    P.write_day_profiles(stored.filter(~early), parts, part="rest")
    first, last = PROFILE_RANGE
    got = P.read_day_profiles(spark, parts, first, last)
    held = stored.filter(P.day_number().between(P.number_of(first), P.number_of(last)))
    return _r(got.join(P.exact_errors(held, got), "column_name").select("column_name", "n_values", "mean", "stddev", "min_value", "max_value", "distinct_close", "median_close"))


# --- limits and samples -----------------------------------------------------
def q_preview(spark, sf):
    # Which rows an unordered limit returns is open; how many, and that each
    # is a gold row, is not.
    g = SF.read_table(spark, _written_gold(spark, sf))
    shown = g.limit(PREVIEW_ROWS).select(*S.GOLD_KEYS)
    same = [F.col(f"s.{k}").eqNullSafe(F.col(f"g.{k}")) for k in S.GOLD_KEYS]
    found = shown.alias("s").join(g.alias("g"), same, "left").select(F.col("g.total_rides").isNotNull().cast("int").alias("f"))
    return found.agg(F.count(F.lit(1)).alias("n_rows"), F.sum("f").cast("bigint").alias("n_in_gold"))


def q_limit_ordered(spark, sf):
    return _r(gold(spark, sf).orderBy(*S.GOLD_KEYS).limit(10))


def q_sample_head(spark, sf):
    head = SM.read_head(spark, table_path(sf, "events"), HEAD_ROWS)
    return _r(trips_from_events(head).select(*TRIP_COLS))


def _spread(spark, sf, chunks):
    pos = positioned_trips(spark, sf)
    sample = SM.spread_sample(pos.df, pos.total, SPREAD_ROWS, chunks, seed=SPREAD_SEED)
    return _r(sample.select(F.col(SM.POS).alias("position"), F.col(SM.CHUNK).alias("chunk"), *TRIP_COLS))


def q_sample_spread(spark, sf):
    return _spread(spark, sf, SPREAD_CHUNKS)


def q_sample_spread_7(spark, sf):
    return _spread(spark, sf, 7)


def q_sample_half(spark, sf):
    pos = positioned_trips(spark, sf)
    sample = SM.spread_sample(pos.df, pos.total, pos.total // 2, SPREAD_CHUNKS, seed=SPREAD_SEED)
    return _r(sample.select(F.col(SM.POS).alias("position"), F.col(SM.CHUNK).alias("chunk"), *TRIP_COLS))


# --- file sources and sinks ---------------------------------------------------
def q_scan_bronze_json(spark, sf):
    path = scratch_path(spark, "bronze-json")
    write_table(trips(spark, sf), path, "json", "overwrite")
    return _r(SF.read_bronze(spark, path))


def q_scan_silver_partitioned(spark, sf):
    root = _written_silver(spark, sf)
    # Whole table; the y/m/d columns come back from the folder names.
    return _r(SF.read_table(spark, root).select(*S.SILVER.names))


def q_scan_gold_one_day(spark, sf):
    root = _written_gold(spark, sf)
    return _r(SF.read_day(spark, root, *ONE_DAY).select(*S.GOLD.names))


def q_list_partitions(spark, sf):
    return SF.list_partitions(spark, _written_silver(spark, sf))


def q_scan_csv(spark, sf):
    path = scratch_path(spark, "csv")
    write_csv(trips(spark, sf), path)
    return _r(SF.read_csv(spark, path))


def q_scan_raw_parquet(spark, sf):
    return _r(trips_from_events(SF.read_raw_parquet(spark, table_path(sf, "events"))))


def q_silver_roundtrip(spark, sf):
    bronze = scratch_path(spark, "bronze")
    write_table(trips(spark, sf), bronze, "json", "overwrite")
    out = J.silver_job(spark, bronze, scratch_path(spark, "silver"))
    return _r(out.select(*S.SILVER.names))


def q_gold_roundtrip(spark, sf):
    out = J.gold_job(spark, _written_silver(spark, sf), scratch_path(spark, "gold"))
    return _r(out.select(*S.GOLD.names))


def q_gold_refresh_days(spark, sf):
    # Gold first built from silver without days 10-12; those days then arrive
    # late and are rebuilt alone. The result must equal a full rebuild.
    silver_root = _written_silver(spark, sf)
    gold_root = scratch_path(spark, "gold")
    late = F.col("pickup_day").between(10, 12)
    write_partitioned(G.build_gold(SF.read_table(spark, silver_root).filter(~late)), gold_root)
    days = SF.list_partitions(spark, silver_root).filter(late)
    out = J.refresh_gold_days(spark, silver_root, gold_root, days)
    return _r(out.select(*S.GOLD.names))


def _corrected(silver: DataFrame) -> DataFrame:
    """Silver after corrections: day 11 emptied, some trips of day 12 without a day."""
    lost = (F.col("pickup_day") == 12) & (F.col("pickup_hour") < 6)
    nulled = {c: F.when(lost, F.lit(None).cast("int")).otherwise(F.col(c)) for c in S.PARTITION_COLS}
    return silver.filter(F.col("pickup_day") != 11).withColumns(nulled)


def q_gold_refresh_corrections(spark, sf):
    # Gold of the table without day 10; then day 10 arrives late, day 11 is
    # emptied and trips of day 12 lose their day. Refreshing the listed days
    # must equal a full rebuild over the corrected table.
    before, after, gold_root = (scratch_path(spark, n) for n in ("silver", "silver", "gold"))
    write_partitioned(silver(spark, sf).filter(F.col("pickup_day") != 10), before)
    J.gold_job(spark, before, gold_root)
    write_partitioned(_corrected(silver(spark, sf)), after)
    old, new = SF.list_partitions(spark, before), SF.list_partitions(spark, after)
    listed = F.col("pickup_day").between(10, 12) | F.col("pickup_day").isNull()
    out = J.refresh_gold_days(spark, after, gold_root, old.union(new).filter(listed))
    return _r(out.select(*S.GOLD.names))


def _dirty_bronze(spark, sf) -> str:
    """Trips with datetimes that do not parse, NaN and missing values, as JSON bronze."""
    e = F.col("event_id")
    t = read_trips(spark, sf, keep=("event_id",))
    dirty = {
        S.PICKUP_TS: F.when(e % 29 == 0, F.lit("not a time")).otherwise(F.col(S.PICKUP_TS)),
        S.DROPOFF_TS: F.when(e % 43 == 0, F.lit("2023-12-31 00:00:00")).otherwise(F.col(S.DROPOFF_TS)),
        "trip_distance": F.when(e % 31 == 0, F.lit(float("nan"))).otherwise(F.col("trip_distance")),
        "PULocationID": F.when(e % 37 == 0, F.lit(None).cast("double")).otherwise(F.col("PULocationID")),
        "DOLocationID": F.when(e % 41 == 0, F.lit(float("nan"))).otherwise(F.col("DOLocationID")),
    }
    path = scratch_path(spark, "bronze-dirty")
    write_table(t.withColumns(dirty).select(*TRIP_COLS), path, "json", "overwrite")
    return path


def q_silver_dirty(spark, sf):
    out = J.silver_job(spark, _dirty_bronze(spark, sf), scratch_path(spark, "silver"), on_bad_value="null", nan_policy="null")
    return _r(out.select(*S.SILVER.names))


def q_silver_rejects(spark, sf):
    silver_root = scratch_path(spark, "silver")
    J.silver_job(spark, _dirty_bronze(spark, sf), silver_root, on_bad_value="null", nan_policy="null", reject_path=f"{silver_root}-bad")
    return _r(spark.read.parquet(f"{silver_root}-bad").select(*TRIP_COLS))


def q_gold_dirty(spark, sf):
    silver_root = scratch_path(spark, "silver")
    J.silver_job(spark, _dirty_bronze(spark, sf), silver_root, on_bad_value="null", nan_policy="null")
    return _r(J.gold_job(spark, silver_root, scratch_path(spark, "gold")).select(*S.GOLD.names))


def _drifted_bronze(spark, sf) -> str:
    """Batches of three producers: by the contract; whole numbers and no airport fee; distances as text, and a note."""
    root, e = scratch_path(spark, "bronze-drift"), F.col("event_id")
    t = read_trips(spark, sf, keep=("event_id",))
    whole = {c: F.col(c).cast(k) for c, k in (("passenger_count", "int"), ("payment_type", "bigint"), ("VendorID", "int"))}
    text = F.when(e % 31 == 0, F.lit("n/a")).otherwise(F.col("trip_distance").cast("string"))
    batches = [t, t.withColumns(whole).drop("airport_fee"), t.withColumns({"trip_distance": text, "note": F.lit("x")})]
    for n, rows in enumerate(batches):
        rows.filter(e % 3 == n).drop("event_id").write.parquet(f"{root}/batch_id={n}")
    return root


def q_bronze_drift(spark, sf):
    return _r(read_drifted(spark, _drifted_bronze(spark, sf)))


def q_drift_report(spark, sf):
    return drift_report(spark, _drifted_bronze(spark, sf)).filter("action <> 'as is'")


def q_schema_check(spark, sf):
    parts = [("silver", _written_silver(spark, sf), S.SILVER), ("gold", _written_gold(spark, sf), S.GOLD)]
    checks = [S.check_contract(SF.read_table(spark, root), contract).withColumn("table_name", F.lit(name)) for name, root, contract in parts]
    return checks[0].unionByName(checks[1])


def q_csv_export_full(spark, sf):
    raw, out = scratch_path(spark, "raw"), scratch_path(spark, "csv-full")
    trips(spark, sf).write.parquet(raw)
    J.export_csv(SF.read_raw_parquet(spark, raw), out)
    return _r(SF.read_csv(spark, out))


def q_csv_roundtrip(spark, sf):
    path = scratch_path(spark, "sample-csv")
    raw = scratch_path(spark, "raw")
    trips(spark, sf).write.parquet(raw)
    J.export_sample(spark, raw, path, how="head", n=HEAD_ROWS)
    return _r(SF.read_csv(spark, path))


# --- wire -------------------------------------------------------------------
def q_wire_from_csv(spark, sf):
    path = scratch_path(spark, "csv")
    write_csv(trips(spark, sf), path)
    return _r(W.from_wire(J.publish_csv(spark, path)))


def q_wire_encode(spark, sf):
    return _r(W.from_wire(J.publish(trips(spark, sf))))


def q_wire_encode_keyed(spark, sf):
    wire = J.publish(trips(spark, sf), key_cols=["VendorID"])
    return wire.groupBy("key").agg(F.count(F.lit(1)).alias("n_messages"))


def q_wire_decode(spark, sf):
    wire = W.to_wire(trips(spark, sf), columns=TRIP_COLS, keep=("store_and_fwd_flag",))
    # Same messages; those the meter stored and forwarded arrive garbled.
    garbled = F.col("store_and_fwd_flag") == "Y"
    raw = wire.select(F.when(garbled, F.lit("garbage").cast("binary")).otherwise(F.col("value")).alias("value"))
    return _r(W.decode_flagged(raw))


# --- streaming ----------------------------------------------------------------
def _arrived_before(cutoff: str):
    """Trips picked up before ``cutoff``; a null pickup counts as later."""
    return F.coalesce(F.col(S.PICKUP_TS) < F.lit(cutoff), F.lit(False))


def _payload_files(spark, sf, path, part: int | None = None, files: int = 4) -> None:
    """Payload files of all trips, or of the trips that arrive before the
    restart (``part=0``) or after it (``part=1``): together, all trips."""
    t = trips(spark, sf)
    if part is not None:
        early = _arrived_before(RESTART_AT)
        t = t.filter(early if part == 0 else ~early)
    J.publish(t).repartition(files).write.mode("append").parquet(path)


def _stream_to_bronze(spark, src, bronze, ckpt, fmt):
    I.run_to_end(I.ingest_bronze(spark, "file", bronze, ckpt, fmt, "available_now", {"path": src, "max_files_per_trigger": 1}))


def q_ingest_stream(spark, sf):
    src, bronze, ckpt = (scratch_path(spark, n) for n in ("wire", "bronze", "ckpt"))
    _payload_files(spark, sf, src)
    _stream_to_bronze(spark, src, bronze, ckpt, "json")
    return _r(SF.read_bronze(spark, bronze))


def q_ingest_stream_parquet(spark, sf):
    src, bronze, ckpt = (scratch_path(spark, n) for n in ("wire", "bronze", "ckpt"))
    _payload_files(spark, sf, src)
    _stream_to_bronze(spark, src, bronze, ckpt, "parquet")
    return _r(SF.read_bronze(spark, bronze, fmt="parquet"))


def q_ingest_foreach_batch(spark, sf):
    src, bronze, ckpt = (scratch_path(spark, n) for n in ("wire", "bronze", "ckpt"))
    _payload_files(spark, sf, src)
    raw, payload = I.read_wire_stream(spark, "file", path=src, max_files_per_trigger=1)
    I.run_to_end(I.append_batches(W.from_wire(raw, payload), bronze, ckpt, trigger="available_now"))
    return _r(spark.read.parquet(bronze).select(*TRIP_COLS))


def q_ingest_restart(spark, sf):
    src, bronze, ckpt = (scratch_path(spark, n) for n in ("wire", "bronze", "ckpt"))
    _payload_files(spark, sf, src, part=0)
    _stream_to_bronze(spark, src, bronze, ckpt, "json")
    # The rest of the month arrives while the query is down; the restart
    # resumes from the checkpoint.
    _payload_files(spark, sf, src, part=1)
    _stream_to_bronze(spark, src, bronze, ckpt, "json")
    return _r(SF.read_bronze(spark, bronze))


def q_bronze_compacted(spark, sf):
    # Six batches are packed into one folder; two more arrive; the small ones of before are gone.
    src, bronze, ckpt = (scratch_path(spark, n) for n in ("wire", "bronze", "ckpt"))
    for part, files in ((0, 6), (1, 2)):
        _payload_files(spark, sf, src, part=part, files=files)
        raw, payload = I.read_wire_stream(spark, "file", path=src, max_files_per_trigger=1)
        I.run_to_end(I.append_batches(W.from_wire(raw, payload), bronze, ckpt, trigger="available_now"))
        if part == 0:
            compact_batches(spark, bronze)
            vacuum_batches(spark, bronze)
    return _r(read_batches(spark, bronze))


def q_checkpoint_report(spark, sf):
    # What two runs over one checkpoint have left in its logs: a batch a file.
    src, bronze, ckpt = (scratch_path(spark, n) for n in ("wire", "bronze", "ckpt"))
    for part in (0, 1):
        _payload_files(spark, sf, src, part=part, files=2)
        _stream_to_bronze(spark, src, bronze, ckpt, "json")
    later = F.coalesce(F.col("gap_s") > 0, F.lit(True))
    return checkpoint_report(spark, ckpt).select("batch_id", "kind", "committed", "position", "advance", later.alias("in_order"))


def _faulty_messages(spark, sf) -> DataFrame:
    """Messages of all trips: some without payload, some garbled, some with text where a number belongs."""
    e = F.col("event_id")
    wire = W.to_wire(read_trips(spark, sf, keep=("event_id",)), columns=TRIP_COLS, keep=("event_id",))
    text = F.col("value").cast("string")
    mistyped = F.regexp_replace(text, '"RatecodeID":[^,]*', '"RatecodeID":"many"')
    value = F.when(e % 17 == 0, F.lit(None)).when(e % 19 == 0, F.concat(F.lit("{"), text)).when(e % 23 == 0, mistyped).otherwise(text)
    return wire.select("event_id", value.cast("binary").alias("value"))


def q_ingest_quarantine(spark, sf):
    # Half of the messages arrive, the query stops, and a restart takes the others.
    src, bronze, bad, ckpt = (scratch_path(spark, n) for n in ("wire", "bronze", "quarantine", "ckpt"))
    messages, half = _faulty_messages(spark, sf), F.col("event_id") % 2 == 0
    for part in (half, ~half):
        messages.filter(part).select("value").repartition(2).write.mode("append").parquet(src)
        I.run_to_end(Q.ingest_quarantine(spark, "file", bronze, bad, ckpt, trigger="available_now", source_options={"path": src, "max_files_per_trigger": 1}))
    good = SF.read_bronze(spark, bronze, fmt="parquet").agg(F.lit("good").alias("outcome"), F.count(F.lit(1)).alias("n_messages"), F.sum("total_amount").alias("revenue"))
    held = Q.read_quarantine(spark, bad).groupBy(F.col("reason").alias("outcome")).agg(F.count(F.lit(1)).alias("n_messages"), F.lit(None).cast("double").alias("revenue"))
    return _r(good.unionByName(held))


def q_quarantine_payloads(spark, sf):
    # What was kept aside, raw as it came.
    src, bronze, bad, ckpt = (scratch_path(spark, n) for n in ("wire", "bronze", "quarantine", "ckpt"))
    _faulty_messages(spark, sf).select("value").repartition(2).write.parquet(src)
    I.run_to_end(Q.ingest_quarantine(spark, "file", bronze, bad, ckpt, trigger="available_now", source_options={"path": src}))
    text = F.col("payload").cast("string")
    stamp = F.regexp_extract(text, '"tpep_pickup_datetime":"([^"]*)"', 1)
    return Q.read_quarantine(spark, bad).groupBy("reason", stamp.alias("pickup")).agg(F.count(F.lit(1)).alias("n"))


def q_ingest_redelivered(spark, sf):
    # The first half of the month is delivered, then delivered again together
    # with the second half: bronze holds every trip once.
    src, bronze, ckpt = (scratch_path(spark, n) for n in ("wire", "bronze", "ckpt"))
    options = {"path": src, "max_files_per_trigger": 1}
    _payload_files(spark, sf, src, part=0, files=2)
    I.run_to_end(Q.ingest_once(spark, "file", bronze, ckpt, trigger="available_now", source_options=options))
    _payload_files(spark, sf, src, part=0, files=1)
    _payload_files(spark, sf, src, part=1, files=1)
    I.run_to_end(Q.ingest_once(spark, "file", bronze, ckpt, trigger="available_now", source_options=options))
    return _r(SF.read_bronze(spark, bronze))


def _ordered_bronze(spark, sf, files: int) -> str:
    """Bronze as files in pickup-time order, as a stream appends it."""
    bronze = scratch_path(spark, "bronze")
    write_table(trips(spark, sf).repartitionByRange(files, S.PICKUP_TS), bronze, "json", "overwrite")
    return bronze


def q_silver_gold_incremental(spark, sf):
    # Each micro-batch takes one bronze file, appends its silver rows and rebuilds
    # only the gold days it touched. The end state must equal a full rebuild.
    bronze, silver_root, gold_root, ckpt = (_ordered_bronze(spark, sf, 4), *(scratch_path(spark, n) for n in ("silver", "gold", "ckpt")))
    I.run_to_end(silver_gold_incremental(spark, bronze, silver_root, gold_root, ckpt, max_files_per_trigger=1))
    return _r(SF.read_table(spark, gold_root).select(*S.GOLD.names))


def q_gold_tiered(spark, sf):
    # Trips arrive out of order, so every batch touches every day and each day
    # gets a part a batch: tiers of two are merged again and again on the way.
    bronze, silver_root, gold_root, ckpt = (scratch_path(spark, n) for n in ("bronze", "silver", "gold", "ckpt"))
    write_table(trips(spark, sf).repartition(6, F.xxhash64(S.PICKUP_TS, "total_amount")), bronze, "json", "overwrite")
    I.run_to_end(silver_gold_incremental(spark, bronze, silver_root, gold_root, ckpt, max_files_per_trigger=1, fan=2))
    return _r(SF.read_table(spark, gold_root).select(*S.GOLD.names))


def q_silver_gold_restart_new_checkpoint(spark, sf):
    # Half of the files come in; the checkpoint is lost; another one, with
    # other batches, meets all files. Silver must hold every trip once.
    bronze, silver_root, gold_root, ckpt = (scratch_path(spark, n) for n in ("bronze", "silver", "gold", "ckpt"))
    t, first = trips(spark, sf), _arrived_before(RESTART_AT)
    write_table(t.filter(first).repartition(3), bronze, "json")
    I.run_to_end(silver_gold_incremental(spark, bronze, silver_root, gold_root, f"{ckpt}-1", max_files_per_trigger=1))
    write_table(t.filter(~first).repartition(2), bronze, "json")
    I.run_to_end(silver_gold_incremental(spark, bronze, silver_root, gold_root, f"{ckpt}-2", max_files_per_trigger=2))
    return _r(SF.read_table(spark, silver_root).select(*S.SILVER.names))


# --- warehouse ----------------------------------------------------------------
def q_warehouse_roundtrip(spark, sf):
    url, props = _derby_url(spark)
    g = SF.read_table(spark, _written_gold(spark, sf))
    write_warehouse(g, url, "gold_aggregates", "recreate", properties=props, num_partitions=4)
    back = read_warehouse(spark, url, "gold_aggregates", props, "pickup_day", 1, 32, 4)
    return _r(back.select(*S.GOLD.names))


def q_warehouse_truncate_reload(spark, sf):
    url, props = _derby_url(spark)
    g = SF.read_table(spark, _written_gold(spark, sf))
    write_warehouse(g, url, "gold_aggregates", "truncate", properties=props, num_partitions=4)
    write_warehouse(g, url, "gold_aggregates", "truncate", properties=props, num_partitions=4)
    return _r(read_warehouse(spark, url, "gold_aggregates", props).select(*S.GOLD.names))


def q_warehouse_append(spark, sf):
    url, props = _derby_url(spark)
    g = SF.read_table(spark, _written_gold(spark, sf))
    early = F.col("pickup_day") < 16
    load_warehouse(g.filter(early), url, "gold_aggregates", "recreate", properties=props, num_partitions=4)
    load_warehouse(g.filter(~early), url, "gold_aggregates", "append", properties=props, num_partitions=4)
    return _r(read_warehouse(spark, url, "gold_aggregates", props, days=SF.list_partitions(spark, _written_gold(spark, sf))).select(*S.GOLD.names))


def q_warehouse_refresh_days(spark, sf):
    # The warehouse holds gold without day 10. Then day 10 arrives late, day 11 is
    # emptied and trips of day 12 lose their day: the listed days are replaced
    # in gold and then in the warehouse, which must equal a full reload.
    url, props = _derby_url(spark)
    before, after, gold_root = (scratch_path(spark, n) for n in ("silver", "silver", "gold"))
    write_partitioned(silver(spark, sf).filter(F.col("pickup_day") != 10), before)
    load_warehouse(J.gold_job(spark, before, gold_root), url, "gold_aggregates", properties=props, num_partitions=4)
    write_partitioned(_corrected(silver(spark, sf)), after)
    old, new = SF.list_partitions(spark, before), SF.list_partitions(spark, after)
    listed = old.union(new).filter(F.col("pickup_day").between(10, 12) | F.col("pickup_day").isNull())
    J.refresh_gold_days(spark, after, gold_root, listed)
    refresh_warehouse_days(spark, gold_root, url, "gold_aggregates", listed, props, num_partitions=4)
    return _r(read_warehouse(spark, url, "gold_aggregates", props).select(*S.GOLD.names))


def q_warehouse_balanced(spark, sf):
    url, props = _derby_url(spark)
    load_warehouse(SF.read_table(spark, _written_gold(spark, sf)), url, "gold_aggregates", properties=props, num_partitions=4)
    return _r(read_warehouse(spark, url, "gold_aggregates", props, num_partitions=6, balanced=True).select(*S.GOLD.names))


def q_load_summary(spark, sf):
    url, props = _derby_url(spark)
    g = SF.read_table(spark, _written_gold(spark, sf))
    summary = load_warehouse(g, url, "gold_aggregates", "recreate", properties=props, num_partitions=4)
    return spark.createDataFrame([(*day, n) for day, n in summary.days.items()], "pickup_year int, pickup_month int, pickup_day int, n_rows bigint")


# --- README analyses ----------------------------------------------------------
def q_borough_mapping(spark, sf):
    return _r(R.borough_routes(gold(spark, sf), read_zones(spark, sf)))


def q_peak_hours(spark, sf):
    return _r(R.peak_hours(gold(spark, sf), TOP_HOURS))


def q_busiest_zones(spark, sf):
    return _r(R.busiest_zones(gold(spark, sf), TOP_ZONES))


def q_revenue_daily(spark, sf):
    return _r(R.revenue_daily(gold(spark, sf)))


def q_tip_patterns(spark, sf):
    return _r(R.tip_patterns(silver(spark, sf)))


def q_route_heatmap(spark, sf):
    return _r(R.route_heatmap(gold(spark, sf)))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name[2:]: fn for name, fn in globals().items() if name.startswith("q_") and callable(fn)}
