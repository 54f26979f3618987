"""Job entry points for spark-submit: one subcommand per pipeline stage.

    spark-submit -m tripflow.plans.cli silver --bronze s3://lake/bronze --silver s3://lake/silver

(or ``python -m tripflow.plans.cli ...``). The session comes from
``SparkSession.builder.getOrCreate()``, so master, resources and settings are
whatever spark-submit was given (see ``tripflow.session.SCALE_CONF``).
Connection secrets are read from environment variables (``--prop-env``),
never from the command line.
"""

from __future__ import annotations

import argparse
import json
import os
import sys

from pyspark.sql import SparkSession

REPORTS = ("borough_routes", "peak_hours", "busiest_zones", "revenue_daily", "tip_patterns", "route_heatmap")


def _props(args) -> dict:
    props = dict(kv.split("=", 1) for kv in (args.prop or []))
    for kv in args.prop_env or []:
        key, var = kv.split("=", 1)
        props[key] = os.environ[var]
    return props


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tripflow")
    sub = p.add_subparsers(dest="cmd", required=True)

    s = sub.add_parser("ingest", help="stream → bronze (J1)")
    s.add_argument("--source", choices=["kafka", "aws-kinesis", "file"], required=True)
    s.add_argument("--bronze", required=True)
    s.add_argument("--checkpoint", required=True)
    s.add_argument("--format", default="json", choices=["json", "parquet"])
    s.add_argument("--trigger", default="5 seconds", help='"available_now" or an interval')
    s.add_argument("--opt", action="append", help="source option key=value (servers, topic, stream, region, path, ...)")
    s.add_argument("--timeout", type=float, default=None, help="seconds; an available_now run that needs longer fails, a continuous one is stopped and says so")
    s.add_argument("--max-files-per-batch", type=int, default=None, help="bound on bronze files written per micro-batch")

    s = sub.add_parser("silver", help="bronze → silver (J2)")
    s.add_argument("--bronze", required=True)
    s.add_argument("--silver", required=True)
    s.add_argument("--bronze-format", default="json", choices=["json", "parquet"])
    s.add_argument("--on-bad-value", default="fail", choices=["fail", "null"])
    s.add_argument("--nan-policy", default="keep", choices=["keep", "null"])
    s.add_argument("--dynamic", action="store_true", help="replace only the days present")
    s.add_argument("--no-rebalance", action="store_true", help="write map-only (bronze known to be in arrival order)")
    s.add_argument("--rejects", help="where trips whose datetimes do not parse go (with --on-bad-value null)")
    s.add_argument("--profile", help="write a profile of the silver measures to this Parquet folder")
    s.add_argument("--reject-report", help="write rows failing each quality rule to this Parquet folder")

    s = sub.add_parser("incremental", help="bronze → silver → gold, only what arrived since the last run")
    s.add_argument("--bronze", required=True)
    s.add_argument("--silver", required=True)
    s.add_argument("--gold", required=True)
    s.add_argument("--checkpoint", required=True)
    s.add_argument("--bronze-format", default="json", choices=["json", "parquet"])
    s.add_argument("--trigger", default="available_now", help='"available_now" or an interval')
    s.add_argument("--max-files-per-trigger", type=int, default=None)
    s.add_argument("--on-bad-value", default="fail", choices=["fail", "null"])
    s.add_argument("--nan-policy", default="keep", choices=["keep", "null"])
    s.add_argument("--rejects", help="where trips whose datetimes do not parse go (with --on-bad-value null)")
    s.add_argument("--timeout", type=float, default=None, help="seconds; an available_now run that needs longer fails, a continuous one is stopped and says so")

    s = sub.add_parser("gold", help="silver → gold (J3); with --days only those days")
    s.add_argument("--silver", required=True)
    s.add_argument("--gold", required=True)
    s.add_argument("--on-bad-value", default="fail", choices=["fail", "null"])
    s.add_argument("--days", help="comma-separated yyyy-mm-dd days to rebuild (late data)")

    s = sub.add_parser("load", help="gold → warehouse over JDBC (J4)")
    s.add_argument("--gold", required=True)
    s.add_argument("--url", required=True)
    s.add_argument("--table", default="gold_aggregates")
    s.add_argument("--policy", default="recreate", choices=["recreate", "truncate", "append"])
    s.add_argument("--num-partitions", type=int, default=8)
    s.add_argument("--prop", action="append", help="JDBC option key=value (e.g. driver, user)")
    s.add_argument("--prop-env", action="append", help="JDBC option key=ENV_VAR, value read from the environment")

    s = sub.add_parser("sample", help="raw Parquet → CSV sample (J5)")
    s.add_argument("--raw", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--how", default="spread", choices=["head", "spread"])
    s.add_argument("--n", type=int, default=100_000)
    s.add_argument("--chunks", type=int, default=10)
    s.add_argument("--seed", type=int, default=42)

    s = sub.add_parser("export", help="raw Parquet → CSV, the whole table (J5)")
    s.add_argument("--raw", required=True)
    s.add_argument("--out", required=True)

    s = sub.add_parser("publish", help="CSV → wire messages, sent in one write (J6)")
    s.add_argument("--csv", required=True)
    s.add_argument("--sink", required=True, help="sink format, e.g. kafka or parquet")
    s.add_argument("--opt", action="append", help="sink option key=value (topic, kafka.bootstrap.servers, path, ...)")
    s.add_argument("--key", action="append", help="column of the message key")

    s = sub.add_parser("report", help="an analysis over gold (B1–B6) → Parquet")
    s.add_argument("--name", required=True, choices=REPORTS)
    s.add_argument("--gold", required=True)
    s.add_argument("--silver", help="needed by tip_patterns")
    s.add_argument("--zones", help="Parquet of (zone_id, zone, borough), for borough_routes")
    s.add_argument("--out", required=True)
    s.add_argument("--k", type=int, default=None)
    return p


def _finish(query, args) -> bool:
    """Wait for a stream; True if a continuous one was stopped at its time."""
    from tripflow.streaming import ingest as I

    if args.trigger == "available_now":
        I.run_to_end(query, args.timeout)
        return False
    return I.run_for(query, args.timeout)


def run(argv: list[str], spark: SparkSession) -> dict:
    """Run one subcommand on ``spark``; returns a summary (also printed by main)."""
    from tripflow.operators import reports as R
    from tripflow.operators import profile as P
    from tripflow.operators import silver as SV
    from tripflow.plans import jobs as J
    from tripflow.sinks.warehouse import load_warehouse
    from tripflow.sources import files as SF
    from tripflow.streaming import ingest as I

    args = _parser().parse_args(argv)
    if args.cmd == "ingest":
        opts = dict(kv.split("=", 1) for kv in (args.opt or []))
        q = I.ingest_bronze(
            spark, args.source, args.bronze, args.checkpoint, args.format, args.trigger, opts, args.max_files_per_batch
        )
        return {"cmd": "ingest", "stopped": _finish(q, args), "batches": (q.lastProgress or {}).get("batchId")}
    if args.cmd == "silver":
        stats: dict = {}
        J.silver_job(
            spark, args.bronze, args.silver, args.on_bad_value, args.nan_policy, args.dynamic, stats, not args.no_rebalance,
            args.bronze_format, args.rejects,
        )
        if args.profile:
            P.profile(SF.read_table(spark, args.silver)).write.mode("overwrite").parquet(args.profile)
        if args.reject_report:
            bronze = SV.nan_to_null(SV.cast_measures(SF.read_bronze(spark, args.bronze, fmt=args.bronze_format), on_bad_value=args.on_bad_value), args.nan_policy)
            SV.reject_report(bronze).write.mode("overwrite").parquet(args.reject_report)
        return {"cmd": "silver", **stats}
    if args.cmd == "incremental":
        from tripflow.streaming.incremental import silver_gold_incremental

        q = silver_gold_incremental(
            spark, args.bronze, args.silver, args.gold, args.checkpoint, args.bronze_format, args.trigger,
            args.max_files_per_trigger, args.on_bad_value, args.nan_policy,
            args.rejects,
        )
        return {"cmd": "incremental", "stopped": _finish(q, args), "batches": (q.lastProgress or {}).get("batchId")}
    if args.cmd == "gold":
        if args.days:
            parts = [tuple(int(x) for x in d.split("-")) for d in args.days.split(",")]
            J.refresh_gold_days(spark, args.silver, args.gold, parts, args.on_bad_value)
            return {"cmd": "gold", "days": len(parts)}
        J.gold_job(spark, args.silver, args.gold, args.on_bad_value)
        return {"cmd": "gold"}
    if args.cmd == "load":
        gold = SF.read_table(spark, args.gold)
        s = load_warehouse(gold, args.url, args.table, args.policy, _props(args), args.num_partitions)
        days = {"-".join("null" if v is None else f"{v:02d}" for v in d): n for d, n in s.days.items()}
        return {"cmd": "load", "rows": s.rows, "partitions": s.partitions, "attempts": s.attempts, "days": days}
    if args.cmd == "sample":
        total = J.export_sample(spark, args.raw, args.out, args.how, args.n, args.chunks, args.seed)
        return {"cmd": "sample", "total": total}
    if args.cmd == "export":
        J.export_csv(SF.read_raw_parquet(spark, args.raw), args.out)
        return {"cmd": "export"}
    if args.cmd == "publish":
        opts = dict(kv.split("=", 1) for kv in (args.opt or []))
        J.publish_csv(spark, args.csv, key_cols=args.key or None, sink_format=args.sink, sink_options=opts)
        return {"cmd": "publish"}
    if args.cmd == "report":
        gold = SF.read_table(spark, args.gold)
        k = {"k": args.k} if args.k else {}
        if args.name == "tip_patterns":
            out = R.tip_patterns(SF.read_table(spark, args.silver))
        elif args.name == "borough_routes":
            out = R.borough_routes(gold, spark.read.parquet(args.zones))
        else:
            out = getattr(R, args.name)(gold, **k)
        out.write.mode("overwrite").parquet(args.out)
        return {"cmd": "report", "name": args.name}
    raise AssertionError(args.cmd)


def main(argv: list[str] | None = None) -> None:
    argv = sys.argv[1:] if argv is None else argv
    _parser().parse_args(argv)  # usage errors and --help before a session starts
    spark = SparkSession.builder.appName("tripflow").getOrCreate()
    print(json.dumps(run(argv, spark)))


if __name__ == "__main__":
    main()
